"""Splitting text where byte-level tokenizers split it before any merge."""

from __future__ import annotations

import json
import re

import numpy as np
import regex

# Fixed value: the pattern that the byte-level vocabulary files stand for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: white space other than the blank and the line end.
UNUSUAL_BLANKS = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def stops_are_tight(text: str) -> bool:
    """Whether every stop or comma before a blank or the end follows a letter or digit; False where in doubt.

    Beyond ASCII only the letters of two bytes that open with C3 are told apart.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass") + b" ", np.uint8)
    stop = (data[:-1] == 46) | (data[:-1] == 44)
    at = np.flatnonzero(stop & ((data[1:] == 32) | (data[1:] == 10)))
    if len(at) and at[0] == 0:
        return False
    before = data[at - 1]
    wide = (before >= 0x80) & (before < 0xC0) & (before != 0x97) & (before != 0xB7) & (data[np.maximum(at - 2, 0)] == 0xC3)
    return bool((ALPHANUMERIC[before] | wide).all())


def special_strings(model: str) -> list[str]:
    """The added tokens of a tokenizer file, longest first; each stands for one id wherever it occurs."""
    return sorted((t["content"] for t in json.loads(model)["added_tokens"]), key=len, reverse=True)


class Pieces:
    """Cuts a text at places where no token can reach across.

    A single blank or line end between two other characters always opens a new
    token, so such a text falls into the words at its blanks, each of which can
    be looked up by itself. Any other text is cut by the full pattern.
    """

    def __init__(self, specials: list[str]):
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.specials = specials
        self.tokens = regex.compile(PATTERN).findall

    def segments(self, text: str) -> list[str]:
        """Plain texts and, at odd places, special strings."""
        if self.special is None or not any(s in text for s in self.specials):
            return [text]
        return self.special.split(text)

    @staticmethod
    def is_plain(text: str) -> bool:
        """Whether all blanks are single ones between other characters."""
        return not (
            not text or "\0" in text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
            or text[0] in " \n" or text[-1] in " \n" or any(blank in text for blank in UNUSUAL_BLANKS)
        )

    def cut(self, text: str) -> list[str]:
        """Keys of the pieces of a segment; :meth:`spelled` gives the text of a key."""
        if self.is_plain(text):
            return self.marked(text).split(" ")
        return ["\0" + token for token in self.tokens(text)]

    @staticmethod
    def marked(text: str) -> str:
        """A plain text in which blanks part the keys of its pieces."""
        marked = text.replace("\n", " \n")
        if stops_are_tight(text):
            # after a letter a stop or comma is a token of its own, and words repeat more often without it
            marked = marked.replace(", ", " \0, ").replace(". ", " \0. ")
            if marked[-1] in ".,":
                marked = f"{marked[:-1]} \0{marked[-1]}"
        return "\0" + marked

    def tokens_of(self, key: str) -> list[str]:
        """Pretokens of the piece that a key stands for."""
        return [" " + key] if key.isalpha() else self.tokens(self.spelled(key))

    @staticmethod
    def spelled(key: str) -> str:
        """A key stands for a blank and the word, unless it opens with a line end or the mark of a bare piece."""
        return key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else " " + key
