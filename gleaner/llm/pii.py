"""Personal data: fixed patterns, and a character-level tagger that adds spans.

The tagger is a bidirectional LSTM over characters with a CRF on top, trained
in numpy from labelled spans. A text is read in overlapping windows; where
windows overlap their scores are averaged, the middle of a window counting
most, and each covered stretch is decoded as a whole, so that no span depends
on where a window was cut.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.memo import received, sent


KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside, then opening and inside of each kind
WINDOW = 64
STRIDE = 32
SYMBOLS = 99
SCORED = 4096  # windows scored at once
UNSETTLED = 4096  # characters after which the past is settled
ANCHOR = re.compile("[0-9@]")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


# ---- patterns

def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """From each at sign outwards, so that long runs without one cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield "email", start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind, then start; matches that fail their check are dropped without another try."""
    spans = list(emails(text))
    spans += [("ip", m.start(), m.end()) for m in ADDRESS.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split("."))]
    spans += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(d := digits_of(m.group())) <= 19 and luhn(d)]
    spans += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return spans


def plausible(kind: str, text: str) -> bool:
    """Whether a tagged span can be of its kind at all."""
    digits = digits_of(text)
    if kind == "email":
        return "." in text.partition("@")[2] and not any(c.isspace() for c in text) and text[0] != "@"
    if kind == "ip":
        parts = re.split(r"[^0-9]+", text)
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and not any(c.isalpha() for c in text)


# ---- the tagger

def encode(text: str) -> np.ndarray:
    """Symbol of each character: printable ASCII by itself, then white space, other letters, others."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((points >= 32) & (points < 127), points - 32, np.where((points == 10) | (points == 9) | (points == 13), 95, np.where(points >= 192, 96, 97))).astype(np.int64)


def window_starts(text: str) -> list[int]:
    """Places of the grid of windows that hold a digit or an at sign; a span without one is never kept, so the others are not read."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    return sorted({s for m in ANCHOR.finditer(text) for s in range(max(0, (m.start() - WINDOW) // STRIDE + 1), min(last, m.start() // STRIDE) + 1)})


def windows_of(symbols: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.concatenate([symbols, np.full(WINDOW, SYMBOLS - 1)])
    return padded[np.array(starts)[:, None] * STRIDE + np.arange(WINDOW)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


# Seeds to train from, and the share of held-out windows that must be right for the first of them to do.
SEEDS, GOOD_AGREEMENT = (3, 5, 7), 0.97


class Tagger:
    def __init__(self, size: int = 12, seed: int = 3):
        random = np.random.default_rng(seed)
        self.size = size
        self.params = {
            **{f"in{d}": random.normal(0, 0.2, (SYMBOLS, 4 * size)) for d in "fb"},
            **{f"re{d}": random.normal(0, 0.2, (size, 4 * size)) for d in "fb"},
            "out": random.normal(0, 0.2, (2 * size, TAGS)), "bias": np.zeros(TAGS),
            "trans": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS),
        }
        for d in "fb":
            self.params[f"in{d}"][:, size : 2 * size] += 1.0

    def _run(self, symbols: np.ndarray, d: str) -> list[tuple]:
        """States of one direction: per step (gates, cell, tanh of cell, hidden)."""
        table, recurrent, n = self.params[f"in{d}"], self.params[f"re{d}"], self.size
        hidden = cell = np.zeros((len(symbols), n), table.dtype)
        steps = []
        for t in range(symbols.shape[1]) if d == "f" else range(symbols.shape[1] - 1, -1, -1):
            z = table[symbols[:, t]] + hidden @ recurrent
            gates = sigmoid(z)
            gates[:, 3 * n :] = np.tanh(z[:, 3 * n :])
            cell = gates[:, n : 2 * n] * cell + gates[:, :n] * gates[:, 3 * n :]
            squashed = np.tanh(cell)
            hidden = gates[:, 2 * n : 3 * n] * squashed
            steps.append((gates, cell, squashed, hidden))
        return steps

    def _scores(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
        runs = {d: self._run(symbols, d) for d in "fb"}
        hidden = np.concatenate([np.stack([s[3] for s in runs["f"]], 1), np.stack([s[3] for s in runs["b"]][::-1], 1)], 2)
        return hidden @ self.params["out"] + self.params["bias"], hidden, runs

    def scores(self, symbols: np.ndarray) -> np.ndarray:
        """Score of each tag for each character of each window."""
        return np.concatenate([self._scores(symbols[at : at + 512])[0] for at in range(0, len(symbols), 512)]) if len(symbols) else np.empty((0, WINDOW, TAGS))

    def _crf(self, scores: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Loss and gradients by the forward and backward sums."""
        trans, first = self.params["trans"], self.params["first"]
        size, steps, _ = scores.shape
        ahead, behind = [first + scores[:, 0]], [np.zeros((size, TAGS))]
        for t in range(1, steps):
            ahead.append(scores[:, t] + logsumexp(ahead[-1][:, :, None] + trans, 1))
        for t in range(steps - 1, 0, -1):
            behind.append(logsumexp(trans + (scores[:, t] + behind[-1])[:, None, :], 2))
        behind.reverse()
        total = logsumexp(ahead[-1], 1)
        rows = np.arange(size)
        shares = np.exp(np.stack(ahead, 1) + np.stack(behind, 1) - total[:, None, None])
        d_trans = np.zeros_like(trans)
        gold = first[tags[:, 0]] + scores[rows, 0, tags[:, 0]]
        for t in range(1, steps):
            pair = np.exp(ahead[t - 1][:, :, None] + trans + (scores[:, t] + behind[t])[:, None, :] - total[:, None, None])
            d_trans += pair.sum(0)
            np.subtract.at(d_trans, (tags[:, t - 1], tags[:, t]), 1)
            gold = gold + trans[tags[:, t - 1], tags[:, t]] + scores[rows, t, tags[:, t]]
        d_scores = shares.copy()
        np.subtract.at(d_scores, (rows[:, None], np.arange(steps), tags), 1)
        d_first = d_scores[:, 0].sum(0)
        return float((total - gold).sum()), d_scores, d_trans, d_first

    def gradients(self, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        scores, hidden, runs = self._scores(symbols)
        loss, d_scores, d_trans, d_first = self._crf(scores, tags)
        n, grads = self.size, {"trans": d_trans, "first": d_first, "bias": d_scores.sum((0, 1)), "out": np.einsum("bth,btk->hk", hidden, d_scores)}
        d_hidden = d_scores @ self.params["out"].T
        for d, part in (("f", d_hidden[:, :, :n]), ("b", d_hidden[:, ::-1, n:])):
            order = symbols if d == "f" else symbols[:, ::-1]
            recurrent, steps = self.params[f"re{d}"], runs[d]
            d_table, d_recurrent = np.zeros_like(self.params[f"in{d}"]), np.zeros_like(recurrent)
            back_h = back_c = np.zeros((len(symbols), n))
            for t in range(len(steps) - 1, -1, -1):
                gates, cell, squashed, _ = steps[t]
                before = steps[t - 1][1] if t else np.zeros_like(cell)
                h = part[:, t] + back_h
                c = back_c + h * gates[:, 2 * n : 3 * n] * (1 - squashed**2)
                d_gates = np.concatenate([c * gates[:, 3 * n :], c * before, h * squashed, c * gates[:, :n]], 1)
                slope = gates * (1 - gates)
                slope[:, 3 * n :] = 1 - gates[:, 3 * n :] ** 2
                d_gates *= slope
                np.add.at(d_table, order[:, t], d_gates)
                if t:
                    d_recurrent += steps[t - 1][3].T @ d_gates
                back_h, back_c = d_gates @ recurrent.T, c * gates[:, n : 2 * n]
            grads[f"in{d}"], grads[f"re{d}"] = d_table, d_recurrent
        return loss, grads

    def fit(self, symbols: np.ndarray, tags: np.ndarray, epochs: int = 14, batch: int = 48, rate: float = 0.02, seed: int = 3, patience: int = 3) -> "Tagger":
        """Train on seven of eight windows, until the eighth ones have not improved for ``patience`` rounds; the best round's weights stay.

        ``agreement`` is the share of held-out windows with all their tags right.
        """
        aside = np.arange(len(symbols)) % 8 == 7
        held, held_tags, symbols, tags = symbols[aside], tags[aside], symbols[~aside], tags[~aside]
        best, best_loss, waited = self.params, np.inf, 0
        random, moments, turn = np.random.default_rng(seed), {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.params.items()}, 0
        for epoch in range(epochs):
            for part in np.array_split(random.permutation(len(symbols)), max(1, len(symbols) // batch)):
                turn += 1
                _, grads = self.gradients(symbols[part], tags[part])
                for name, grad in grads.items():
                    grad = np.clip(grad / len(part), -1, 1)
                    m, v = moments[name]
                    m += 0.1 * (grad - m)
                    v += 0.01 * (grad * grad - v)
                    self.params[name] = self.params[name] - rate / (1 + 0.3 * epoch) * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
            loss = self._crf(self._scores(held)[0], held_tags)[0] if len(held) else 0.0
            if loss < best_loss or not len(held):
                best, best_loss, waited = dict(self.params), loss, 0
            else:
                waited += 1
                if waited == patience:
                    break
        self.params = {k: v.astype(np.float32) for k, v in best.items()}
        right = [self.decode(s) == t for s, t in zip(self.scores(held), held_tags.tolist())]
        self.agreement = sum(right) / len(right) if right else 1.0
        return self

    def decode(self, scores: np.ndarray) -> list[int]:
        """Best tags of one stretch of characters."""
        decoder = Decoder(self)
        return [*decoder.push(scores), *decoder.close()]


class Decoder:
    """Best tags of a stretch that comes in pieces; the past that all ways still open share is given out, so that little is held."""

    def __init__(self, tagger: Tagger):
        self.first, self.trans = tagger.params["first"], tagger.params["trans"]
        self.best, self.links, self.look = None, [], UNSETTLED

    def push(self, scores: np.ndarray) -> list[int]:
        rows = iter(scores)
        if self.best is None and len(scores):
            self.best = self.first + next(rows)
        for row in rows:
            ways = self.best[:, None] + self.trans
            self.links.append(ways.argmax(0))
            self.best = ways.max(0) + row
        return self._settled() if len(self.links) >= self.look else []

    def _settled(self) -> list[int]:
        ways = np.arange(TAGS)
        for n in range(len(self.links) - 1, -1, -1):
            ways = self.links[n][ways]
            if (ways == ways[0]).all():
                tags = self._back(int(ways[0]), self.links[:n])
                self.links, self.look = self.links[n + 1 :], UNSETTLED
                return tags
        self.look = 2 * len(self.links)
        return []

    @staticmethod
    def _back(tag: int, links: list[np.ndarray]) -> list[int]:
        tags = [tag]
        for link in reversed(links):
            tags.append(int(link[tags[-1]]))
        return tags[::-1]

    def close(self) -> list[int]:
        return [] if self.best is None else self._back(int(self.best.argmax()), self.links)


def tag_windows(text: str, starts: list[int], spans: list[Span]) -> np.ndarray:
    tags = np.zeros(max(len(text), (starts[-1] * STRIDE if starts else 0)) + WINDOW, np.int64)
    for kind, start, end in spans:
        number = KINDS.index(kind)
        tags[start:end] = 2 + 2 * number
        tags[start] = 1 + 2 * number
    return tags[np.array(starts)[:, None] * STRIDE + np.arange(WINDOW)]


MIDDLE = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])


def scored_windows(texts: list[str], starts: list[list[int]], tagger: Tagger) -> Iterator[np.ndarray]:
    """Scores of the windows of all texts in turn, made ``SCORED`` at a time."""
    rows: list[np.ndarray] = []
    size = 0
    for text, own in zip(texts, starts):
        symbols = encode(text) if own else None
        for at in range(0, len(own), SCORED):
            some = own[at : at + SCORED]
            rows.append(windows_of(symbols[some[0] * STRIDE : some[-1] * STRIDE + WINDOW], [k - some[0] for k in some]))
            size += len(rows[-1])
            if size >= SCORED:
                yield from tagger.scores(np.concatenate(rows))
                rows, size = [], 0
    if rows:
        yield from tagger.scores(np.concatenate(rows))


def stretch_tags(places: int, size: int, scores: Iterator[np.ndarray], tagger: Tagger) -> bytearray:
    """Tags of the ``size`` characters under ``places`` neighbouring windows, whose scores are averaged, those near a window's middle weighing more."""
    decoder, tags = Decoder(tagger), bytearray()
    total, weight = np.zeros((WINDOW, TAGS)), np.zeros(WINDOW)
    for place in range(places):
        if place:
            tags += bytes(decoder.push(total[:STRIDE] / weight[:STRIDE, None]))
            total = np.concatenate([total[STRIDE:], np.zeros((STRIDE, TAGS))])
            weight = np.concatenate([weight[STRIDE:], np.zeros(STRIDE)])
        total += next(scores) * MIDDLE[:, None]
        weight += MIDDLE
    rest = size - (places - 1) * STRIDE
    tags += bytes(decoder.push(total[:rest] / weight[:rest, None]))
    tags += bytes(decoder.close())
    return tags


def tagged_spans(texts: list[str], tagger: Tagger) -> list[list[Span]]:
    """Spans of the tagger in whole texts, with a digit or at sign each and plausible for their kind.

    However long a text is, the scores of ``SCORED`` windows are held at once, and of a stretch its tags, a byte a character.
    """
    starts = [window_starts(t) for t in texts]
    scores = scored_windows(texts, starts, tagger)
    result = []
    for text, own in zip(texts, starts):
        found: list[Span] = []
        at = 0
        while at < len(own):
            upto = at + 1
            while upto < len(own) and own[upto] == own[upto - 1] + 1:
                upto += 1
            first = own[at] * STRIDE
            size = min((own[upto - 1] - own[at]) * STRIDE + WINDOW, len(text) - first)
            tags = stretch_tags(upto - at, size, scores, tagger)
            place = 0
            while place < size:
                if tags[place] % 2 == 1:
                    kind, end = tags[place] // 2, place + 1
                    while end < size and tags[end] == 2 + 2 * kind:
                        end += 1
                    if plausible(KINDS[kind], text[first + place : first + end]):
                        found.append((KINDS[kind], first + place, first + end))
                    place = end
                else:
                    place += 1
            at = upto
        result.append(found)
    return result


def all_spans(base: list[Span], tagged: list[Span]) -> list[Span]:
    """The base and those tagged spans that touch no base span, by kind, then start."""
    by_start = sorted(base, key=lambda s: s[1])
    starts, reach = [s[1] for s in by_start], list(accumulate((s[2] for s in by_start), max))

    def touches(span: Span) -> bool:
        before = bisect_left(starts, span[2])
        return before > 0 and reach[before - 1] > span[1]

    added = [s for s in tagged if not touches(s)]
    return sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def train_tagger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 800, longest: int = 20_000, windows: int = 4_000) -> Tagger | None:
    """Tagger from at most ``sample`` texts of at most ``longest`` characters with a digit or at sign, those with the smallest hash of id and text.

    The labelled spans are those of the patterns; of the texts' windows at
    most ``windows`` are used. Training starts anew from other weights, twice
    at most, while held-out windows come out worse than ``GOOD_AGREEMENT``.
    None when no text has such a character.
    """
    usable = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h")).filter(
        F.col("text").rlike("[0-9@]") & (F.char_length("text") <= longest)
    )
    # hashes first, so that no task sends texts that another one's push out
    last = usable.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    rows = sorted(usable.filter(F.col("h") <= last).dropDuplicates(["h"]).collect(), key=lambda r: r["h"]) if last is not None else []
    symbols, tags, size = [], [], 0
    for row in rows:
        own = window_starts(row["text"])
        if size + len(own) > windows:
            break
        size += len(own)
        symbols.append(windows_of(encode(row["text"]), own))
        tags.append(tag_windows(row["text"], own, base_spans(row["text"])))
    if not symbols:
        return None
    best = None
    for seed in SEEDS:
        tagger = Tagger(seed=seed).fit(np.concatenate(symbols), np.concatenate(tags), seed=seed)
        if best is None or tagger.agreement > best.agreement:
            best = tagger
        if best.agreement >= GOOD_AGREEMENT:
            break
    return best


def find_pii(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans for every row of ``docs``.

    Counts and digest are those of the patterns, ``spans`` has the tagger's
    too. Whole texts are read; a null text is an empty one without spans.
    Repeated rows, null ids and other columns need no care; an empty table
    gives an empty one.
    """
    shared = sent(docs.sparkSession.sparkContext, tagger)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(shared)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            some = [n for n, t in enumerate(texts) if ANCHOR.search(t)]
            base: list[list[Span]] = [[] for _ in texts]
            spans: list[list[Span]] = [[] for _ in texts]
            for at in range(0, len(some), 256):
                part = some[at : at + 256]
                tagged = tagged_spans([texts[n] for n in part], model) if model else [[] for _ in part]
                for n, own in zip(part, tagged):
                    base[n] = base_spans(texts[n])
                    spans[n] = all_spans(base[n], own)
            counts = [pa.array([sum(s[0] == kind for s in own) for own in base], pa.int64()) for kind in KINDS]
            digests = [hashlib.sha256(joined(own).encode()).hexdigest() for own in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digests, pa.string()), pa.array([joined(own) for own in spans], pa.string())],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        find, f"doc_id {id_type}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    )
