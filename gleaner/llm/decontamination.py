"""Benchmark passages in documents, also with small edits.

A random walk along a string, in which each step copies a character and a
random bit of step and character says whether to move on, turns edit distance
into Hamming distance. Windows of an item's size and the items are embedded
this way, samples of embedded positions are hashed, and what falls into the
same bucket in any of several repetitions is verified by exact edit distance.

Windows are placed where the document can hold an item at all: a passage
within k edits of an item of n characters has n - q + 1 - kq of its q-grams.
Where that is less than two grams (items of up to 40 characters at a tenth),
the item is cut into k + 1 pieces, one of which the passage holds unchanged.
No place that could hold one is left out by either.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gleaner.llm.memo import per_worker

GRAM = 8
TABLE_BITS = 20
STEP = 1.15
WALKS = 6
SAMPLES = 8
SAMPLED = 4
SHORT = 16
GROUP = 64
BLOCK_CHARS = 4 << 20
PLACES = 1 << 18
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def normal_text(text: str | None) -> str:
    """Lower case, runs of white space as one blank."""
    return " ".join(text.lower().split()) if text else ""


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return (points ^ (points >> np.uint32(8)) ^ (points >> np.uint32(16))).astype(np.uint8)


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the gram of ``size`` characters, 8 at most, at every position, one to one; its high bits are its table slot."""
    if len(data) < size:
        return np.empty(0, np.uint64)
    padded = data.tobytes() + bytes(GRAM - size)
    return (np.ndarray((len(data) - size + 1,), "<u8", padded, 0, (1,)) & np.uint64((1 << 8 * size) - 1)) * GOLDEN


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def allowed_edits(n: int, share: float) -> int:
    """Edits that an item of ``n`` characters may differ by."""
    return int(share * n + 1e-9)


def grams_suffice(n: int, share: float) -> bool:
    """Whether two q-grams at least remain of an item of ``n`` characters after all edits."""
    return n - GRAM + 1 - GRAM * allowed_edits(n, share) >= 2


def best_distance(item: str, text: str) -> int:
    """Least edit distance between ``item`` and any part of ``text``, by bit-parallel columns."""
    if item in text:
        return 0
    size = len(item)
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, distance = full, 0, size
    best = size
    for c in text:
        equal = where.get(c, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        best = min(best, distance)
    return best


class Items:
    """Embedded items by size class, and everything to find them in a text."""

    def __init__(self, items: list[tuple[object, str]], share: float, seed: int = 11):
        self.share = share
        texts = [(item_id, normal_text(text)) for item_id, text in items]
        self.short: dict[int, dict[str, list]] = {}
        sized: dict[tuple[int, bool], list[tuple[object, str]]] = {}
        for item_id, text in texts:
            if not text:
                continue
            if len(text) < SHORT:
                self.short.setdefault(text.count(" ") + 1, {}).setdefault(text, []).append(item_id)
            else:
                number = int(np.log(len(text) / SHORT) / np.log(STEP) + 1e-9)
                sized.setdefault((number, grams_suffice(len(text), share)), []).append((item_id, text))
        self.table = np.zeros(1 << TABLE_BITS, np.uint64)
        self.classes = []
        self.ordered: list[list[tuple[np.ndarray, np.ndarray]]] = []
        pieces: dict[int, list[tuple[int, int, int, int]]] = {}
        random = np.random.default_rng(seed)
        for (number, by_grams), members in ((n, sized[n][at : at + GROUP]) for n in sorted(sized) for at in range(0, len(sized[n]), GROUP)):
            low, high = min(len(t) for _, t in members), max(len(t) for _, t in members)
            bit = np.uint64(1) << np.uint64(number % 64) if by_grams else np.uint64(0)
            if not by_grams:
                for m, (_, text) in enumerate(members):
                    parts = min(allowed_edits(len(text), share) + 1, len(text))
                    size = min(GRAM, len(text) // parts)
                    for part in range(parts):
                        at = part * len(text) // parts
                        piece = int(gram_hashes(symbols(text)[at : at + size], size)[0])
                        pieces.setdefault(size, []).append((piece, len(self.classes), m, at))
            own_grams = [np.unique(gram_hashes(symbols(text))) for _, text in members]
            for grams in own_grams:  # no slot holds the bit of a class that is looked for by pieces
                self.table[slots_of(grams)] |= bit
            grams = np.unique(np.concatenate(own_grams))
            has = np.zeros(len(grams), np.uint64)
            in_order = []
            for _, text in members:
                hashes = gram_hashes(symbols(text))
                by = np.argsort(hashes, kind="stable")
                in_order.append((hashes[by], by))
            self.ordered.append(in_order)
            for m, some in enumerate(own_grams):
                has[np.searchsorted(grams, some)] |= np.uint64(1) << np.uint64(m)
            least = [len(t) - GRAM + 1 - GRAM * allowed_edits(len(t), share) for _, t in members]
            moves = random.integers(0, 2, (WALKS, 2 * low, 256), np.uint8)
            # a walk takes two steps a character on average; what lies behind is mostly the filling after the end
            places = np.sort(random.integers(0, 2 * low, (WALKS, SAMPLES, SAMPLED)), axis=2)
            own = np.stack([symbols(t)[:low] for _, t in members])
            keys = self.embed(own.reshape(-1), np.arange(len(members)) * low, low, moves, places)
            order = np.argsort(keys, axis=-1, kind="stable")
            self.classes.append((bit, members, low, high, grams, has, least, allowed_edits(high, share), moves, places, np.take_along_axis(keys, order, -1), order))
        self.pieces = {}
        for size, known in pieces.items():
            known.sort()
            self.pieces[size] = (np.array([k[0] for k in known], np.uint64), np.array([k[1:] for k in known], np.int64))

    @staticmethod
    def embed(data: np.ndarray, starts: np.ndarray, length: int, moves: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Hash keys (walk, sample, window) of the windows of ``length`` at ``starts``; past the end stands a blank symbol."""
        keys = np.zeros((*places.shape[:2], len(starts)), np.uint64)
        wanted: dict[int, list[tuple[int, int]]] = {}
        for (walk, sample, _), place in np.ndenumerate(places):
            wanted.setdefault(int(place), []).append((walk, sample))
        at = np.zeros((len(moves), len(starts)), np.int64)
        walks = np.arange(len(moves))[:, None]
        for step in range(max(wanted) + 1):
            here = data.take(starts + np.minimum(at, length), mode="clip")
            here[at >= length] = 0
            for walk, sample in wanted.get(step, ()):
                keys[walk, sample] = keys[walk, sample] * np.uint64(257) + here[walk]
            at += moves[walks, step, here]
        return keys

    def find(self, texts: list[str]) -> list[list[tuple[object, int, int]]]:
        """For each text the items in it: (item id, distance, item length), each item once with its least distance."""
        found: list[dict] = [{} for _ in texts]
        if self.short:
            for number, text in enumerate(texts):
                words = text.split(" ")
                for size, known in self.short.items():
                    for at in range(len(words) - size + 1):
                        for item_id in known.get(" ".join(words[at : at + size]), ()):
                            found[number][item_id] = (0, sum(map(len, words[at : at + size])) + size - 1)
        if self.classes:
            self._find_long(texts, found)
        return [[(item_id, *value) for item_id, value in hits.items()] for hits in found]

    def _windows(self, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
        """Numbers of size classes, the places where one of their items may open in a text, and those items as bits."""
        hashes = gram_hashes(own)
        masks = self.table.take(slots_of(hashes))
        hits = np.flatnonzero(masks)
        masks = masks[hits]
        for number, (bit, members, low, high, grams, has, least, edits, *_) in enumerate(self.classes):
            if not bit:
                continue
            at = hits[(masks & bit) != 0]
            fewest = min(least)
            if len(at) < fewest or not (at[fewest - 1 :] - at[: len(at) - fewest + 1] < high + edits).any():
                continue
            own_hashes = hashes[at]
            found = np.minimum(np.searchsorted(grams, own_hashes), len(grams) - 1)
            true = grams[found] == own_hashes
            at, items = at[true], has[found[true]]
            opens, candidates = [], 0
            for m, (_, text) in enumerate(members):
                mine = (items >> np.uint64(m)) & np.uint64(1) != 0
                if mine.sum() < least[m]:
                    continue
                limit = allowed_edits(len(text), self.share)
                # a gram lies as far into the passage as into the item, give or take the edits
                grams_here, places = self.ordered[number][m]
                hashed = own_hashes[true][mine]
                left = np.searchsorted(grams_here, hashed, "left")
                times = np.searchsorted(grams_here, hashed, "right") - left
                which = np.repeat(left - (np.cumsum(times) - times), times) + np.arange(times.sum())
                start = np.sort(np.repeat(at[mine], times) - places[which])
                last = start[least[m] - 1 :]
                first = start[: len(last)]
                fits = last - first <= 2 * limit
                if not fits.any():
                    continue
                candidates |= 1 << m
                near = np.zeros(len(own) + 2, np.int32)
                np.add.at(near, np.clip(last[fits] - limit, 0, len(own)), 1)
                np.add.at(near, np.clip(first[fits] + limit + 1, 1, len(own) + 1), -1)
                # a window that opens one character off is as good as one edit more
                places = np.flatnonzero(np.cumsum(near)[:-1] > 0)
                opens.append(places[(places % 2 == 0) | np.concatenate([[True], places[1:] != places[:-1] + 1])])
            if opens:
                yield number, np.unique(np.concatenate(opens)), candidates

    def _windows_by_pieces(self, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
        """As :meth:`_windows` for the items that are looked for by an unchanged piece."""
        classes: dict[int, tuple[list[np.ndarray], int]] = {}
        for size, (known, facts) in self.pieces.items():
            hashes = gram_hashes(own, size)
            left = np.searchsorted(known, hashes, "left")
            hits = np.flatnonzero(known[np.minimum(left, len(known) - 1)] == hashes)
            left = left[hits]
            times = np.searchsorted(known, hashes[hits], "right") - left
            # a piece may stand in many items, so that places are taken some at a time
            for some in np.split(np.arange(len(hits)), np.flatnonzero(np.diff(np.cumsum(times) // PLACES)) + 1):
                which = np.repeat(left[some] - (np.cumsum(times[some]) - times[some]), times[some]) + np.arange(times[some].sum())
                number, member, offset = facts[which].T
                start = np.repeat(hits[some], times[some]) - offset
                key = number * GROUP + member
                order = np.argsort(key, kind="stable")
                bounds = np.flatnonzero(np.diff(key[order])) + 1
                for mine in np.split(order, bounds) if len(order) else ():
                    n, m = divmod(int(key[mine[0]]), GROUP)
                    limit = allowed_edits(len(self.classes[n][1][m][1]), self.share)
                    near = np.unique(start[mine][:, None] + np.arange(-limit, limit + 1))
                    opens, candidates = classes.get(n, ([], 0))
                    opens.append(near[(near >= 0) & (near < len(own))])
                    classes[n] = (opens, candidates | 1 << m)
        for number, (opens, candidates) in classes.items():
            yield number, np.unique(np.concatenate(opens)), candidates

    def _find_long(self, texts: list[str], found: list[dict]) -> None:
        data = [symbols(t) for t in texts]
        windows: list[tuple[list, list, dict]] = [([], [], {}) for _ in self.classes]
        for number, own in enumerate(data):
            for which, opens, candidates in chain(self._windows(own), self._windows_by_pieces(own)):
                windows[which][2][number] = candidates
                windows[which][0].append(np.full(len(opens), number))
                windows[which][1].append(opens)
        for (_, members, low, *_, moves, places, keys, order), (owners, starts, candidates) in zip(self.classes, windows):
            if not owners:
                continue
            owner, start = np.concatenate(owners), np.concatenate(starts)
            for at in range(0, len(owner), 1 << 14):
                self._match(texts, data, owner[at : at + (1 << 14)], start[at : at + (1 << 14)], members, low, moves, places, keys, order, candidates, found)

    def _match(self, texts, data, owner, start, members, low, moves, places, keys, order, candidates, found) -> None:
        distinct, local = np.unique(owner, return_inverse=True)
        lengths = np.array([len(data[n]) + low for n in distinct])
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        flat = np.zeros(offsets[-1] + 1, np.uint8)
        for n, offset in zip(distinct, offsets):
            flat[offset : offset + len(data[n])] = data[n]
        windows = self.embed(flat, offsets[local] + start, low, moves, places)
        pairs = []
        for walk in range(WALKS):
            for sample in range(SAMPLES):
                sorted_keys = keys[walk, sample]
                left = np.searchsorted(sorted_keys, windows[walk, sample], "left")
                right = np.searchsorted(sorted_keys, windows[walk, sample], "right")
                hit = np.flatnonzero(right > left)
                counts = (right - left)[hit]
                window = np.repeat(hit, counts)
                member = order[walk, sample][np.repeat(left[hit] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
                pairs.append(window * len(members) + member)
        joined = np.unique(np.concatenate(pairs))
        window, member = joined // len(members), joined % len(members)
        spans: dict[tuple[int, int], list[list[int]]] = {}
        for w, m in zip(window.tolist(), member.tolist()):
            if not candidates[int(owner[w])] >> m & 1:
                continue
            runs = spans.setdefault((int(owner[w]), m), [])
            if runs and start[w] - runs[-1][1] <= low:
                runs[-1][1] = int(start[w])
            else:
                runs.append([int(start[w]), int(start[w])])
        for (number, m), runs in spans.items():
            item_id, item = members[m]
            limit = allowed_edits(len(item), self.share)
            for first, last in runs:
                if item_id in found[number] and found[number][item_id][0] == 0:
                    break
                part = texts[number][max(0, first - limit) : last + len(item) + 2 * limit]
                distance = best_distance(item, part)
                if distance <= limit and distance < found[number].get(item_id, (limit + 1,))[0]:
                    found[number][item_id] = (distance, len(item))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """The items, block by block of bounded size."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).filter(F.col("t").isNotNull()).toLocalIterator():
        block.append((row["i"], row["t"]))
        size += len(row["t"])
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: float = 0.1) -> DataFrame:
    """doc_id, item_id, distance and item_chars for every row of ``docs`` and item in it.

    An item is in a text when some part of the whole text is within ``share``
    of the item's characters by edits, case and kinds of white space aside. An
    item below ``SHORT`` characters counts only as whole words without edits;
    null and empty items and texts match nothing. Repeated rows and repeated
    items give a row each. Items are broadcast in blocks of ``BLOCK_CHARS``
    characters, one pass over the texts for each.
    """
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, distance int, item_chars int"
    item_arrow = to_arrow_type(benchmark.schema[item_col].dataType)
    table = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    result = None
    for block in _blocks(benchmark, item_col, item_text_col):
        numbered = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], numbered=numbered) -> Iterator[pa.RecordBatch]:
            items = per_worker(("items", hash(tuple(numbered.value)), share), lambda: Items([(n, text) for n, (_, text) in enumerate(numbered.value)], share))
            for batch in batches:
                hits = items.find([normal_text(t.as_py()) for t in batch.column(1)])
                rows = [(row, n, distance, size) for row, own in enumerate(hits) for n, distance, size in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([numbered.value[r[1]][0] for r in rows], item_arrow),
                        pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int32()),
                    ],
                    ["doc_id", "item_id", "distance", "item_chars"],
                )

        part = table.mapInArrow(search, schema)
        result = part if result is None else result.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if result is None else result


def without_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: float = 0.1) -> DataFrame:
    """The rows of ``docs`` that hold no item, columns as they were; matching as in :func:`find_items`."""
    kept = docs
    schema = docs.schema
    for block in _blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = per_worker(("items", hash(tuple(shared.value)), share), lambda: Items([(n, text) for n, (_, text) in enumerate(shared.value)], share))
            for batch in batches:
                hits = items.find([normal_text(t.as_py()) for t in batch.column(batch.schema.get_field_index(text_col))])
                yield batch.filter(pa.array([not own for own in hits], pa.bool_()))

        kept = kept.mapInArrow(clean, schema)
    return kept
