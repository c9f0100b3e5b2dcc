"""Language-model scores by online logistic context mixing.

A text is a sequence of bytes and an end. Each byte is coded by the bits of a
prefix code, so that frequent bytes take few bits. Several predictors, each
with counts by its own context, give the odds of a bit. The counts are Spark
rows, so their number follows the corpus; the texts meet theirs in a join. They
are mixed in the logistic domain with weights that a gate selects, and along a
text the weights are refined after every block by the gradient of the loss.
The cost of all bits is the text's probability, per byte its bits per byte.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.memo import Memo, per_worker, received, sent
from gleaner.sources.scratch import forget, release, stage

END = 256
SYMBOLS = 257
ORDERS = (2, 4)
PREDICTORS = len(ORDERS) + 1
PAST = 12
# Binary logarithm of each predictor's table size, for counts held in one process.
SLOT_BITS = (18, 20, 20)
CELLS = sum(2 << bits for bits in SLOT_BITS)
GATES = 16
GRAIN = 12
BLOCK = 1024
BATCH_BYTES = 1 << 16
FLUSH_WORDS = 400_000
MEMO_WORDS = 300_000
# Training texts are in two folds; the counts of one judge the weights on the other.
FOLDS = 2
# A unit of texts of one fold asks for its counts at once, its texts travel in blocks; a group of contexts is counted in one task.
UNIT_BYTES = 1 << 23
TEXT_BLOCK = 1 << 19
GROUP_BYTES = 1 << 23
LEAST_GROUPS = 64
FLUSH_KEYS = 1 << 21
KEY_BITS = 17
ODD = np.array([0x9E3779B185EBCA77, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63], np.uint64)


# ---- words and the base score

def words_of(text: str | None) -> list[bytes]:
    """Words with ASCII letters in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (kind 0), ends (1), pairs of a byte and the next symbol (2) and bytes (3) with their counts, a task's own summed in bounded memory."""
    def rows(kind: int, keys: list[bytes], counts: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(keys), pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.int64())], ["kind", "key", "n"])

    counts: Counter = Counter()
    pairs, ends, read, held, size = np.zeros(256 * SYMBOLS, np.int64), 0, 0, [], 0

    def add_pairs() -> None:
        """Pairs within each of the held texts, which a line end opens and the end closes."""
        line = np.concatenate([np.concatenate([[10], text, [END]]) for text in held])
        inside = line[:-1] != END
        pairs[:] += np.bincount(line[:-1][inside] * SYMBOLS + line[1:][inside], minlength=256 * SYMBOLS)

    for batch in batches:
        for text in batch.column(0):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            held.append(np.frombuffer(data, np.uint8).astype(np.int64))
            size += len(data)
            read += len(data)
            counts.update(data.lower().split())
            ends += 1
            if size > 8 * BATCH_BYTES:
                add_pairs()
                held, size = [], 0
            if len(counts) > FLUSH_WORDS:
                yield rows(0, list(counts), list(counts.values()))
                counts.clear()
    if held:
        add_pairs()
    yield rows(0, list(counts), list(counts.values()))
    yield rows(1, [b""], [ends])
    yield rows(3, [b""], [read])
    seen = np.flatnonzero(pairs)
    yield rows(2, [int(p).to_bytes(3, "little") for p in seen], pairs[seen].tolist())


# ---- the bit code

class BitCode:
    """Prefix codes over bytes and the end, one for each byte before, from counts (byte before, symbol); a node of a tree is a bit's place."""

    def __init__(self, counts: np.ndarray):
        self.lengths = np.zeros(256 * SYMBOLS, np.int64)
        self.starts = np.zeros(256 * SYMBOLS, np.int64)
        flat: list[tuple[int, int, int]] = []
        unseen: list[list[tuple[int, int]]] | None = None
        for before in range(256):
            row = counts[before]
            if row.any() or unseen is None:
                paths = self._paths(row)
                unseen = unseen if row.any() else paths
            else:
                paths = unseen
            for symbol, path in enumerate(paths):
                self.lengths[before * SYMBOLS + symbol], self.starts[before * SYMBOLS + symbol] = len(path), len(flat)
                flat += [(before * SYMBOLS + node, bit, min(depth, 3)) for depth, (node, bit) in enumerate(path)]
        table = np.array(flat, np.int64)
        self.nodes = table[:, 0].astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
        self.bits = table[:, 1]
        self.signs = (2 * self.bits - 1).astype(np.float32)
        self.depths = table[:, 2].astype(np.int8)

    @staticmethod
    def _paths(counts: np.ndarray) -> list[list[tuple[int, int]]]:
        """Of each symbol the (inner node, bit) from the root down."""
        heap = [(int(n) + 1, s, s) for s, n in enumerate(counts)]
        heapq.heapify(heap)
        children: dict[int, tuple[int, int]] = {}
        for node in range(SYMBOLS, 2 * SYMBOLS - 1):
            (n0, _, zero), (n1, _, one) = heapq.heappop(heap), heapq.heappop(heap)
            children[node] = (zero, one)
            heapq.heappush(heap, (n0 + n1, node, node))
        paths: list[list[tuple[int, int]]] = [[] for _ in range(SYMBOLS)]
        open_nodes: list[tuple[int, list]] = [(heap[0][2], [])]
        while open_nodes:
            node, path = open_nodes.pop()
            if node < SYMBOLS:
                paths[node] = path
            else:
                open_nodes += [(child, [*path, (node - SYMBOLS, bit)]) for bit, child in enumerate(children[node])]
        return paths

    def steps(self, before: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each bit of the symbols: the symbol's place, and the step in the codes; then the bits of each symbol."""
        which = before.astype(np.int64) * SYMBOLS + symbols
        lengths = self.lengths.take(which)
        places = np.repeat(np.arange(len(symbols)), lengths)
        return places, np.arange(len(places)) + (self.starts.take(which) - (np.cumsum(lengths) - lengths)).take(places), lengths


POWER = np.uint64(0x100000001B3)
UNPOWER = np.uint64(pow(0x100000001B3, -1, 1 << 64))
MIX = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64((1 << KEY_BITS) - 1)


def powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]), dtype=np.uint64)


def contexts(data: np.ndarray, starts: np.ndarray | None = None) -> list[np.ndarray]:
    """Hashed context of every byte after the first ``PAST``, one array per predictor, in the upper 47 bits.

    The last predictor sees all bytes since the last blank or the piece's
    start: the difference of two running sums of a polynomial, moved to the
    same power for every place.
    """
    n = len(data) - PAST
    wide = data.astype(np.uint64) + np.uint64(1)
    made, total = [], np.zeros(n, np.uint64)
    for k in range(1, max(ORDERS) + 1):
        total = total + wide[PAST - k : PAST - k + n] * ODD[k - 1]
        if k in ORDERS:
            made.append(total)
    rise, fall = per_worker("powers", lambda: (powers(POWER, 1 << 20), powers(UNPOWER, 1 << 20)))
    sums = np.cumsum(np.concatenate([np.zeros(1, np.uint64), wide * rise[: len(wide)]]), dtype=np.uint64)
    marks = np.where(data <= 32, np.arange(1, len(data) + 1), 0)
    if starts is not None:
        marks[starts] = np.maximum(marks[starts], starts)
    opened = np.maximum.accumulate(marks)[PAST - 1 : PAST - 1 + n]
    made.append((sums[PAST : PAST + n] - sums.take(opened)) * fall.take(opened) + np.uint64(1))
    return [((c ^ (c >> np.uint64(29))) * MIX) & ~LOW for c in made]


def node_ids(context: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    return (context ^ nodes) * MIX


def slots(context: np.ndarray, nodes: np.ndarray, bits: int) -> np.ndarray:
    return (node_ids(context, nodes) >> np.uint64(64 - bits)).astype(np.int64)


def tables_of(cells: np.ndarray) -> list[np.ndarray]:
    """The predictors' tables, as views of one array."""
    return np.split(cells, np.cumsum([2 << bits for bits in SLOT_BITS])[:-1])


PADDING = np.full(PAST, 10, np.uint8)


def count_bits(data: np.ndarray, code: BitCode, tables: list[np.ndarray]) -> None:
    """Add the bits of a text, preceded by its ``PAST`` bytes of past, to the tables."""
    places, steps, _ = code.steps(data[PAST - 1 : -1], data[PAST:])
    nodes, bits = code.nodes[steps], code.bits[steps]
    for table, width, context in zip(tables, SLOT_BITS, contexts(data)):
        table += np.bincount(slots(context[places], nodes, width) * 2 + bits, minlength=len(table))


def log_odds(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """In steps of 1 / ``GRAIN``; small numbers keep the tables in the processor's cache."""
    return np.clip(np.rint(GRAIN * np.log((ones + 0.4) / (zeros + 0.4))), -127, 127).astype(np.int8)


# ---- counts by context, as rows

def pieces(text: bytes) -> Iterator[tuple[np.ndarray, bool]]:
    """A text in pieces, each with its past in front, and whether the text ends there; scored and counted alike."""
    data = np.concatenate([PADDING, np.frombuffer(text, np.uint8)])
    for at in range(0, max(len(text), 1), BATCH_BYTES):
        yield data[at : at + BATCH_BYTES + PAST], at + BATCH_BYTES >= len(text)


def keyed(context: np.ndarray, before: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Context, byte before and symbol in one number."""
    return context | (before.astype(np.uint64) << np.uint64(9)) | symbols.astype(np.uint64)


def keys_of(held: list[tuple[np.ndarray, bool]]) -> list[np.ndarray]:
    """Of each predictor the keys of all symbols of the pieces, ends included and each piece's past left out."""
    data = np.concatenate([part for piece, ends in held for part in ((piece, np.zeros(1, np.uint8)) if ends else (piece,))])
    lengths = np.array([len(piece) + ends for piece, ends in held])
    starts = np.cumsum(lengths) - lengths
    symbols, own = data.astype(np.uint64), np.ones(len(data), bool)
    symbols[(starts + lengths - 1)[[ends for _, ends in held]]] = END
    own[(starts[:, None] + np.arange(PAST)).ravel()] = False
    own = np.flatnonzero(own[PAST:])
    return [keyed(c, data[PAST - 1 : -1], symbols[PAST:])[own] for c in contexts(data, starts)]


def summed_keys(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is there."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(first) else counts


class Tally:
    """Distinct keys of texts with their counts, in memory that follows the distinct ones."""

    def __init__(self):
        self.sums = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * PREDICTORS
        self.parts: list[list] = [[] for _ in range(PREDICTORS)]
        self.held, self.size = [], 0

    def add(self, text: bytes) -> None:
        for piece in pieces(text):
            self.held.append(piece)
            self.size += len(piece[0]) + 1
            if self.size > 8 * BATCH_BYTES:
                self._close()

    def _close(self) -> None:
        if self.held:
            for k, keys in enumerate(keys_of(self.held)):
                self.parts[k].append(summed_keys(keys))
            self.held, self.size = [], 0
            if sum(len(keys) for keys, _ in self.parts[-1]) > FLUSH_KEYS:
                self._merge()

    def _merge(self) -> None:
        for k, parts in enumerate(self.parts):
            all_keys, all_counts = zip(self.sums[k], *parts)
            self.sums[k] = summed_keys(np.concatenate(all_keys), np.concatenate(all_counts))
            parts.clear()

    def total(self) -> list[tuple[np.ndarray, np.ndarray]]:
        self._close()
        self._merge()
        return self.sums

    def n_keys(self) -> int:
        return sum(len(keys) for keys, _ in self.sums)


def pack(keys: np.ndarray) -> bytes:
    """Ordered keys as differences, byte by byte of equal weight, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return len(keys).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def grouped(keys: np.ndarray, group_bits: int) -> Iterator[tuple[int, slice]]:
    """Group numbers, the upper bits, and places of ordered keys."""
    groups = (keys >> np.uint64(64 - group_bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), groups[1:] != groups[:-1]]))
    for at, to in zip(first, np.append(first[1:], len(keys))):
        yield int(groups[at]), slice(at, to)


def path_steps(keys: np.ndarray, code: BitCode) -> tuple[np.ndarray, np.ndarray]:
    """Places and node ids of each key's bits, and the steps in the code."""
    places, steps, _ = code.steps((keys >> np.uint64(9)) & np.uint64(255), (keys & np.uint64(511)).astype(np.int64))
    return places, steps


class NodeOdds:
    """Log odds of the nodes of one group's contexts, from its summed keys; counts may have several columns, each with odds of its own."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, code: BitCode):
        self.code = code
        places, steps = path_steps(keys, code)
        ids, bits = node_ids((keys & ~LOW)[places], code.nodes[steps]), code.bits[steps]
        order = np.argsort(ids)
        ids, places, bits = ids[order], places[order], bits[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(len(ids), 1), bool), ids[1:] != ids[:-1]]))
        self.ids = ids[first]

        def odds_of(column: np.ndarray) -> np.ndarray:
            n = column[places]
            ones = np.add.reduceat(n * bits, first) if len(first) else n
            return log_odds(ones, (np.add.reduceat(n, first) if len(first) else n) - ones)

        self.odds = odds_of(counts) if counts.ndim == 1 else np.stack([odds_of(column) for column in counts.T])

    def along(self, keys: np.ndarray) -> np.ndarray:
        """The odds of every bit of the keys, one after another; 0 for a node that was never met."""
        places, steps = path_steps(keys, self.code)
        if not len(self.ids):
            return np.zeros((*self.odds.shape[:-1], len(places)), np.int8)
        ids = node_ids((keys & ~LOW)[places], self.code.nodes[steps])
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return np.where(self.ids[at] == ids, self.odds[..., at], 0).astype(np.int8)


class PathOdds:
    """The odds that a unit of texts asked for, found by key in a table with linear probing."""

    def __init__(self, keys: np.ndarray, odds: np.ndarray, code: BitCode):
        self.keys, self.odds = keys, odds
        lengths = code.lengths.take(((keys & LOW) >> np.uint64(9)).astype(np.int64) * SYMBOLS + (keys & np.uint64(511)).astype(np.int64))
        if lengths.sum() != len(odds):
            raise ValueError("a unit of texts did not get all its counts")
        self.starts = np.cumsum(lengths) - lengths
        self.width = max(int(2 * len(keys)).bit_length(), 4)
        self.table = np.full(1 << self.width, -1, np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._first(keys)
        while len(left):
            free = self.table[at] < 0
            self.table[at[free]] = left[free]
            lost = self.table[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self.table) - 1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.width)).astype(np.int64)

    def take(self, keys: np.ndarray, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        at = self._first(keys)
        found = self.table.take(at)
        wrong = np.flatnonzero(self.keys.take(found) != keys)
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.table) - 1)
            found[wrong] = self.table.take(at[wrong])
            wrong = wrong[self.keys.take(found[wrong]) != keys[wrong]]
        return self.odds.take(np.arange(len(places)) + (self.starts.take(found) - (np.cumsum(lengths) - lengths)).take(places))


def block_edges(n: int) -> np.ndarray:
    """Blocks of 16 symbols, twice as many each time up to ``BLOCK``, so that short texts are refined too."""
    grown = np.cumsum([0] + [16 << k for k in range((BLOCK // 16).bit_length())])
    edges = np.concatenate([grown, np.arange(grown[-1] + BLOCK, n, BLOCK)])
    return np.append(edges[edges < n], n)


class Mixer:
    """Log odds of all predictors, from counts in one process or as given for the texts at hand, and the gated weights."""

    def __init__(self, code: BitCode, counts: np.ndarray | None = None, given: list[PathOdds] | None = None):
        self.code, self.given = code, given
        self.odds = [] if counts is None else [log_odds(table[1::2], table[::2]) for table in tables_of(counts)]
        self.weights = np.full((GATES, PREDICTORS), 0.3 / GRAIN, np.float32)
        # bits that the weights of each gate were fitted on
        self.fitted = np.zeros(GATES, np.int64)

    def bits(self, data: np.ndarray, ends: bool) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of all predictors in steps of 1 / ``GRAIN``, gate and sign for each bit of a text after its past, and the symbols' bit counts."""
        symbols = data[PAST:].astype(np.int64)
        if ends:
            data, symbols = np.append(data, np.uint8(0)), np.append(symbols, END)
        places, steps, lengths = self.code.steps(data[PAST - 1 : -1], symbols)
        if self.given is not None:
            before = data[PAST - 1 : -1]
            odds = [given.take(keyed(context, before, symbols), places, lengths) for given, context in zip(self.given, contexts(data, np.zeros(1, np.int64)))]
        else:
            nodes = self.code.nodes[steps]
            odds = [table.take(slots(context[places], nodes, width)) for table, width, context in zip(self.odds, SLOT_BITS, contexts(data))]
        seen = (odds[0] != 0).astype(np.int8) + (odds[-2] != 0) + (odds[-1] != 0)
        return [o.astype(np.float32) for o in odds], (seen * np.int8(4) + self.code.depths.take(steps)).astype(np.int64), self.code.signs.take(steps), lengths

    def fit(self, texts: list[np.ndarray], rounds: int = 3, rate: float = 0.02) -> "Mixer":
        """Gated weights by online gradient steps over blocks of ``texts``, round after round."""
        blocks = []
        for odds, gates, signs in (self.bits(*piece)[:3] for data in texts for piece in pieces(data.tobytes())):
            for at in range(0, len(gates), 4 * BLOCK):
                part = slice(at, at + 4 * BLOCK)
                size = np.bincount(gates[part], minlength=GATES)
                self.fitted += size
                blocks.append(([o[part] for o in odds], gates[part], signs[part], np.sqrt(np.maximum(size, 1))))
        for turn in range(rounds):
            for inputs, gates, signs, root in blocks:
                margin = self.weights[:, 0].take(gates) * inputs[0]
                for k in range(1, PREDICTORS):
                    margin += self.weights[:, k].take(gates) * inputs[k]
                np.clip(margin, -12, 12, out=margin)
                margin *= signs
                np.exp(margin, out=margin)
                margin += 1
                missed = signs / margin
                for k in range(PREDICTORS):
                    self.weights[:, k] += rate / GRAIN**2 / (1 + turn) * np.bincount(gates, missed * inputs[k], GATES) / root
        return self

    def cost(self, texts: list[tuple[np.ndarray, bool]], shifts: np.ndarray, rate: float = 0.03) -> tuple[np.ndarray, np.ndarray]:
        """Natural-log cost of texts (each with its past in front; whether it ends), and the refined ``shifts`` of their weights.

        All texts move on block by block together, each with its own shifts.
        """
        loss = np.zeros(len(texts))
        shifts = shifts.copy()
        weights = np.ascontiguousarray(self.weights.T)
        made = [self.bits(data, ends) for data, ends in texts]
        edges = [np.concatenate([[0], np.cumsum(m[3])])[block_edges(len(m[3]))] for m in made]
        for step in range(max(len(e) for e in edges) - 1):
            live = [t for t in range(len(texts)) if len(edges[t]) > step + 1 and edges[t][step + 1] > edges[t][step]]
            if not live:
                continue
            cut = [slice(edges[t][step], edges[t][step + 1]) for t in live]
            lengths = np.array([c.stop - c.start for c in cut])
            starts = np.cumsum(lengths) - lengths
            gates = np.concatenate([made[t][1][c] for t, c in zip(live, cut)])
            signs = np.concatenate([made[t][2][c] for t, c in zip(live, cut)])
            inputs = [np.concatenate([made[t][0][k][c] for t, c in zip(live, cut)]) for k in range(PREDICTORS)]
            margin = np.zeros(len(gates), np.float32)
            for k in range(PREDICTORS):
                margin += (weights[k].take(gates) + np.repeat(shifts[live, k], lengths)) * inputs[k]
            missed = np.exp(-np.clip(margin, -12, 12) * signs)
            missed += 1
            loss[live] += np.add.reduceat(np.log(missed), starts, dtype=np.float64)
            missed = signs * (1 - 1 / missed)
            for k in range(PREDICTORS):
                shifts[live, k] += rate / GRAIN**2 / np.sqrt(lengths) * np.add.reduceat(missed * inputs[k], starts)
        return loss, shifts


def log10_probabilities(texts: list[bytes], mixer: Mixer) -> np.ndarray:
    """log10 probability of each text, its end included; long texts are taken in pieces."""
    result = np.zeros(len(texts))
    group, size = [], 0

    def close(numbers: list[int]) -> None:
        cost, _ = mixer.cost([(np.concatenate([PADDING, np.frombuffer(texts[i], np.uint8)]), True) for i in numbers], np.zeros((len(numbers), PREDICTORS), np.float32))
        result[numbers] = cost

    for number, text in enumerate(texts):
        if len(text) > BATCH_BYTES:
            shifts = np.zeros((1, PREDICTORS), np.float32)
            for piece in pieces(text):
                cost, shifts = mixer.cost([piece], shifts)
                result[number] += cost[0]
            continue
        group.append(number)
        size += len(text)
        if size > BATCH_BYTES:
            close(group)
            group, size = [], 0
    if group:
        close(group)
    return -result / np.log(10)


# ---- over tables

COUNTS = pa.schema([("predictor", pa.int32()), ("grp", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])
COUNTS_SQL = "predictor int, grp bigint, keys binary, n binary"
ANSWERS = pa.schema([("unit", pa.int64()), ("predictor", pa.int32()), ("grp", pa.int64()), ("odds", pa.binary()), ("unseen_odds", pa.binary())])
ANSWERS_SQL = "unit bigint, predictor int, grp bigint, odds binary, unseen_odds binary"
# texts in blocks and what they ask for; a block has no predictor
UNITS = pa.schema([("unit", pa.int64()), ("predictor", pa.int32()), ("grp", pa.int64()), ("keys", pa.binary())])
UNITS_SQL = "unit bigint, predictor int, grp bigint, keys binary"
WEIGHTS = pa.schema([("gate", pa.int32()), ("n", pa.int64()), *((f"w{k}", pa.float64()) for k in range(PREDICTORS))])
WEIGHTS_SQL = "gate int, n bigint, " + ", ".join(f"w{k} double" for k in range(PREDICTORS))


def _record(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _narrow(n: np.ndarray) -> bytes:
    """Counts by fold in as few bytes as the largest needs."""
    return n.T.astype(next(f"<u{width}" for width in (1, 2, 4, 8) if n.max(initial=0) < 1 << 8 * width)).tobytes()


def _counted(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [unpack(k.as_py()) for k in rows.column("keys")]
    n = [np.frombuffer(b.as_py(), f"<u{len(b.as_py()) // max(FOLDS * len(k), 1) or 1}").astype(np.int64).reshape(FOLDS, -1).T for b, k in zip(rows.column("n"), keys)]
    return np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros((0, FOLDS), np.int64), *n])


def _by_fold(tallies: list[Tally]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each predictor the keys of all folds, with a column of counts for each fold."""
    for sums in zip(*[tally.total() for tally in tallies]):
        counts = np.zeros((sum(len(keys) for keys, _ in sums), FOLDS), np.int64)
        at = 0
        for fold, (keys, n) in enumerate(sums):
            counts[at : at + len(keys), fold] = n
            at += len(keys)
        yield summed_keys(np.concatenate([keys for keys, _ in sums]), counts)


def _text_block(rows: list[pa.RecordBatch]) -> bytes:
    """Rows as one compressed parcel."""
    table = pa.Table.from_batches(rows).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _texts_of(blocks: pa.Table) -> tuple[pa.Table, list[bytes]]:
    """The rows of a unit in their order, and their texts."""
    rows = pa.concat_tables([pa.ipc.open_stream(block.as_py()).read_all() for block in blocks.column("keys")]).sort_by("row")
    return rows, [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in rows.column("text")]


def _keys_of_texts(texts: list[bytes]) -> list[np.ndarray]:
    tally = Tally()
    for text in texts:
        tally.add(text)
    return [keys for keys, _ in tally.total()]


def _given(keys: list[np.ndarray], answers: pa.Table, code: BitCode, name: str) -> list[PathOdds]:
    """The answers to one unit, put together in the order of its keys, which is that of the groups."""
    ordered = answers.sort_by([("predictor", "ascending"), ("grp", "ascending")])
    predictor = ordered.column("predictor").to_numpy()
    odds = [np.frombuffer(pa.decompress(o.as_py()[8:], int.from_bytes(o.as_py()[:8], "little"), "zstd"), np.int8) for o in ordered.column(name)]
    return [PathOdds(k, np.concatenate([np.zeros(0, np.int8), *[o for o, p in zip(odds, predictor) if p == number]]), code) for number, k in enumerate(keys)]


def score_texts(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", known_words: int = 1 << 20, weight_texts: int = 256,
) -> DataFrame:
    """doc_id, is_training, n_bytes, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte for every row of ``docs``.

    ``training`` marks the rows to learn from; null counts as not. The base is
    the add-half unigram probability of the words and one end. ``score`` is
    log10 of the mixing model's probability of the whole text. A null text is
    an empty one, which has its end only; repeated rows are scored and learned
    one by one; other columns are ignored; an empty table gives an empty one.

    All training rows are counted, and all of them fit the gated weights:
    equal texts are in one of two folds, and a text's bits are judged by the
    counts of the other fold. Each unit of texts fits weights of its own, going
    through groups of up to ``weight_texts`` texts in rounds; the mean of all
    units', each gate's bits counting alike, is the model. Contexts and their counts are Spark rows, whose
    number follows the training bytes; every unit of texts gets the counts of
    its own contexts in a join, so no task holds them all. Of the words, the
    most frequent ones, at most ``known_words``, are broadcast as hashes with
    their counts; the others meet their counts in a join.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    table = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("is_training"))
    learned = table.filter("is_training")

    counts = stage(learned.select("text").mapInArrow(_count_rows, "kind int, key binary, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n")), "word-counts")
    words = counts.filter("kind = 0").select("key", "n")
    levels = [F.sum((F.col("n") >= float(1 << k)).cast("bigint")).alias(f"l{k}") for k in range(48)]
    summed = words.agg(F.count(F.lit(1)).alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"), *levels).first()
    small = {(r["kind"], bytes(r["key"])): r["n"] for r in counts.filter("kind > 0").collect()}
    ends = small.get((1, b""), 0)
    tokens, kinds = summed["total"] + ends, summed["distinct"] + (ends > 0)
    least = next(1 << k for k in range(48) if (summed[f"l{k}"] or 0) <= known_words)
    frequent = words.filter(F.col("n") >= least)
    shared_words = frequent.select(F.col("key"), F.col("n")).mapInArrow(_hashed, "h bigint, n bigint").toArrow()
    order = np.argsort(hashes := shared_words.column("h").to_numpy().view(np.uint64), kind="stable")
    known = spark.sparkContext.broadcast((hashes[order], shared_words.column("n").to_numpy()[order]))

    # the bit code and the counts by fold
    pairs = np.zeros(256 * SYMBOLS, np.int64)
    for (kind, key), n in small.items():
        if kind == 2:
            pairs[int.from_bytes(key, "little")] = n
    code = BitCode(pairs.reshape(256, SYMBOLS))
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")
    group_bits = max(LEAST_GROUPS, -(-small.get((3, b""), 0) // GROUP_BYTES) - 1).bit_length()
    shared_code = sent(spark.sparkContext, code)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(tallies: list[Tally]) -> Iterator[pa.RecordBatch]:
            for k, (keys, n) in enumerate(_by_fold(tallies)):
                for group, part in grouped(keys, group_bits):
                    yield _record(COUNTS, [[k], [group], [pack(keys[part])], [_narrow(n[part])]])

        own = [Tally() for _ in range(FOLDS)]
        for batch in batches:
            for text, number in zip(batch.column(0), batch.column(1).to_pylist()):
                own[number].add((text.as_py() or "").encode("utf-8", "surrogatepass"))
                if sum(t.n_keys() for t in own) > 2 * FLUSH_KEYS:
                    yield from rows(own)
                    own = [Tally() for _ in range(FOLDS)]
        yield from rows(own)

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows, numbered and dealt to units of one fold each, the lowest bit of a unit's number, and what each unit asks for."""
        first = number = TaskContext.get().partitionId() << 40
        opened = TaskContext.get().partitionId() << 32
        unit, held, held_bytes, size, own = ([None] * FOLDS for _ in range(5))

        def open_unit(f: int) -> None:
            nonlocal opened
            unit[f], held[f], held_bytes[f], size[f], own[f] = opened * FOLDS + f, [], 0, 0, Tally()
            opened += 1

        def block(f: int) -> pa.RecordBatch:
            made = _record(UNITS, [[unit[f]], [None], [None], [_text_block(held[f])]])
            held[f], held_bytes[f] = [], 0
            return made

        def close_unit(f: int) -> Iterator[pa.RecordBatch]:
            if held[f]:
                yield block(f)
            for k, (keys, _) in enumerate(own[f].total()):
                for group, part in grouped(keys, group_bits):
                    yield _record(UNITS, [[unit[f]], [k], [group], [pack(keys[part])]])
            unit[f] = None

        for batch in batches:
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(number, number + batch.num_rows)), *batch.columns[:3]], ["row", "doc_id", "text", "is_training"])
            number += batch.num_rows
            for at, f in enumerate(batch.column(3).to_pylist()):
                if unit[f] is None:
                    open_unit(f)
                text = (rows.column(2)[at].as_py() or "").encode("utf-8", "surrogatepass")
                own[f].add(text)
                held[f].append(rows.slice(at, 1))
                held_bytes[f] += len(text) + 64
                size[f] += len(text) + 64
                if held_bytes[f] > TEXT_BLOCK:
                    yield block(f)
                if size[f] > UNIT_BYTES:
                    yield from close_unit(f)
        for f in range(FOLDS):
            if unit[f] is not None:
                yield from close_unit(f)

    def answer(counts: pa.Table, asked: pa.Table) -> pa.Table:
        """The odds of all bits that the units ask of one group: by all counts, and by those of the folds that a unit is not in."""
        if not asked.num_rows:
            return ANSWERS.empty_table()
        keys, n = summed_keys(*_counted(counts))
        total = n.sum(1)
        made = NodeOdds(keys, np.column_stack([total, *(total - own for own in n.T)]), received(shared_code))
        odds, unseen = [], []
        for asking, wanted in zip(asked.column("unit").to_pylist(), asked.column("keys")):
            found = made.along(unpack(wanted.as_py()))
            for parcels, row in ((odds, found[0]), (unseen, found[1 + asking % FOLDS])):
                parcels.append(len(row).to_bytes(8, "little") + pa.compress(row.tobytes(), "zstd", asbytes=True))
        return pa.table([asked.column("unit"), asked.column("predictor"), asked.column("grp"), pa.array(odds, pa.binary()), pa.array(unseen, pa.binary())], schema=ANSWERS)

    def fit(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        """The weights that one unit's training texts fit, by gate with the bits they rest on."""
        rows, texts = _texts_of(blocks)
        fitting = Mixer(received(shared_code), given=_given(_keys_of_texts(texts), answers, received(shared_code), "unseen_odds"))
        group, size = [], 0
        for text, learns in zip(texts, rows.column("is_training").to_pylist()):
            if learns:
                group.append(np.frombuffer(text, np.uint8))
                size += len(text)
                if len(group) >= weight_texts or size > 8 * BATCH_BYTES:
                    fitting.fit(group)
                    group, size = [], 0
        fitting.fit(group)
        used = np.flatnonzero(fitting.fitted)
        n = fitting.fitted[used]
        return pa.table([pa.array(used, pa.int32()), n, *(fitting.weights[used].astype(np.float64) * n[:, None]).T], schema=WEIGHTS)

    dealt = stage(table.select("doc_id", "text", "is_training", fold).mapInArrow(units, UNITS_SQL), "units")
    forget(spark)
    asked_of = dealt.filter("predictor is not null").groupBy("predictor", "grp")
    context_counts = learned.select("text", fold).mapInArrow(tally, COUNTS_SQL)
    answers = stage(context_counts.groupBy("predictor", "grp").cogroup(asked_of).applyInArrow(answer, ANSWERS_SQL), "answers")
    forget(spark)
    blocks_of = dealt.filter("predictor is null").groupBy("unit")
    mean = [F.sum(f"w{k}") / F.sum("n") for k in range(PREDICTORS)]
    fits = blocks_of.cogroup(answers.drop("odds").groupBy("unit")).applyInArrow(fit, WEIGHTS_SQL)
    mixer = Mixer(code)
    for row in fits.groupBy("gate").agg(F.array(*mean).alias("weights")).collect():
        mixer.weights[row["gate"]] = row["weights"]
    model = sent(spark.sparkContext, mixer)
    forget(spark)

    half, whole = 0.5, np.log10(tokens + 0.5 * (kinds + 1))
    end_score = float(np.log10(ends + half) - whole)

    def score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, ns = known.value

        def look(word: bytes):
            h = np.uint64(xxhash.xxh3_64_intdigest(word))
            at = int(np.searchsorted(hashes, h))
            return float(np.log10(ns[at] + half) - whole) if at < len(hashes) and hashes[at] == h else None

        memo = Memo(look, MEMO_WORDS)
        rows, texts = _texts_of(blocks)
        base, n_known, n_tokens, rest, rest_n = [], [], [], [], []
        for text in texts:
            split = text.lower().split()
            logs = list(map(memo.__getitem__, split))
            missing = Counter([w for w, v in zip(split, logs) if v is None]) if None in logs else {}
            n_tokens.append(len(split) + 1)
            absent = sum(missing.values())
            n_known.append(len(split) - absent + (ends > 0))
            base.append(sum(v for v in logs if v is not None) + end_score)
            rest.append(list(missing))
            rest_n.append(list(missing.values()))
        fitted = received(model)
        mixing = Mixer(fitted.code, given=_given(_keys_of_texts(texts), answers, fitted.code, "odds"))
        mixing.weights = fitted.weights
        return pa.table(
            [
                rows.column("row"), rows.column("doc_id"), rows.column("is_training"), pa.array([len(t) for t in texts], pa.int64()),
                pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                pa.array(log10_probabilities(texts, mixing), pa.float64()), pa.array(rest, pa.list_(pa.binary())), pa.array(rest_n, pa.list_(pa.int64())),
            ],
            ["row", "doc_id", "is_training", "n_bytes", "n_tokens", "known", "base", "score", "rest", "rest_n"],
        )

    scored = stage(
        blocks_of.cogroup(answers.drop("unseen_odds").groupBy("unit")).applyInArrow(
            score,
            f"row bigint, doc_id {id_type}, is_training boolean, n_bytes bigint, n_tokens bigint, known bigint, base double, score double, rest array<binary>, rest_n array<bigint>",
        ),
        "scored",
    )
    release(dealt, answers)
    rare = scored.select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("w")).select("row", F.col("w.rest").alias("key"), F.col("w.rest_n").alias("times"))
    met = rare.join(words.filter(F.col("n") < least), "key", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + half) - F.lit(float(whole)))).alias("rest_score"),
    )
    bits = F.col("score") * F.lit(-float(np.log2(10)))
    return scored.drop("rest", "rest_n").join(met, "row", "left").select(
        "doc_id", "is_training", "n_bytes", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_score", F.lit(0.0))).alias("base_score"),
        "score", F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"),
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in batch.column(0).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column(1)], ["h", "n"])
