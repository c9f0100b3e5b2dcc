"""Similarity join on word shingles with a token-group matrix.

Similar documents are put into groups, and of each group the union of its
tokens is kept. For a query set the overlap with a union bounds its overlap
with every member, so only groups whose bound reaches the threshold are opened
and compared set by set. The join is exact: it finds every link.

Groups are stars that hang together. Under each of several hash functions,
documents with the same smallest hash of a shingle are compared with one
leader, the one whose tokens are the most frequent; those that link to it join
its group, and groups that share a document are one. Others are groups of their
own. Columns of the matrix are met by their rarest tokens
first: a set that links with another shares one of its rarest tokens with it,
and the number of such tokens that two groups share bounds any overlap between
members. Texts are read again for the few documents of qualifying groups, so
that no table of all tokens is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.components import components
from gleaner.llm.memo import tidy
from gleaner.llm.stripes import SCHEMA, stripes_of, sum_stripes
from gleaner.sources.scratch import forget, release, stage

# Texts are hashed in runs of about so many characters.
RUN_CHARS = 1 << 16
CELLS = 1 << 20
CHUNK_SETS = 64
# Hash functions under which documents may meet a leader.
STAR_HASHES = 4
# Each group is compared with its likeliest partners first; later ones only where they are not connected by then.
ROUNDS = ((0, 4), (4, 64), (64, 1 << 31))
ODD = [np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * k & 0xFFFFFFFFFFFFFFFF | 1) for k in range(64)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the shingles of texts."""

    def __init__(self, width: int):
        self.width = width

    def of_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The sets of all texts one after another, and where each begins, the end last.

        Texts are hashed together, as most of the time for a short one would
        go into the calls.
        """
        words, ends, short = [], [0], []
        for text in texts:
            own = text.encode("utf-8", "surrogatepass").lower().split() if text else []
            if 0 < len(own) < self.width:
                short.append((len(words), xxhash.xxh3_64_intdigest(b" ".join(own), seed=len(own))))
            words += own
            ends.append(len(words))
        hashes = np.zeros(len(words) + self.width - 1, np.uint64)
        hashes[: len(words)] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        sums = np.zeros(len(words), np.uint64)
        for k in range(self.width):
            sums += hashes[k : k + len(words)] * ODD[k]
        # a shingle at every word: those that run on into the next text do not count
        made, counts = mixed(sums), np.zeros(len(words), bool)
        for start, end in zip(ends, ends[1:]):
            last = max(end - self.width + 1, start)
            made[start:last].sort()
            counts[start:last] = True
            counts[start + 1 : last] = made[start + 1 : last] != made[start : max(last - 1, start)]
        for at, whole in short:
            made[at], counts[at] = whole, True
        return made[counts], np.concatenate([[0], np.cumsum(counts)])[ends]


def together(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column in runs of about ``RUN_CHARS`` characters."""
    held, size = [], 0
    for text in column:
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size > RUN_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def required(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any set that it links with."""
    return -(-percent * n // 100)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= percent * (len(a) + len(b) - inter)


# ---- passes over the texts

def _frequency_classes(texts: DataFrame, width: int) -> np.ndarray:
    """How frequent the shingles of each of ``CELLS`` hash cells are, as a quarter of the binary logarithm.

    Every document counts. A task adds up its own cells, stripes of cells are
    added up in two rounds, and the result has ``CELLS`` bytes whatever the
    size of the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            held, size = [], 0
            for texts in together(batch.column(0)):
                held.append((shingler.of_all(texts)[0] & np.uint64(CELLS - 1)).astype(np.int32))
                size += len(held[-1])
                if size > CELLS:
                    total += np.bincount(np.concatenate(held), minlength=CELLS)
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=CELLS)
        yield from stripes_of(total)

    cells = sum_stripes(texts.mapInArrow(tidy(count), SCHEMA), CELLS)
    return (4 * np.log2(1.0 + cells)).astype(np.uint8)


def _digested(docs: DataFrame, id_type: str, classes: np.ndarray, width: int, percent: int) -> DataFrame:
    """Per document: set size, digest of the set, smallest hashes, how frequent its tokens are, and the rarest tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        frequency = shared.value
        for batch in (whole.slice(at, 1024) for whole in batches for at in range(0, whole.num_rows, 1024)):
            sizes, digests, lowest, common, rare = [], [], [], [], []
            for texts in together(batch.column(1)):
                tokens, ends = shingler.of_all(texts)
                often = frequency[(tokens & np.uint64(CELLS - 1)).astype(np.int64)]
                order = (often.astype(np.uint64) << np.uint64(56)) | (tokens >> np.uint64(8))
                n = np.diff(ends)
                sizes += n.tolist()
                least, mean = [None] * len(n), np.zeros(len(n), np.int64)
                some = np.flatnonzero(n)
                if len(some):
                    # an empty set takes no place, so that each of the others ends where the next begins
                    starts = ends[some]
                    of_hash = [np.minimum.reduceat(mixed(tokens + ODD[5 + k]), starts).view(np.int64).tolist() for k in range(STAR_HASHES)]
                    for at, low in zip(some.tolist(), zip(*of_hash)):
                        least[at] = low
                    mean[some] = 1000 * (np.add.reduceat(often.astype(np.int64), starts) / n[some])
                lowest += least
                common += mean.tolist()
                for start, end in zip(ends.tolist(), ends[1:].tolist()):
                    own = tokens[start:end]
                    digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                    kept = end - start - required(end - start, percent) + 1 if end > start else 0
                    rare.append(own[np.argsort(order[start:end], kind="stable")[:kept]].view(np.int64))
            lengths = np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32)
            tokens = pa.array(np.concatenate(rare) if rare else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(lowest, pa.list_(pa.int64())), pa.array(common, pa.int64()), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), tokens)],
                ["doc_id", "n", "digest", "lowest", "common", "rare"],
            )

    return docs.mapInArrow(tidy(digest), f"doc_id {id_type}, n bigint, digest binary, lowest array<bigint>, common bigint, rare array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Token sets of ``wanted(digest, first_id, ...)`` from the texts, one row per wanted row; columns of ``wanted`` are kept."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in (whole.slice(at, 1024) for whole in batches for at in range(0, whole.num_rows, 1024)):
            made = []
            for texts in together(batch.column("text")):
                tokens, ends = shingler.of_all(texts)
                made += [tokens[start:end].tobytes() for start, end in zip(ends.tolist(), ends[1:].tolist())]
            right = [xxhash.xxh3_128_digest(m) == d for m, d in zip(made, batch.column("digest").to_pylist())]
            columns = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary())], [*names, "tokens"]).filter(pa.array(right, pa.bool_()))

    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["first_id"])).select("text", *wanted.columns)
    made = found.mapInArrow(tidy(tokens), ", ".join(f"{c} {t}" for c, t in found.drop("text").dtypes) + ", tokens binary")
    return made.dropDuplicates(["digest"])


# ---- candidates

def _shared_tokens(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups and the number of rare tokens that both have: x, y, shared.

    ``postings(token, grp, lo, hi, leading)``: the sizes of a group's sets with
    the token among their rare ones, and the smallest size of those with it
    among their leading ones, null without any. Of two sets that link, one of
    the smaller one's leading tokens is a rare one of the other; sets that
    merely resemble each other share rare tokens, but no leading ones. Groups
    whose sizes cannot link are not paired. The tokens meet in a join, whose
    crowded partitions Spark splits.
    """
    small = postings.filter(F.col("leading").isNotNull()).select("token", *[F.col(c).alias(f"small_{c}") for c in ("grp", "lo", "hi", "leading")])
    leads = lambda leading, hi: F.coalesce(F.col(leading) <= F.col(hi), F.lit(False))
    fits = (F.lit(100) * F.col("hi") >= percent * F.col("small_lo")) & (F.lit(100) * F.col("small_hi") >= percent * F.col("lo"))
    # where either could be the smaller one, the pair counts once
    once = (F.col("small_grp") < F.col("grp")) | ~leads("leading", "small_hi")
    met = small.join(postings, "token").filter((F.col("small_grp") != F.col("grp")) & leads("small_leading", "hi") & fits & once)
    return met.groupBy(F.least("small_grp", "grp").alias("x"), F.greatest("small_grp", "grp").alias("y")).agg(F.count(F.lit(1)).alias("shared"))


def _ceil_share(n: Column, percent: int, of: int = 100) -> Column:
    return F.ceil(n * percent / of)


# ---- opening groups

def _linked(opened: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups with a link between members, from rows (x, y, left, right) of bundles of sets.

    For each set on the left its overlap with the union on the right comes
    first; members are compared only where it can reach the threshold. One
    link is enough, as the members of a group hang together.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for row in range(batch.num_rows):
                left = [np.frombuffer(t, np.uint64) for t in batch.column("left")[row].as_py()]
                right = [np.frombuffer(t, np.uint64) for t in batch.column("right")[row].as_py()]
                union = np.unique(np.concatenate(right)) if len(right) > 1 else right[0]
                found = False
                for query in left:
                    bound = np.searchsorted(union, query)
                    bound[bound == len(union)] = 0
                    if (union[bound] == query).sum() >= required(len(query), percent) and any(links(query, member, percent) for member in right):
                        found = True
                        break
                hit.append(found)
            yield batch.select(["x", "y"]).filter(pa.array(hit, pa.bool_()))

    return opened.select("x", "y", "left", "right").mapInArrow(tidy(compare), "x binary, y binary").distinct()


def shingle_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    A document's set is that of its shingles of ``width`` words, ASCII letters
    in lower case; a shorter text is one shingle. Two link when the overlap is
    at least ``percent`` of the union. The component is the smallest id that
    links lead to; a document without words links with nothing and is its own,
    null texts too. Repeated rows and equal texts are one class, and of ids
    that are null the smallest other one counts. Other columns are ignored; an
    empty table gives an empty one. Sets are compared by 64-bit hashes of the
    shingles, which differ for different shingles but for one pair in 10^19.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    frequency = _frequency_classes(texts.select("text"), width)
    sets = stage(_digested(texts, id_type, frequency, width, percent), "sets")

    classes = stage(
        sets.filter(F.col("n") > 0).groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.min("n").alias("n"), F.min("lowest").alias("lowest"), F.min("common").alias("common")), "classes"
    )
    # an original has fewer tokens of its own than its edited copies, so the set of the most frequent tokens leads
    met = classes.select("digest", "common", F.posexplode("lowest").alias("hash", "low"))
    leaders = (
        met.groupBy("hash", "low").agg(F.max(F.struct("common", "digest"))["digest"].alias("leader"), F.count(F.lit(1)).alias("size"))
        .filter(F.col("size") > 1).drop("size")
    )
    # stars: every class of a bucket against the bucket's leader
    rays = stage(met.join(leaders, ["hash", "low"]).filter(F.col("digest") != F.col("leader")).select("digest", "leader").distinct(), "rays")
    concerned = rays.select("digest").unionByName(rays.select(F.col("leader").alias("digest"))).distinct()
    classes = classes.drop("common", "lowest")
    star_sets = stage(_sets(texts, classes.join(concerned, "digest").select("digest", "first_id"), width), "star-sets")
    forget(docs.sparkSession)
    members = star_sets.select("digest", F.array("tokens").alias("left"))
    heads = star_sets.select(F.col("digest").alias("leader"), F.array("tokens").alias("right"))
    against = rays.join(members, "digest").join(heads, "leader").select(F.col("digest").alias("x"), F.col("leader").alias("y"), "left", "right")
    stars = stage(_linked(against, percent), "stars")
    release(star_sets, rays)
    hung = stage(components(stars.select(F.col("x").alias("a"), F.col("y").alias("b"))), "star-groups")

    labelled = stage(
        classes.join(hung.select(F.col("node").alias("digest"), F.col("component").alias("label")), "digest", "left").withColumn("label", F.coalesce("label", "digest")), "labelled"
    )
    short = F.conv(F.substring(F.hex("label"), 1, 15), 16, 10).cast("bigint")
    groups = labelled.groupBy("label").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count(F.lit(1)).alias("members")).withColumn("grp", short)

    # the matrix by its rare columns
    of_both = 100 + percent
    by_class = labelled.select("digest", "n", short.alias("grp"))
    held = sets.select("digest", "rare").join(by_class, "digest").select("grp", "n", F.posexplode("rare").alias("place", "token"))
    # a set's rare tokens are those before the last of any overlap with a larger set, its leading ones with a set of its size
    leading = F.col("place") <= F.col("n") - _ceil_share(2 * F.col("n"), percent, of_both)
    postings = held.groupBy("token", "grp").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min(F.when(leading, F.col("n"))).alias("leading"))
    shared = _shared_tokens(postings, percent)
    x, y = (groups.select(*(F.col(c).alias(f"{side}_{c}") for c in ("grp", "label", "lo", "hi", "members"))) for side in "xy")
    reach = _ceil_share(F.col("x_lo") + F.col("y_lo"), percent, of_both)
    beyond = F.greatest(_ceil_share(F.greatest("x_hi", "y_hi"), percent), _ceil_share(2 * F.least("x_hi", "y_hi"), percent, of_both)) - 1
    qualifying = stage(
        shared.join(x, F.col("x") == F.col("x_grp")).join(y, F.col("y") == F.col("y_grp"))
        .filter(F.col("shared") >= reach - beyond)
        .select(
            F.col("x_label").alias("x"), F.col("y_label").alias("y"), (F.col("x_members") + F.col("y_members")).alias("members"),
            F.row_number().over(Window.partitionBy("x_label").orderBy(F.desc("shared"), "y_label")).alias("place"),
        ),
        "qualifying",
    )

    forget(docs.sparkSession)
    rows = stage(sets.select("doc_id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest")), "rows")
    release(sets)

    # open the groups that qualify, one set of each first
    concerned = qualifying.select(F.col("x").alias("label")).unionByName(qualifying.select(F.col("y").alias("label"))).distinct()
    named = labelled.select("digest", "first_id", "label")
    opened = stage(_sets(texts, named.filter(F.col("digest") == F.col("label")).join(concerned, "label").select("digest", "first_id", "label"), width), "opened")
    forget(docs.sparkSession)
    head = opened.select("label", F.array("tokens").alias("set"))
    found, known = None, None
    for first, last in ROUNDS:
        some = qualifying.filter((F.col("place") > first) & (F.col("place") <= last))
        links_now = stage(_linked(_with_sets(_between_components(some, known), head, head), percent), "leader-links")
        found = links_now if found is None else found.unionByName(links_now)
        known = stage(components(found.select(F.col("x").alias("a"), F.col("y").alias("b"))), "known")
    release(opened)
    # all members of those groups only that are still apart and have more than one
    apart = stage(_between_components(qualifying.filter(F.col("members") > 2), known).select("x", "y"), "apart")
    concerned = apart.select(F.col("x").alias("label")).unionByName(apart.select(F.col("y").alias("label"))).distinct()
    sizes = groups.select("label", "members")
    bundles = stage(
        _sets(texts, named.join(concerned, "label").select("digest", "first_id", "label"), width).join(sizes, "label")
        .withColumn("chunk", F.pmod(F.xxhash64("digest"), F.ceil(F.col("members") / CHUNK_SETS)))
        .groupBy("label", "chunk").agg(F.collect_list("tokens").alias("set")),
        "bundles",
    )
    forget(docs.sparkSession)
    more = stage(_linked(_with_sets(apart, bundles, bundles), percent), "member-links")
    release(bundles)

    all_links = found.unionByName(more).select(F.col("x").alias("a"), F.col("y").alias("b"))
    final = stage(components(all_links), "components")
    placed = labelled.join(final, labelled["label"] == final["node"], "left").select("digest", "first_id", F.coalesce("component", "label").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_digest = placed.join(smallest, "component").select("digest", "component_id")
    return rows.join(by_digest, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def _between_components(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
    """The pairs whose groups do not hang together already."""
    if known is None:
        return pairs
    return (
        pairs.join(known.select(F.col("node").alias("x"), F.col("component").alias("_cx")), "x", "left")
        .join(known.select(F.col("node").alias("y"), F.col("component").alias("_cy")), "y", "left")
        .filter(~F.coalesce(F.col("_cx") == F.col("_cy"), F.lit(False)))
        .drop("_cx", "_cy")
    )


def _with_sets(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (x, y, left, right) of the bundles on both sides of each pair."""
    return (
        pairs.select("x", "y")
        .join(left.select(F.col("label").alias("x"), F.col("set").alias("left")), "x")
        .join(right.select(F.col("label").alias("y"), F.col("set").alias("right")), "y")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the near copies: of each component the row with the smallest id stays.

    Texts without words all stay. Rows that share an id stay or go together,
    and those of them with equal texts count once. Columns are as they were.
    """
    groups = stage(shingle_groups(docs, id_col, text_col, width, percent), "groups")
    repeated = groups.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    stays = groups.filter((F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stay")).distinct()
    kept = docs.join(stays, docs[id_col].eqNullSafe(F.col("_stay")), "left_semi")
    if repeated.isEmpty():
        return kept
    again = stage(repeated, "repeated")
    single = kept.join(again, kept[id_col].eqNullSafe(again["doc_id"]), "left_anti")
    several = kept.join(again, kept[id_col].eqNullSafe(again["doc_id"]), "left_semi").dropDuplicates([id_col, text_col])
    return single.unionByName(several)
