"""Token ids in binary shards, with a minimal perfect hash index over the document keys.

A folder holds three tables. ``payload`` has one row per block of some megabytes:
the raw little-endian ids of neighbouring documents, as the width of the
vocabulary asks (2 or 4 bytes), with the documents' ids and lengths beside
them. A shard is the run of blocks that one task wrote, shards and blocks are
in ascending order of the document id. ``shards`` has one row per shard: its
files, its blocks and the ids before it. ``index`` has one folder per bucket of
keys with one row: the bit levels of a minimal perfect hash, and at each key's
slot a fingerprint, the shard, the block and the offset. Spark's own writers
commit all three, so that a task may be repeated at any time.

A search by key reads the buckets of its keys and then the files of the shards
that these name, in which only row groups with a named block are opened.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.memo import Memo, give_back, per_worker
from gleaner.llm.pretokens import Pieces, special_strings
from gleaner.llm.token_counts import byte_letters
from gleaner.sources.scratch import stage

MEMO_WORDS = 300_000
GROUP_CHARS = 4 << 20
BLOCK_BYTES = 1 << 20
BUCKET_KEYS = 1 << 16
ROWS_OPENED = 8  # blocks in a row group
PUSHED = 64
LEVELS = 40
PAYLOAD = "shard int, block int, first bigint, ids binary, doc_ids array<{0}>, lengths array<bigint>"


class TokenEncoder:
    """Packed ids of whole texts by the tokenizers library; words met before are looked up."""

    def __init__(self, model: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        self.merges = self.library.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.kind, self.width = f"<u{width}", width
        self.packed = [number.to_bytes(width, "little") for number in range(max(self.library.get_vocab().values()) + 1)]
        self.pieces = Pieces(special_strings(model))
        self.words = Memo(self._word, MEMO_WORDS)

    def _ids(self, token: str) -> bytes:
        """Ids of one pretoken by the library's own merges; it is cut already, so the library need not look for cuts."""
        return self._merged("".join(map(self.letters.__getitem__, token.encode())))

    def _merged(self, letters: str) -> bytes:
        return b"".join([self.packed[t.id] for t in self.merges.tokenize(letters)])

    def _word(self, key: str) -> bytes:
        if key.isalpha():  # one token; ASCII letters stand for themselves in the vocabulary's letters
            return self._merged(self.letters[32] + key) if key.isascii() else self._ids(" " + key)
        return b"".join(map(self._ids, self.pieces.tokens_of(key)))

    def encode(self, text: str) -> bytes:
        parts = []
        for number, segment in enumerate(self.pieces.segments(text)):
            if number % 2:
                parts.append(np.array([self.library.token_to_id(segment)], self.kind).tobytes())
            elif segment:
                parts += map(self.words.__getitem__, self.pieces.cut(segment))
        return b"".join(parts)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """As :meth:`encode` for many texts: the words of all plain ones are told apart first, and each is looked up once."""
        result: list[bytes | None] = [None] * len(texts)
        plain, marked = [], []
        for number, text in enumerate(texts):
            if self.pieces.is_plain(text) and len(self.pieces.segments(text)) == 1:
                plain.append(number)
                marked.append(self.pieces.marked(text))
            else:
                result[number] = self.encode(text)
        if plain:
            words = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
            coded = words.flatten().dictionary_encode()
            packed = pa.array(list(map(self.words.__getitem__, coded.dictionary.to_pylist())), pa.large_binary())
            # the words one after another: their bytes are those of the texts
            taken = packed.take(coded.indices)
            ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset)
            bounds = ends[words.offsets.to_numpy()].tolist()
            for number, first, last in zip(plain, bounds[:-1], bounds[1:]):
                result[number] = taken.buffers()[2][first:last].to_pybytes()
        return result


def write_payload(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> None:
    """Encode whole texts (null: empty), append ``end_id`` to each, write blocks in ascending id order.

    Null ids come first; rows with the same id are neighbours. A document is
    never cut, so a block may be as long as the longest document.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        model = file.read()
    parsed = json.loads(model)
    largest = max([end_id, *parsed["model"]["vocab"].values(), *(t["id"] for t in parsed["added_tokens"])])
    width = 2 if largest < 1 << 16 else 4
    end = end_id.to_bytes(width, "little")

    def encoded(encoder: TokenEncoder, column: pa.Array) -> Iterator[bytes]:
        """Packed texts, encoded some megabytes at a time."""
        group, size = [], 0
        for text in column:
            group.append(text.as_py() or "")
            size += len(group[-1])
            if size > GROUP_CHARS:
                yield from encoder.encode_all(group)
                group, size = [], 0
        yield from encoder.encode_all(group)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("token encoder", hash(model), width), lambda: TokenEncoder(model, width))
        shard = TaskContext.get().partitionId()
        state = {"block": 0, "first": 0}
        ids, keys, lengths, held = [], [], [], 0

        def full() -> pa.RecordBatch:
            row = [[shard], [state["block"]], [state["first"]], [b"".join(ids)], [keys], [lengths]]
            state["block"] += 1
            state["first"] += sum(lengths)
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], ["shard", "block", "first", "ids", "doc_ids", "lengths"])

        for batch in batches:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(batch.schema.field(0).type), pa.list_(pa.int64())]
            for key, packed in zip(batch.column(0).to_pylist(), encoded(encoder, batch.column(1))):
                packed += end
                ids.append(packed)
                keys.append(key)
                lengths.append(len(packed) // width)
                held += len(packed)
                if held >= block_bytes:
                    yield full()
                    ids, keys, lengths, held = [], [], [], 0
        if keys:
            yield full()
        ids, keys, lengths = [], [], []
        give_back()  # the words stay for the next task

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    ranged = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    schema = PAYLOAD.format(docs.schema[id_col].dataType.simpleString())
    ranged.mapInArrow(encode, schema).withColumn("width", F.lit(width)).write.option("parquet.block.row.count.limit", ROWS_OPENED).parquet(f"{folder}/payload")


def read_payload(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/payload")


def write_shard_table(spark: SparkSession, folder: str) -> None:
    """One row per shard that holds anything: shard, files, blocks, shard_start (ids in all shards before it)."""
    blocks = read_payload(spark, folder).select("shard", "block", "lengths", F.col("_metadata.file_name").alias("file"))
    shards = blocks.groupBy("shard").agg(
        F.collect_set("file").alias("files"), (F.max("block") + 1).alias("blocks"),
        F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("n"),
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.select("shard", "files", "blocks", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start")).write.parquet(f"{folder}/shards")


def directory(payload: DataFrame) -> DataFrame:
    """One row per document: doc_id, shard, block, at (ids before it in its shard), n_tokens. Reads no ids."""
    entries = payload.select("shard", "block", "first", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("place", "doc"))
    earlier = Window.partitionBy("shard", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return entries.select(
        F.col("doc.doc_ids").alias("doc_id"), "shard", "block",
        (F.col("first") + F.coalesce(F.sum("doc.lengths").over(earlier), F.lit(0))).alias("at"),
        F.col("doc.lengths").alias("n_tokens"),
    )


# ---- the index

def _key(doc_id: Column) -> Column:
    """Keys are the ids as text; a null id has a key that no text gives."""
    return F.coalesce(doc_id.cast("string"), F.lit("\0null"))


def _hashes(df: DataFrame, buckets: int) -> DataFrame:
    key = _key(F.col("doc_id"))
    return df.withColumns({"hash": F.xxhash64(key), "print": F.hash(key), "bucket": F.pmod(F.xxhash64(F.lit(1), key), F.lit(buckets)).cast("int")})


def _slots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each 64-bit hash among ``size`` bits at a level."""
    x = hashes ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(size)


def build_levels(hashes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Bit levels of a minimal perfect hash over distinct 64-bit ``hashes``, and each one's number from 0 to n-1.

    At every level a key that is alone at its place takes it, the others go on
    to the next. Keys that no level parts, as equal hashes, get -1.
    """
    levels, numbers, used = [], np.full(len(hashes), -1, np.int64), 0
    left = np.arange(len(hashes))
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(64, 2 * len(left))
        places = _slots(hashes[left], level, size)
        bits = np.bincount(places, minlength=size) == 1
        alone = bits[places]
        numbers[left[alone]] = used + (np.cumsum(bits) - 1)[places[alone]]
        used += int(bits.sum())
        levels.append(size.to_bytes(8, "little") + np.packbits(bits).tobytes())
        left = left[~alone]
    return levels, numbers


def find_numbers(levels: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """Number of each hash; -1 where no level has it. A key that was not built in may get any number."""
    numbers, used = np.full(len(hashes), -1, np.int64), 0
    left = np.arange(len(hashes))
    for level, packed in enumerate(levels):
        size = int.from_bytes(packed[:8], "little")
        bits = np.unpackbits(np.frombuffer(packed, np.uint8, offset=8), count=size).astype(bool)
        ranks = np.cumsum(bits) - 1
        places = _slots(hashes[left], level, size)
        hit = bits[places]
        numbers[left[hit]] = used + ranks[places[hit]]
        used += int(bits.sum())
        left = left[~hit]
    return numbers


FIELDS = {"print": "<i4", "shard": "<i4", "block": "<i4", "at": "<i8", "last_shard": "<i4", "last_block": "<i4", "n_ids": "<i8", "n_rows": "<i8"}
FOUND = {name: {"<i4": "int", "<i8": "bigint"}[kind] for name, kind in FIELDS.items() if name != "print"}
REST = ",".join(f"{name}:{kind}" for name, kind in {"hash": "bigint", "print": "int", **FOUND}.items())
INDEX = "bucket int, buckets int, levels array<binary>, " + ", ".join(f"`{f}` binary" for f in FIELDS) + f", rest array<struct<{REST}>>"


def write_index(spark: SparkSession, folder: str, bucket_keys: int = BUCKET_KEYS) -> None:
    """Index of the payload in ``folder``: each key's first shard, block and offset, its last block, its ids and its rows.

    Keys are dealt into buckets of about ``bucket_keys`` by hash, and each
    bucket is built in one task. An id that occurs in several rows is one key;
    its rows are neighbours.
    """
    entries = directory(read_payload(spark, folder))
    keys = entries.groupBy("doc_id").agg(
        F.min(F.struct("shard", "block", "at")).alias("first"), F.max(F.struct("shard", "block")).alias("last"),
        F.sum("n_tokens").alias("n_ids"), F.count(F.lit(1)).alias("n_rows"),
    ).select("doc_id", "first.*", F.col("last.shard").alias("last_shard"), F.col("last.block").alias("last_block"), "n_ids", "n_rows")
    buckets = max(1, -(-entries.count() // bucket_keys))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = rows["hash"].to_numpy(np.int64).view(np.uint64)
        levels, numbers = build_levels(hashes)
        placed = numbers >= 0
        order = np.argsort(numbers[placed], kind="stable")
        row = {"bucket": int(rows["bucket"].iloc[0]), "buckets": buckets, "levels": levels}
        for name, kind in FIELDS.items():
            row[name] = rows[name].to_numpy()[placed][order].astype(kind).tobytes()
        row["rest"] = rows.loc[~placed, ["hash", *FIELDS]].to_dict("records")
        return pd.DataFrame([row])

    _hashes(keys, buckets).groupBy("bucket").applyInPandas(build, INDEX).write.partitionBy("bucket").parquet(f"{folder}/index")


def asked_buckets(asked: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Rows of the index for the buckets that ``asked`` names; the folders of others are not listed."""
    index = asked.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")
    named = [r["bucket"] for r in asked.select("bucket").distinct().collect()]
    return index if len(named) == buckets else index.filter(F.col("bucket").isin(named))


def lookup(keys: DataFrame, folder: str) -> DataFrame:
    """For the distinct doc_ids of ``keys``: shard, block and at of the first row, last_shard and last_block, n_ids and
    n_rows; keys that are not stored give no row.

    A key costs one hash, one place per level and one fingerprint, whatever
    the number of stored keys. A fingerprint of 32 bits lets a foreign key
    pass once in 4 * 10^9; :func:`fetch` compares the stored id as well. The
    numbers of the asked buckets, of which there are as many as 65,536 go into
    the stored keys, pass through the driver.
    """
    spark = keys.sparkSession
    size = spark.read.schema(INDEX).parquet(f"{folder}/index").select("buckets").first()
    id_type = keys.schema["doc_id"].dataType.simpleString()
    out = list(FOUND)
    schema = f"doc_id {id_type}, " + ", ".join(f"{name} {kind}" for name, kind in FOUND.items())
    if size is None:
        return spark.createDataFrame([], schema)

    def find(index_rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(index_rows) or not len(asked):
            return pd.DataFrame({"doc_id": asked["doc_id"].iloc[:0], **{c: pd.Series(dtype="int64") for c in out}})
        row = index_rows.iloc[0]
        stored = {name: np.frombuffer(row[name], kind) for name, kind in FIELDS.items()}
        numbers = find_numbers(list(row["levels"]), asked["hash"].to_numpy(np.int64).view(np.uint64))
        hit = numbers >= 0
        hit[hit] = stored["print"][numbers[hit]] == asked["print"].to_numpy()[hit]
        found = pd.DataFrame({"doc_id": asked["doc_id"][hit], **{c: stored[c][numbers[hit]] for c in out}})
        if len(row["rest"]):
            rest = pd.DataFrame([r if isinstance(r, dict) else r.asDict() for r in row["rest"]])
            found = pd.concat([found, asked[~hit].merge(rest, on=["hash", "print"])[["doc_id", *out]]])
        return found

    asked = _hashes(keys.select("doc_id").distinct(), size[0])
    index = asked_buckets(asked, folder, size[0])
    return index.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInPandas(find, schema)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.Array], np.ndarray, list[np.ndarray]]]:
    """Of each stored block: doc_id, shard, block and at of its documents, and the ids of each."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            lengths = one.column("lengths").flatten().to_numpy()
            ends = np.cumsum(lengths)
            ids = np.frombuffer(one.column("ids")[0].as_buffer(), f"<u{one.column('width')[0].as_py()}")
            where = [pa.array(np.full(len(lengths), one.column(c)[0].as_py(), np.int32)) for c in ("shard", "block")]
            yield [one.column("doc_ids").flatten(), *where, pa.array(one.column("first")[0].as_py() + ends - lengths, pa.int64())], lengths, np.split(ids, ends[:-1])


STORED = ("shard", "block", "first", "ids", "doc_ids", "lengths", "width")


def documents_in(payload: DataFrame) -> DataFrame:
    """Every stored document: doc_id, shard, block, at, ids (array of bigint)."""
    id_type = payload.schema["doc_ids"].dataType.elementType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, _, ids in _documents(batches):
            yield pa.RecordBatch.from_arrays([*columns, pa.array([v.astype(np.int64) for v in ids], pa.list_(pa.int64()))], ["doc_id", "shard", "block", "at", "ids"])

    return payload.select(*STORED).mapInArrow(split, f"doc_id {id_type}, shard int, block int, at bigint, ids array<bigint>")


def checksums(payload: DataFrame) -> DataFrame:
    """Every stored document: doc_id, shard, block, at, n_tokens, ids_crc32 over its ids as 32-bit integers."""
    id_type = payload.schema["doc_ids"].dataType.elementType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, lengths, ids in _documents(batches):
            sums = [zlib.crc32(v.astype("<u4").tobytes()) for v in ids]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "shard", "block", "at", "n_tokens", "ids_crc32"])

    return payload.select(*STORED).mapInArrow(digest, f"doc_id {id_type}, shard int, block int, at bigint, n_tokens bigint, ids_crc32 bigint")


def opened(found: DataFrame, folder: str) -> DataFrame:
    """Rows of the payload that ``found`` names: of each named shard the blocks from the first to the last named one.

    Only the files of named shards are read. Up to ``PUSHED`` named blocks are
    a condition on the scan, which then passes over all other row groups. The
    named shards, at most one for each task that wrote, pass through the
    driver with their files.
    """
    spark = found.sparkSession
    payload, shards = read_payload(spark, folder), spark.read.parquet(f"{folder}/shards")
    named = named_blocks(found, shards)
    ranges = named.groupBy("shard").agg(F.min("block").alias("_low"), F.max("block").alias("_high"))
    files = ranges.join(shards, "shard").select("shard", "files").collect()
    if not files:
        return payload.filter(F.lit(False))
    if len(files) < shards.count():
        payload = spark.read.schema(payload.schema).parquet(*(f"{folder}/payload/{name}" for r in files for name in r["files"]))
    few = named.select("shard", "block").distinct().limit(PUSHED + 1).collect()
    if len(few) <= PUSHED:
        return payload.filter(reduce(or_, ((F.col("shard") == r["shard"]) & (F.col("block") == r["block"]) for r in few)))
    near = payload.join(F.broadcast(ranges), "shard").filter(F.col("block").between(F.col("_low"), F.col("_high")))
    return near.drop("_low", "_high")


def named_blocks(found: DataFrame, shards: DataFrame) -> DataFrame:
    """Every block that may hold a row of a found key: its key, shard, block, shard_start, and the global places _from and _to.

    The rows of one key are neighbours, so they fill all blocks from its first to its last one.
    """
    places = shards.select("shard", "blocks", "shard_start")
    first = places.select(F.col("shard"), F.col("shard_start").alias("_before"))
    spans = found.join(F.broadcast(first), "shard").select(
        F.col("doc_id").alias("_key"), F.explode(F.sequence("shard", "last_shard")).alias("_shard"), F.col("shard").alias("_first"), "block", "last_shard", "last_block",
        (F.col("_before") + F.col("at")).alias("_from"), (F.col("_before") + F.col("at") + F.col("n_ids")).alias("_to"),
    )
    within = spans.join(F.broadcast(places), F.col("_shard") == F.col("shard"))
    low = F.when(F.col("_shard") == F.col("_first"), F.col("block")).otherwise(F.lit(0))
    high = F.when(F.col("_shard") == F.col("last_shard"), F.col("last_block")).otherwise(F.col("blocks") - 1)
    return within.select("_key", "shard", "shard_start", "_from", "_to", F.explode(F.sequence(low, high)).alias("block"))


def located(stored: DataFrame, found: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows of ``stored`` at the places that the index gave in ``found``, with their global ``start``; the stored id is compared."""
    start = F.col("shard_start") + F.col("at")
    rows = stored.join(named_blocks(found, shards), ["shard", "block"]).filter(
        F.col("doc_id").eqNullSafe(F.col("_key")) & (start >= F.col("_from")) & (start < F.col("_to"))
    )
    return rows.withColumn("start", start)


def fetch(keys: DataFrame, folder: str) -> DataFrame:
    """Ids of the asked documents, one row per stored row: doc_id, start, ids (array of bigint).

    Only the buckets of the keys and the blocks that these name are opened.
    """
    found = stage(lookup(keys, folder), "found-keys")
    shards = keys.sparkSession.read.parquet(f"{folder}/shards")
    return located(documents_in(opened(found, folder)), found, shards).select("doc_id", "start", "ids")


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, **options) -> None:
    """Payload, shard table and index of ``docs`` in ``folder``. An empty table gives empty ones."""
    write_payload(docs, folder, tokenizer_path, end_id, **options)
    write_shard_table(docs.sparkSession, folder)
    write_index(docs.sparkSession, folder)


def digests(keys: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the asked documents, read through the index from the files in ``folder``."""
    found = stage(lookup(keys.select("doc_id"), folder), "found-keys")
    shards = keys.sparkSession.read.parquet(f"{folder}/shards")
    return located(checksums(opened(found, folder)), found, shards).select("doc_id", "start", "n_tokens", "ids_crc32")
