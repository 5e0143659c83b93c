"""Token ids in shards of raw binary payload, and a minimal perfect hash index for keyed access.

File format, two Parquet tables in one folder:

* ``shards``: a row for each block: ``shard``, ``block`` (from 0 in its shard), ``start`` (ids before it in
  its shard), ``payload`` (ids, little-endian, unsigned, ``width`` bytes each, documents without gaps),
  ``doc_ids``, ``copies``, ``firsts`` (ids before it in the block) and ``lengths`` of its documents in order,
  ``width``. Shards ascend by document, so do blocks, and documents inside them. A block ends once it holds
  ``block_ids`` ids or ``block_documents`` documents.
* ``index``: a row for each bucket of keys: ``bucket``, ``sizes`` of its bit arrays, ``bits``, and in slot
  order ``fingerprints`` and ``places`` (shard, block, slot in the block, first id in the block, length).

A key is a document id with the number of its copy (rows that share an id count from 0 by text). Its bucket
is a hash modulo their number. Each level of a bucket hashes the keys still left into a bit array; keys alone
in their bit own it, the others go on. The number of set bits before a key's own bit is its slot: n keys fill
n slots. A lookup costs a few probes whatever the size, and the fingerprint tells a strange key, wrongly
accepted once in 2**32.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwright.llm.common import keyed_texts, shuffle_partitions, small_batches
from rollwright.llm.tokens import word_encoder

BLOCKS = (
    "shard long, block long, start long, width int, payload binary, doc_ids array<long>, copies array<long>,"
    " firsts array<long>, lengths array<long>"
)
INDEX = "bucket long, sizes array<long>, bits binary, fingerprints binary, places binary"
FOUND = "doc_id long, copy long, shard long, block long, slot long, first long, length long"
PLACE = ["shard", "block", "slot", "first", "length"]
ROOM = 1.5  # bits of a level for each key that is left


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = keys ^ (np.uint64(salt + 1) * np.uint64(0x9E3779B97F4A7C15))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def build_levels(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and all their bits, one behind the other. Keys must differ."""
    sizes, levels = [], []
    while len(keys):
        size = max(64, int(len(keys) * ROOM))
        at = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        keys = keys[~alone[at]]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool)


def slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 for one that no level owns."""
    before = np.cumsum(bits) - bits
    found, base = np.full(len(keys), -1, np.int64), 0
    left = np.arange(len(keys))
    for level, size in enumerate(sizes):
        at = base + (mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
        own = bits[at]
        found[left[own]] = before[at[own]]
        left, base = left[~own], base + size
    return found


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1_000) >> np.uint64(32)).astype("<u4")


def _key() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0)), F.col("doc_id").isNull(), F.col("copy"))


def write_shards(
    df: DataFrame, folder: str, path: str, end_id: int, vocabulary_size: int, block_ids: int = 1 << 18,
    block_documents: int = 1 << 13, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Encode whole texts (null: empty) with ``end_id`` behind each, and write the shards; returns them as read.

    Rows without an id come first. Null and empty texts have the end id alone. A task holds one block, or one
    document if that is longer. No rows in, no rows out; other columns are left out.
    """
    width = 2 if vocabulary_size <= 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_encoder(path), np.array([end_id], dtype="<u4").tobytes()
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        last: tuple = ()
        copy = 0
        docs, copies, firsts, lengths, parts, held = [], [], [], [], [], 0

        def out() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4").astype(f"<u{width}")
            row = [shard, block, start, width, ids.tobytes(), docs, copies, firsts, lengths]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names
            )

        names = ["shard", "block", "start", "width", "payload", "doc_ids", "copies", "firsts", "lengths"]
        many = pa.list_(pa.int64())
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), many, many, many, many]
        for batch in small_batches(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                copy = copy + 1 if (doc_id,) == last else 0
                last = (doc_id,)
                ids = encoder.encode(text) + end
                docs.append(doc_id)
                copies.append(copy)
                firsts.append(held)
                lengths.append(len(ids) // 4)
                parts.append(ids)
                held += lengths[-1]
                if held >= block_ids or len(docs) >= block_documents:
                    yield out()
                    block, start = block + 1, start + held
                    docs, copies, firsts, lengths, parts, held = [], [], [], [], [], 0
        if docs:
            yield out()

    ordered = keyed_texts(df, id_column, text_column).repartitionByRange(
        shuffle_partitions(df.sparkSession), "doc_id"
    ).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, BLOCKS).write.parquet(f"{folder}/shards")
    return read_shards(df.sparkSession, folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/shards")


def _documents(blocks: DataFrame) -> DataFrame:
    """Key and place of each document, from the block headers alone: payloads are not read."""
    one = blocks.select("shard", "block", F.posexplode(F.arrays_zip("doc_ids", "copies", "firsts", "lengths")).alias("slot", "doc"))
    return one.select(
        F.col("doc.doc_ids").alias("doc_id"), F.col("doc.copies").alias("copy"), "shard", "block",
        F.col("slot").cast("long").alias("slot"), F.col("doc.firsts").alias("first"), F.col("doc.lengths").alias("length"),
    )


def bucketed(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.withColumn("key", _key()).withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(buckets)))


def write_index(spark: SparkSession, folder: str, bucket_keys: int = 4096) -> int:
    """Build the index of the written shards; returns the number of buckets.

    ``bucket_keys`` is the mean number of keys in a bucket, and so bounds what one task holds.
    """
    documents = _documents(read_shards(spark, folder))
    count = read_shards(spark, folder).agg(F.coalesce(F.sum(F.size("doc_ids")), F.lit(0))).first()[0]
    buckets = max(1, -(-count // bucket_keys))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy().view(np.uint64)
        sizes, bits = build_levels(keys)
        order = np.argsort(slots(keys, sizes, bits))
        places = group[PLACE].to_numpy(dtype="<i8")[order]
        return pd.DataFrame({
            "bucket": [group["bucket"].iloc[0]], "sizes": [sizes], "bits": [np.packbits(bits).tobytes()],
            "fingerprints": [fingerprint(keys[order]).tobytes()], "places": [places.tobytes()],
        })

    bucketed(documents, buckets).groupBy("bucket").applyInPandas(build, INDEX).write.parquet(f"{folder}/index")
    return buckets


def look_up(keys: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Place of each key (``doc_id``, ``copy``) by the index; a key that is not in it gives no row.

    A null id is a key like others; a key asked for twice is found twice. Other columns are left out.
    """
    spark = keys.sparkSession
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")

    def find(group: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if group.empty or held.empty:
            return pd.DataFrame(columns=["doc_id", "copy", *PLACE])
        row = held.iloc[0]
        keys = group["key"].to_numpy().view(np.uint64)
        sizes = [int(x) for x in row["sizes"]]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
        at = slots(keys, sizes, bits)
        known = (at >= 0) & (np.frombuffer(row["fingerprints"], "<u4")[at] == fingerprint(keys))
        places = np.frombuffer(row["places"], "<i8").reshape(-1, len(PLACE))[at[known]]
        found = group.loc[known, ["doc_id", "copy"]].reset_index(drop=True)
        return pd.concat([found, pd.DataFrame(places, columns=PLACE)], axis=1)

    return (
        bucketed(keys.select("doc_id", "copy"), buckets).groupBy("bucket")
        .cogroup(index.groupBy("bucket")).applyInPandas(find, FOUND)
    )


def read_documents(blocks: DataFrame) -> DataFrame:
    """Ids of every document, cut out of the payloads where the headers say: shard, block, slot, ids (32-bit).

    One block is unpacked at a time. A block has at least one document, whose ids may be the end id alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            row = batch.to_pylist()[0]
            ids = np.frombuffer(row["payload"], f"<u{row['width']}").astype("<u4")
            parts = [ids[a : a + n].tobytes() for a, n in zip(row["firsts"], row["lengths"], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * len(parts), pa.int64()), pa.array([row["block"]] * len(parts), pa.int64()),
                    pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary()),
                ],
                ["shard", "block", "slot", "ids"],
            )

    needed = blocks.select("shard", "block", "width", "payload", "firsts", "lengths")
    return needed.mapInArrow(cut, "shard long, block long, slot long, ids binary")


def block_starts(blocks: DataFrame) -> DataFrame:
    """Ids of all documents before each block. Only one row for each shard meets in one task."""
    from pyspark.sql import Window

    sums = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return blocks.select("shard", "block", "start").join(shards, "shard").select(
        "shard", "block", (F.col("base") + F.col("start")).alias("block_start")
    )
