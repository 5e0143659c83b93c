"""Exact duplicates by sorting contents: equal texts become neighbours, neighbours are compared in full.

Rows are range-partitioned on their normalised bytes by splitters that Spark samples. The range key is the
first ``KEY_BYTES`` bytes and a hash of the rest, so that the sample stays small however long texts are;
equal texts have equal keys. Within a partition an external sort by key and whole content puts equal texts
side by side, and each row is compared with the one before it.

A text whose copies outnumber a partition's fair share is dealt to several partitions under a salt. There
are at most as many such texts as partitions, which bounds the list of them that is broadcast; their
parts are joined by a second, small aggregate. No task holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollwright.llm.common import ascii_lower, shuffle_partitions

KEY_BYTES = 32


def content_sort(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest") -> DataFrame:
    """One row for each row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as ''. ``keep`` is ``smallest`` or
    ``largest``: which id of a group stays. Rows that repeat an id and text count as copies, and each of
    them has ``kept`` where its id is the one that stays. Among null ids and others, another stays; a group
    of null ids alone keeps null. No rows in, no rows out; other columns are left out.
    """
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    best = {"smallest": F.min, "largest": F.max}[keep]
    rows = df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        ascii_lower(F.coalesce(F.col(text_column).cast("string"), F.lit(""))).cast("binary").alias("content"),
    ).withColumn("hash", F.xxhash64("content"))

    counts = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("copies"))
    share = F.greatest(F.lit(64), F.ceil(rows.groupBy().count().select("count").scalar() / F.lit(parts)))
    hot = F.broadcast(counts.where(F.col("copies") > share).select("hash", F.ceil(F.col("copies") / share).alias("salts")))
    salted = rows.join(hot, "hash", "left").withColumn(
        "salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("salts"))).otherwise(F.lit(-1))
    )

    key = ["prefix", "hash", "salt"]
    ranged = (
        salted.select(F.substring("content", 1, KEY_BYTES).alias("prefix"), "hash", "salt", "doc_id", "content")
        .repartitionByRange(parts, *key)
    )
    order = Window.partitionBy(*key).orderBy("content", "doc_id")
    compared = ranged.withColumn("first", ~F.col("content").eqNullSafe(F.lag("content").over(order)))
    runs = compared.withColumn("run", F.count_if("first").over(order)).select(
        *key, "run", "doc_id", F.sha2("content", 256).alias("text_sha256")
    )
    run = Window.partitionBy(*key, "run")
    own = runs.withColumns({"best": best("doc_id").over(run), "size": F.count(F.lit(1)).over(run)})

    # The parts of a salted text: one row for each run, then one for each text.
    whole = (
        own.where("salt >= 0").groupBy("hash", "text_sha256", "salt").agg(F.max("best").alias("best"), F.max("size").alias("size"))
        .groupBy("hash", "text_sha256").agg(best("best").alias("all_best"), F.sum("size").alias("all_size"))
    )
    joined = own.join(F.broadcast(whole), ["hash", "text_sha256"], "left")
    keep_id = F.when(F.col("all_size").isNull(), F.col("best")).otherwise(F.col("all_best"))
    return joined.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("all_size", "size").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256",
    )
