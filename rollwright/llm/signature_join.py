"""Near duplicates by an inverted join over MinHash signature coordinates.

1. Texts with equal shingle sets form a class; its smallest id stands for it.
2. Each class is posted under its ``COORDINATES`` (coordinate, value) pairs. A pair of classes is a
   candidate when at least ``match`` pairs collide. Two classes with so many collisions share one of the
   COORDINATES - match + 1 rarest pairs of either, so only that prefix is posted; pairs that a single class
   has are skipped, but count as part of the prefix.
3. Each posting is merged with a few leaders of its list: the least members in ``LEADERS`` orders that all
   lists share. Candidates are confirmed on full shingle sets, and the links found this way are contracted
   to components.
4. Lists whose members lie in several components still are merged in full, in blocks, from rows of signature,
   prefix and half hashes: every two members of different components whose sizes allow the threshold and whose
   collisions reach ``match`` are candidates too, each taken in the first list that it meets in, and left out
   where the half hashes alone refute it. In a list of several blocks the members of its largest component have
   their own blocks, which meet the others' blocks only. The full sets are joined once, to the pairs that remain.

``match`` is the number of collisions that a pair at exactly the threshold misses with a chance below one in
a hundred thousand. No list is cut or left out, and no task holds a list: large ones are dealt in blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwright.llm.common import keyed_texts, small_batches
from rollwright.llm.components import components
from rollwright.llm.shingles import shingle_set, signatures
from rollwright.operators.numbering import record_number
from rollwright.session import materialise

COORDINATES = 64
MISSED = 1e-5
LEADERS = 4
BLOCK = 256


def least_match(threshold: float) -> int:
    """Collisions that a pair at the threshold falls short of with a chance under ``MISSED``."""
    chance = 0.0
    for hits in range(COORDINATES + 1):
        chance += math.comb(COORDINATES, hits) * threshold**hits * (1 - threshold) ** (COORDINATES - hits)
        if chance > MISSED:
            return hits
    return COORDINATES


def signed(texts: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, set_key`` (digest of the set) and ``signature`` (null for an empty set)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = [shingle_set(t, size) for t in batch.column("text").to_pylist()]
            filled = np.array([len(s) > 0 for s in sets], bool)
            offsets = pa.array(np.concatenate([[0], np.cumsum(filled) * COORDINATES]), pa.int32(), mask=np.append(~filled, False))
            marks = signatures([s for s in sets if len(s)], COORDINATES).ravel() if filled.any() else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(map(len, sets), pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(marks.view(np.int64))),
                ],
                ["doc_id", "n_shingles", "set_key", "signature"],
            )

    return texts.mapInArrow(sign, "doc_id long, n_shingles long, set_key binary, signature array<long>")


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def full_sets(texts: DataFrame, size: int) -> DataFrame:
    """``doc_id, set_key, hashes, half``: the whole sets, and the distinct lower halves of their hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = [shingle_set(t, size) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(map(set_key, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([np.unique(s.astype(np.uint32)).tobytes() for s in sets], pa.binary()),
                ],
                ["doc_id", "set_key", "hashes", "half"],
            )

    return texts.mapInArrow(cut, "doc_id long, set_key binary, hashes binary, half binary")


def prefixes(classes: DataFrame, match: int) -> DataFrame:
    """``doc_id, prefix``: rarest first, the tokens that a class is posted under; none that it alone has."""
    every = classes.select("doc_id", F.explode("signature").alias("token"))
    shared = every.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = every.join(shared, "token").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("tokens"))
    # Tokens of one class alone are the rarest: each takes a place in the prefix.
    room = F.lit(COORDINATES - match + 1) - (F.lit(COORDINATES) - F.size("tokens"))
    return own.where(room > 0).select(
        "doc_id", F.transform(F.slice("tokens", 1, room), lambda t: t["token"]).alias("prefix")
    )


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets (ascending) reach the threshold."""
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (``a``, ``b``) whose full sets reach the threshold: 100 * shared >= percent * all."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            keep = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(left, right, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("left")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(confirm, "a long, b long")


def list_pairs(match: int, percent: int):
    """Candidates of lists that come sorted by token and blocks; only the rows of one list are held beyond a batch."""

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        column = {c: rows.column(c).to_numpy() for c in ("token", "low", "high", "block", "doc_id", "component", "n_shingles")}
        ids, parts, sizes, blocks = (column[c] for c in ("doc_id", "component", "n_shingles", "block"))
        marks = rows.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
        prefix = rows.column("prefix").combine_chunks()
        tokens, ends = prefix.flatten().to_numpy(), np.cumsum(prefix.value_lengths().to_numpy())
        lows = rows.column("half").to_pylist()
        own: dict[int, list[int]] = {}
        held: dict[int, set[int]] = {}

        def may_link(i: int, j: int) -> bool:
            """False only for sets below the threshold: lower halves share as much, but for those that coincide in a set."""
            x, y = np.frombuffer(lows[i], np.uint32), np.frombuffer(lows[j], np.uint32)
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum()) + int(sizes[i] + sizes[j]) - len(both)
            return 100 * shared >= percent * (int(sizes[i] + sizes[j]) - shared)

        def first_common(i: int, j: int) -> int:
            for k in (i, j):
                if k not in own:
                    own[k] = tokens[ends[k - 1] if k else 0 : ends[k]].tolist()
                    held[k] = set(own[k])
            return next(t for t in own[i] if t in held[j])

        new = (column["token"][1:] != column["token"][:-1]) | (column["low"][1:] != column["low"][:-1]) | (column["high"][1:] != column["high"][:-1])
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        stops = np.repeat(np.append(starts[1:], len(ids)), np.diff(np.append(starts, len(ids))))
        across = column["low"] != column["high"]
        a, b = [], []
        left, step = np.arange(len(ids)), 1
        # All pairs of neighbours at one distance in their lists, then at the next distance.
        while len(left := left[left + step < stops[left]]):
            right = left + step
            low, high = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
            apart = (parts[left] != parts[right]) & (100 * low >= percent * high) & (~across[left] | (blocks[left] != blocks[right]))
            x, y = left[apart], right[apart]
            for at in range(0, len(x), 4096):
                some = slice(at, at + 4096)
                likely = (marks[x[some]] == marks[y[some]]).sum(axis=1) >= match
                for i, j in zip(x[some][likely].tolist(), y[some][likely].tolist(), strict=True):
                    if first_common(i, j) == column["token"][i] and may_link(i, j):
                        a.append(max(ids[i], ids[j]))
                        b.append(min(ids[i], ids[j]))
            step += 1
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            key = [rows.column(c).to_numpy() for c in ("token", "low", "high")]
            same = np.logical_and.reduce([k == k[-1] for k in key])
            last = rows.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            if last:
                yield pairs(rows.slice(0, last))
            rest = rows.slice(last)
        if rest is not None:
            yield pairs(rest)

    return merge


def block_pairs(lists: DataFrame, match: int, percent: int) -> DataFrame:
    """Candidates ``a, b`` of different components, each once, from lists dealt to blocks that meet in twos."""
    parts = lists.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("token").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("main")).select(
        "token",
        F.when(F.col("n") > BLOCK, F.col("main.component")).alias("main"),
        F.ceil(F.when(F.col("n") > BLOCK, F.col("n") - F.col("main.n")).otherwise(F.col("n")) / F.lit(BLOCK)).alias("rest_blocks"),
        F.when(F.col("n") > BLOCK, F.ceil(F.col("main.n") / F.lit(BLOCK))).otherwise(F.lit(0)).alias("main_blocks"),
    )
    dealt = lists.join(sizes, "token").withColumn("in_main", F.coalesce(F.col("component") == F.col("main"), F.lit(False)))
    spread = F.xxhash64("doc_id")
    dealt = dealt.withColumn(
        "block",
        F.when(F.col("in_main"), F.col("rest_blocks") + F.pmod(spread, F.greatest("main_blocks", F.lit(1))))
        .otherwise(F.pmod(spread, F.col("rest_blocks"))),
    )
    meets = F.col("rest_blocks") + F.when(F.col("in_main"), F.lit(0)).otherwise(F.col("main_blocks"))
    others = F.sequence(F.lit(0).cast("long"), meets - 1)
    met = dealt.withColumn("other", F.explode(others)).select(
        "token", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block",
        "doc_id", "component", "n_shingles", "signature", "prefix", "half",
    )
    key = ["token", "low", "high"]
    return met.repartition(*key).sortWithinPartitions(*key, "doc_id").mapInArrow(list_pairs(match, percent), "a long, b long")


def nodes_of(filled: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``node`` beside ``doc_id`` and ``set_key``: the id itself, but for the further texts of an id that has several.

    Those get ids below all others, and are listed as ``node, doc_id``; None if there are none.
    """
    own = filled.groupBy("doc_id").agg(F.min("set_key").alias("own_key"), F.max("set_key").alias("last_key"))
    several = own.where("own_key <> last_key").select("doc_id", "own_key")
    if several.isEmpty():
        return filled.withColumn("node", F.col("doc_id")), None
    more = filled.join(several, "doc_id").where("set_key <> own_key").select("doc_id", "set_key").distinct()
    least = filled.agg(F.min("doc_id")).first()[0]
    more = materialise(
        record_number(more, ["doc_id", "set_key"], "number").select("doc_id", "set_key", (F.lit(least) - F.col("number")).alias("node")), "further"
    )
    return (
        filled.join(more, ["doc_id", "set_key"], "left").withColumn("node", F.coalesce("node", "doc_id")), more.select("node", "doc_id")
    )


def near_duplicates(
    df: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Texts are linked where 100 * shared >= percent * all over their sets of ``size``-word shingles (A-Z as
    a-z; a shorter text is one shingle). ``component_id`` is the smallest id reachable over links, ``kept``
    marks it. Texts without words link with nothing; rows that repeat an id count as one document with the
    links of all its texts, each row is returned; a null id links with nothing and is its own component (null), kept. No rows in, no rows out.
    """
    match = least_match(percent / 100)
    texts = keyed_texts(df, id_column, text_column)
    rows = materialise(signed(texts, size), "signed")
    filled, further = nodes_of(rows.where("doc_id IS NOT NULL AND n_shingles > 0"))
    grouped = filled.groupBy("set_key").agg(F.min("node").alias("first"))
    members = filled.select("node", "set_key").join(grouped, "set_key").select("node", "first")
    heads = materialise(
        filled.join(grouped.withColumnRenamed("first", "node"), ["set_key", "node"]).dropDuplicates(["node"])
        .select(F.col("node").alias("doc_id"), "n_shingles", "signature", "set_key", F.col("doc_id").alias("id")), "heads",
    )
    light = heads.select("doc_id", "n_shingles", "signature")
    ordered = materialise(prefixes(light, match), "prefixes")
    posted = ordered.select(F.explode("prefix").alias("token"), "doc_id")

    # A few links from each posting to leaders of its list.
    leaders = posted.groupBy("token").agg(
        F.array_distinct(F.array(*(F.min_by("doc_id", F.xxhash64("doc_id", F.lit(i))) for i in range(LEADERS)))).alias("lead")
    ).select("token", F.explode("lead").alias("b"))
    first_pairs = (
        posted.join(leaders, "token").where("doc_id <> b")
        .select(F.greatest("doc_id", "b").alias("a"), F.least("doc_id", "b").alias("b")).distinct()
    )
    marks = light.select(F.col("doc_id").alias("a"), F.col("signature").alias("left"))
    collisions = F.size(F.filter(F.zip_with("left", "right", lambda x, y: x == y), lambda same: same))
    likely = materialise(
        first_pairs.join(marks, "a")
        .join(marks.select(F.col("a").alias("b"), F.col("left").alias("right")), "b")
        .where(collisions >= match).select("a", "b"), "pairs",
    )
    needed = heads.join(ordered.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("node"), F.col("id").alias("doc_id"), "set_key")
    whole = full_sets(texts.join(needed.select("doc_id"), "doc_id", "left_semi"), size)
    if further is None:
        whole = whole.dropDuplicates(["doc_id"])
    else:
        whole = whole.join(needed, ["doc_id", "set_key"]).dropDuplicates(["node"]).select(F.col("node").alias("doc_id"), "hashes", "half")
    sets = materialise(whole.select("doc_id", "hashes", "half"), "sets")
    links = materialise(confirmed(likely, sets, percent), "links")
    joined = materialise(components(links), "components")

    # Lists that still hold several components are merged in full.
    placed = posted.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    mixed = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    lists = placed.join(mixed.select("token"), "token").join(light, "doc_id").join(ordered, "doc_id").join(
        sets.select("doc_id", "half"), "doc_id"
    )
    more = confirmed(materialise(block_pairs(lists, match, percent), "pairs"), sets, percent)
    own = members.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    every = links.unionByName(more).unionByName(own)
    if further is not None:
        for end in ("a", "b"):
            every = every.join(further.select(F.col("node").alias(end), F.col("doc_id").alias("real")), end, "left")
            every = every.withColumn(end, F.coalesce("real", end)).drop("real")
    linked = components(every)
    found = rows.select("doc_id", "n_shingles").join(linked.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
