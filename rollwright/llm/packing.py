"""Best-fit packing of token sequences, with lower bounds that say when more work cannot help.

Documents become pieces of at most ``capacity`` ids. Pieces are dealt to partitions of a set mean size and
packed there, largest first, each into the fullest sequence that still takes it. Dual feasible functions
give a number of sequences that no packing of given lengths can go below.

* A partition whose sequences are as few as its bound is certified. Where they are as few as its ids alone ask for,
  it is done but for its least full sequence, whose pieces may still fill gaps elsewhere. Where the bound comes
  from the lengths, a sequence is done if not even the smallest piece of all would fit into it.
* A partition with a gap gives back what lies in sequences that are not full.
* What is given back is exchanged between partitions, fewer than before, and best-fit decreasing runs again
  over the new mix. This ends once all sequences together are as many as the bound over all pieces, once an
  exchange among certified partitions has gained nothing, once one partition holds all that is left, or after
  ``rounds``.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwright.llm.common import keyed_texts, small_batches
from rollwright.llm.tokens import byte_encoder
from rollwright.session import materialise

PIECES = "doc_id long, piece int, start long, length long, ids binary"
PACKED = "place long, piece_key long, length long, sequence long, offset long, certified boolean, again boolean"


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document: whole capacities, and before them what is left over."""
    rest = total % capacity
    return ([rest] if rest else []) + [capacity] * (total // capacity)


def token_pieces(
    df: DataFrame, path: str, capacity: int, end_id: int, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Pieces of every document's ids with ``end_id`` after them.

    Null and empty texts have the end id alone. Each row gives its own pieces, rows that repeat too.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = byte_encoder(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in small_batches(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids, at = encoder.encode(text) + end, 0
                for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                    rows.append((doc_id, piece, at, length, ids[4 * at : 4 * (at + length)]))
                    at += length
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids"]
            )

    return keyed_texts(df, id_column, text_column).mapInArrow(cut, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length. Bins are kept by the room they have left, of which there are few values."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used: list[int] = []  # the rooms that some bin has, ascending
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        at = bisect.bisect_left(used, size)
        if at < len(used):
            left = used[at]
            bin_ = room[left].pop()
            if not room[left]:
                del used[at]
        else:
            left, bin_ = capacity, made
            made += 1
        bins[i], offsets[i] = bin_, capacity - left
        if left > size:
            if not room[left - size]:
                bisect.insort(used, left - size)
            room[left - size].append(bin_)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """Sequences that any packing of these lengths needs; ``counts`` says how often each occurs, if not once.

    Each function maps lengths to weights of which no sequence can hold more than ``capacity``:
    the lengths themselves; for a threshold t, lengths over capacity - t count whole and those under t
    not at all; and lengths rounded to multiples of capacity / k, exact multiples kept.
    """
    if not len(lengths):
        return 0
    sizes = lengths
    if counts is None:
        sizes, counts = np.unique(lengths, return_counts=True)
    bound = -(-int(sizes @ counts) // capacity)
    for t in sizes[sizes * 2 <= capacity]:
        weights = np.where(sizes > capacity - t, capacity, np.where(sizes >= t, sizes, 0))
        bound = max(bound, -(-int(weights @ counts) // capacity))
    for k in range(1, 21):
        whole, rest = np.divmod(sizes * (k + 1), capacity)
        weights = np.where(rest == 0, sizes * k, whole * capacity)
        bound = max(bound, -(-int(weights @ counts) // (capacity * k)))
    return bound


def _pack(capacity: int, smallest: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece_key", kind="stable")
        lengths = group["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        held = np.bincount(bins, lengths).astype(np.int64)
        certified = len(held) == lower_bound(lengths, capacity)
        again = held < capacity
        if len(held) == -(-int(lengths.sum()) // capacity):
            again &= np.arange(len(held)) == np.argmin(held)
        elif certified:
            again &= capacity - held >= smallest
        return pd.DataFrame({
            "place": group["place"], "piece_key": group["piece_key"], "length": lengths, "sequence": bins,
            "offset": offsets, "certified": certified, "again": again[bins],
        })

    return pack


def pack(pieces: DataFrame, capacity: int, partition_pieces: int = 8192, rounds: int = 8) -> DataFrame:
    """Adds ``sequence_id``, ``offset``, and ``certified``: whether the partition that placed the piece met its bound.

    ``pieces`` needs ``length`` (1 to ``capacity``); its other columns are kept, but for some of the names added
    here. ``partition_pieces`` is the mean number of pieces in a partition: it bounds what one task holds,
    whatever the size of the input. Pieces of full capacity are sequences of their own. Rows that repeat are
    pieces of their own. No rows in, no rows out.
    """
    numbered = materialise(
        pieces.drop("sequence_id", "offset", "certified").withColumn("piece_key", F.monotonically_increasing_id()), "pieces"
    )
    placed = numbered.where(F.col("length") == capacity).select(
        "piece_key", (F.col("piece_key") * 16).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"),
    )
    left = numbered.where(F.col("length") < capacity).select("piece_key", "length")
    # One row for each length, of which there are fewer than the capacity.
    sizes = [(r["length"], r["count"]) for r in left.groupBy("length").count().collect()]
    count, done = sum(n for _, n in sizes), 0
    least = lower_bound(np.array([x for x, _ in sizes], np.int64), capacity, np.array([n for _, n in sizes], np.int64))
    rounds, before = max(1, min(rounds, 15)), count
    for turn in range(rounds if count else 0):
        places = max(1, -(-count // partition_pieces))
        dealt = left.withColumn("place", F.pmod(F.xxhash64("piece_key", F.lit(turn)), F.lit(places)))
        packed = materialise(dealt.groupBy("place").applyInPandas(_pack(capacity, min(x for x, _ in sizes)), PACKED), "packed")
        made = packed.groupBy("place", "again").agg(
            F.count_distinct("sequence").alias("n"), F.count(F.lit(1)).alias("pieces"), F.bool_and("certified").alias("certified")
        )
        sums = made.groupBy("again").agg(F.sum("n").alias("n"), F.sum("pieces").alias("pieces"), F.bool_and("certified").alias("certified"))
        found = {r["again"]: r for r in sums.collect()}
        used = sum(r["n"] for r in found.values())
        idle = used >= before and all(r["certified"] for r in found.values())
        last = places == 1 or turn == rounds - 1 or True not in found or done + used <= least or idle
        placed = placed.unionByName((packed if last else packed.where("NOT again")).select(
            "piece_key", ((F.col("place") * (1 << 24) + F.col("sequence")) * 16 + (turn + 1)).alias("sequence_id"), "offset", "certified",
        ))
        if last:
            break
        done, before = done + used - found[True]["n"], found[True]["n"]
        left, count = packed.where("again").select("piece_key", "length"), found[True]["pieces"]
    return numbered.join(placed, "piece_key").drop("piece_key")
