"""Line dedup by pairwise alignment of overlapping documents.

A window is a run of neighbouring lines, blank and short ones too, that just reaches ``LEAST_WORDS`` words,
counted from its first line on or back from its last. The windows of a common block cover all its lines, and
none reaches beyond it: a block of so many words is shared exactly where its windows are. A window is posted
to the first document (smallest id) that holds it, and a later document is paired with every first holder of
one of its windows: a window shared by very many documents makes one pair for each of them, not one for every
two, so none is too common to be looked at. Each pair is aligned by patience: windows that are unique on both
sides are anchors, the longest ascending run of anchors is kept and grows to neighbours that match on both
sides, and what lies between is aligned in the same way until nothing in it matches. The lines of aligned
windows go from the later document.

Windows left, as they cross others of their pair, are blocks that moved: the pair is aligned again with what is
left of it, up to ``PASSES`` times, and what then crosses still is taken window by window. No pair is added, so
the work grows with the windows and their first holders, whatever the order of the blocks.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwright.llm.common import shuffle_partitions, small_batches
from rollwright.session import materialise

LEAST_WORDS = 8
PASSES = 6
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64

HELD = "doc_id long, key long, length int, places array<int>"
ALIGNED = "doc_id long, removed array<int>, blocks long, partners long"


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse, modulo 2^64."""
    both = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(max(n, 1), base, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def windows(hashes: np.ndarray, words: np.ndarray, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keys, first places and lengths of a document's windows, sorted by key, then place."""
    n = len(words)
    before = np.concatenate([[0], np.cumsum(words)])
    first = np.arange(n)
    end = np.searchsorted(before, before[:n] + LEAST_WORDS, "left")
    last = np.arange(1, n + 1)
    start = np.searchsorted(before, before[1:] - LEAST_WORDS, "right") - 1
    pairs = np.unique(np.concatenate([
        (first * (n + 1) + end)[end <= n], (start * (n + 1) + last)[start >= 0],
    ]))
    start, end = pairs // (n + 1), pairs % (n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes.view(np.uint64) * up[:n], dtype=np.uint64)])
    length = end - start
    keys = ((sums[end] - sums[start]) * down[start] + length.astype(np.uint64) * np.uint64(BASE)).view(np.int64)
    order = np.argsort(keys, kind="stable")
    return keys[order], start[order], length[order]


def hold_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document and window, from ``doc_id, hashes, words``."""
    up, down = powers(1024)
    for batch in small_batches(batches):
        docs, at = batch.column("doc_id").to_numpy(), batch.column("words").offsets.to_numpy()
        hashes = batch.column("hashes").values.to_numpy()
        words = batch.column("words").values.to_numpy().astype(np.int64)
        found: list[tuple[np.ndarray, ...]] = []
        for doc, low, high in zip(docs, at[:-1], at[1:], strict=True):
            if high - low > len(up):
                up, down = powers(2 * (high - low))
            keys, start, length = windows(hashes[low:high], words[low:high], up, down)
            new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            sizes = np.diff(np.concatenate([new, [len(keys)]]))
            found.append((np.full(len(new), doc), keys[new], length[new], sizes, start))
        if found:
            doc, keys, length, sizes, start = (np.concatenate(parts) for parts in zip(*found, strict=True))
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()), pa.array(keys, pa.int64()), pa.array(length, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(start, pa.int32())),
                ],
                ["doc_id", "key", "length", "places"],
            )


def ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs (sorted by the first place) whose second places ascend."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, (_, other) in enumerate(pairs):
        at = bisect.bisect_left(tails, other)
        back.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(other)
            ends.append(i)
        else:
            tails[at], ends[at] = other, i
    run, i = [], ends[-1] if ends else -1
    while i >= 0:
        run.append(pairs[i])
        i = back[i]
    return run[::-1]


def by_place(places: dict[int, list[int]]) -> dict[int, set[int]]:
    found: dict[int, set[int]] = {}
    for key, held in places.items():
        for p in held:
            found.setdefault(p, set()).add(key)
    return found


def patience(mine: dict[int, list[int]], theirs: dict[int, list[int]]) -> dict[int, set[int]]:
    """Keys that align at each place of the later document, from the sorted places of each key on both sides."""
    here, there = by_place(mine), by_place(theirs)
    nothing: set[int] = set()
    xs, ys = sorted(here), sorted(there)
    chain: list[tuple[int, int]] = []

    def same(x: int, y: int) -> bool:
        return not here.get(x, nothing).isdisjoint(there.get(y, nothing))

    def inside(by: dict[int, set[int]], places: list[int], low: int, high: int) -> dict[int, list[int]]:
        held: dict[int, list[int]] = {}
        for p in places[bisect.bisect_left(places, low) : bisect.bisect_left(places, high)]:
            for key in by[p]:
                held.setdefault(key, []).append(p)
        return held

    gaps = [(xs[0], xs[-1] + 1, ys[0], ys[-1] + 1)] if xs and ys else []
    while gaps:
        x0, x1, y0, y1 = gaps.pop()
        if x0 >= x1 or y0 >= y1:
            continue
        at_x, at_y = inside(here, xs, x0, x1), inside(there, ys, y0, y1)
        common = at_x.keys() & at_y.keys()
        # Without a unique window the anchors are the first occurrences, the second ones and so on.
        anchors = {(at_x[k][0], at_y[k][0]) for k in common if len(at_x[k]) == len(at_y[k]) == 1} or {
            pair for k in common for pair in zip(at_x[k], at_y[k], strict=False)
        }
        # Of the pairs of one place at most one can be in a run: the second places descend.
        run = ascending(sorted(anchors, key=lambda pair: (pair[0], -pair[1])))
        if not run:
            continue
        px, py = x0 - 1, y0 - 1
        for (x, y), (nx, ny) in zip(run, [*run[1:], (x1, y1)], strict=True):
            a, b = x, y
            while a - 1 > px and b - 1 > py and same(a - 1, b - 1):
                a, b = a - 1, b - 1
            gaps.append((px + 1, a, py + 1, b))
            px, py = x, y
            while px + 1 < nx and py + 1 < ny and same(px + 1, py + 1):
                px, py = px + 1, py + 1
            chain.extend((a + i, b + i) for i in range(px - a + 1))
        gaps.append((px + 1, x1, py + 1, y1))
    chain.sort()
    aligned = {x: here[x] & there[y] for x, y in chain}
    # A copy beside the place of an aligned one crosses nothing: it goes to the same place of the partner.
    at = [x for x, _ in chain]
    for x in xs:
        i = bisect.bisect_left(at, x)
        if chain and (i == len(at) or at[i] != x):
            keys = here[x] & set().union(*(there[chain[j][1]] for j in (i - 1, i) if 0 <= j < len(at)))
            if keys:
                aligned[x] = keys
    return aligned


def aligned_places(mine: dict[int, list[int]], theirs: dict[int, list[int]]) -> dict[int, set[int]]:
    """Keys that align at each place of the later document, moved blocks included: patience until nothing is left."""
    found: dict[int, set[int]] = {}
    for _ in range(PASSES):
        aligned = patience(mine, theirs)
        for x, keys in aligned.items():
            found.setdefault(x, set()).update(keys)
        mine = {k: left for k, places in mine.items() if (left := [x for x in places if k not in aligned.get(x, ())])}
        if not mine:
            return found
    for key, places in mine.items():
        for x in places:
            found.setdefault(x, set()).add(key)
    return found


def align(matches: list[dict]) -> tuple[list[int], int, int]:
    """Places that go from one document, in how many blocks, and its partners, given its matches with earlier documents."""
    partners: dict[int, tuple[dict[int, list[int]], dict[int, list[int]]]] = {}
    lengths: dict[int, int] = {}
    for m in matches:
        mine, theirs = partners.setdefault(m["owner"], ({}, {}))
        mine[m["key"]], theirs[m["key"]] = m["places"], m["owner_places"]
        lengths[m["key"]] = m["length"]
    ends: dict[int, int] = {}
    for mine, theirs in partners.values():
        for x, keys in aligned_places(mine, theirs).items():
            ends[x] = max(ends.get(x, 0), *(x + lengths[k] for k in keys))
    removed: list[int] = []
    for x in sorted(ends):
        removed.extend(range(max(x, removed[-1] + 1 if removed else 0), ends[x]))
    blocks = sum(1 for i, x in enumerate(removed) if i == 0 or removed[i - 1] != x - 1)
    return removed, blocks, len(partners)


def align_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 64):
        removed, blocks, partners = zip(*(align(matches) for matches in batch.column("matches").to_pylist()), strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(removed, pa.list_(pa.int32())), pa.array(blocks, pa.int64()), pa.array(partners, pa.int64()),
            ],
            ["doc_id", "removed", "blocks", "partners"],
        )


def held_windows(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, key, length, places`` for each document and window; places are sorted."""
    lines = F.transform(F.split(F.col(text_column).cast("string"), "\n"), lambda line: F.trim(line))
    rows = df.where(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("doc_id"), lines.alias("lines")
    ).select(
        "doc_id", F.transform("lines", lambda line: F.xxhash64(line)).alias("hashes"),
        F.transform("lines", lambda line: F.size(F.filter(F.split(line, r"\s+"), lambda w: w != ""))).alias("words"),
    )
    # Rows that repeat an id are one document.
    return rows.mapInArrow(hold_windows, HELD).groupBy("doc_id", "key").agg(
        F.first("length").alias("length"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
    )


def with_owners(held: DataFrame) -> DataFrame:
    """Windows of later documents beside their first holder: ``owner, owner_places``.

    A window whose holders outnumber a partition's fair share is dealt to several tasks, its holder to each of
    them. There are at most as many such windows as partitions, which bounds the list that is broadcast.
    """
    parts = shuffle_partitions(held.sparkSession)
    owners = held.groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").alias("owner"), F.col("places").alias("owner_places"))).alias("o"),
        F.count(F.lit(1)).alias("documents"),
    ).where("documents > 1").select("key", "o.*", "documents")
    owners = materialise(owners, "owners")
    share = F.greatest(F.lit(256), F.ceil(held.groupBy().count().select("count").scalar() / F.lit(parts)))
    salts = F.ceil(F.col("documents") / share).cast("int")
    hot = F.broadcast(owners.where(F.col("documents") > share).select("key", salts.alias("salts")))
    dealt = held.join(hot, "key", "left").withColumn(
        "salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("salts"))).otherwise(F.lit(0)).cast("int")
    ).drop("salts")
    copies = owners.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("documents")
    return dealt.join(copies, ["key", "salt"]).where("doc_id > owner").drop("salt")


def aligned_lines(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, removed`` (places of lines that go, from 0), ``blocks, partners`` for documents that overlap."""
    held = materialise(held_windows(df, id_column, text_column), "windows")
    match = F.struct("owner", "key", "length", "places", "owner_places")
    gathered = with_owners(held).groupBy("doc_id").agg(F.collect_list(match).alias("matches"))
    return gathered.mapInArrow(align_documents, ALIGNED)


def cut_lines(text_column: str):
    """The rows with the lines named in ``_removed`` cut from the text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            at = batch.schema.get_field_index(text_column)
            texts = []
            for text, removed in zip(batch.column(at).to_pylist(), batch.column("_removed").to_pylist(), strict=True):
                if text is not None and removed:
                    lines, gone = text.split("\n"), set(removed)
                    text = "\n".join(line for i, line in enumerate(lines) if i not in gone)
                texts.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return cut


def without_aligned_lines(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows with their own columns, aligned blocks cut from the text, and ``_removed, _blocks, _partners``.

    Lines equal when their trimmed bytes do. Null texts stay null, empty ones empty; a text may become empty.
    Rows without an id are left as they are. Rows that repeat an id count as one document, and lose the same
    places. No rows in, no rows out. A column named like one of the three is replaced.
    """
    found = aligned_lines(df, id_column, text_column).select(
        F.col("doc_id").alias("_id"), F.col("removed").alias("_removed"), F.col("blocks").alias("_blocks"),
        F.col("partners").alias("_partners"),
    )
    own = df.drop("_id", "_removed", "_blocks", "_partners").withColumn(text_column, F.col(text_column).cast("string"))
    # The same join at any size: what is found grows with the documents.
    joined = own.join(found.hint("merge"), own[id_column].cast("long") == found["_id"], "left").drop("_id")
    return joined.mapInArrow(cut_lines(text_column), joined.schema)
