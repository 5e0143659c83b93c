"""Repeated byte strings removed, found by a logarithmic family of suffix arrays.

Every ``LENGTH``-byte window of a document that also lies in a document with a smaller id loses its bytes.

1. Each window is assigned to its anchor: the place of the least hash among the ``GRAM``-byte strings inside
   it (the leftmost of equal ones). That depends on the window's bytes alone, so equal windows have equal
   anchor strings, and neighbouring windows mostly share one anchor: a text has about one anchor for every 18
   windows. Anchors meet by bucket, a hash of their string, in packed blocks of a few bytes each, and those whose
   string lies in one document only are left out.
2. The rest become contexts: the bytes from the first to the last window of an anchor. Contexts meet in the
   same buckets, dealt to batches by ranges of ids. A context that several documents have is sent once.
3. A bucket takes its batches in ascending order. Each batch gets a suffix array: its windows, sorted by
   their bytes, with the smallest id of each. It is merge-scanned against the levels that exist, sorted too;
   windows that no level has become a new level. A level not twice as large as the one after it is merged
   with it, so there are logarithmically many. A window goes where its smallest id lies below the document's.
4. Runs of such windows go back to their documents, which cut them out.

A bucket holds each distinct window once, however many documents have it. The anchor filter is only a filter:
a clash of hashes lets an anchor through, and the comparison of bytes then decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollwright.llm.common import keyed_texts, shuffle_partitions, small_batches
from rollwright.llm.shingles import ODD, spread

LENGTH = 50
GRAM = 16
BATCHES = 4
BUCKET_BYTES = 1 << 23
FLUSH_ANCHORS = 1 << 19
FLUSH_BYTES = 1 << 24
CHUNK = 1 << 20
NONE = np.iinfo(np.int64).max

ANCHORS = "bucket int, n int, known int, base long, keys binary, docs binary, firsts binary, counts binary"
CONTEXTS = (
    "bucket int, batch int, texts binary, counts binary, owners binary, base long, docs binary, copies binary, firsts binary"
)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as the largest needs."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return values.astype(f"<u{width}").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.empty(0, np.int64)


def runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the lengths, one behind the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def changes(values: np.ndarray) -> np.ndarray:
    """Places where a new value begins."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, document, first window and number of windows of each anchor of documents that lie side by side."""
    windows = np.maximum(sizes - LENGTH + 1, 0)
    inside = np.repeat(np.tile([True, False], len(sizes)), np.stack([windows, sizes - windows], 1).ravel())
    found = []
    for low in range(0, max(len(data) - LENGTH + 1, 0), CHUNK):
        at = np.flatnonzero(inside[low : low + CHUNK])
        if not len(at):
            continue
        x = data[low : low + CHUNK + LENGTH - 1].astype(np.uint64) + np.uint64(1)
        factor = ODD
        with np.errstate(over="ignore"):
            for step in (1, 2, 4, 8):
                x = x[:-step] * np.uint64(factor) + x[step:]
                factor = factor * factor % (1 << 64)
            hashes = spread(x)
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        for step in (1, 2, 4, 8, 16, LENGTH - GRAM + 1 - 32):
            least = np.minimum(least[:-step], least[step:])
        place = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = changes(place)
        found.append((hashes[place[new]], at[new] + low, np.diff(np.append(new, len(place)))))
    if not found:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    hashes, first, counts = (np.concatenate(part) for part in zip(*found, strict=True))
    doc = np.searchsorted(starts, first, "right") - 1
    return hashes, doc, first - starts[doc], counts


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts side by side, and where each begins and how long it is."""
    texts = [t.encode() for t in column.to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


def anchor_blocks(buckets: int):
    """Blocks of anchors by bucket; the ``known`` first ones of a block repeat among the documents of its task's share."""

    def rows(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        hashes, docs, firsts, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(hashes)
        hashes, docs = hashes[order], docs[order]
        new = changes(hashes)
        again = np.minimum.reduceat(docs, new) != np.maximum.reduceat(docs, new)
        known = np.repeat(again, np.diff(np.append(new, len(hashes))))
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        by = np.lexsort((~known, bucket))
        order, docs, known, bucket, keys = order[by], docs[by], known[by], bucket[by], (hashes >> np.uint64(32))[by]
        firsts, counts = firsts[order], counts[order]
        edges = np.append(changes(bucket), len(bucket))
        found = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            base = docs[a:b].min()
            found.append((
                bucket[a], b - a, known[a:b].sum(), base, keys[a:b].astype("<u4").tobytes(), packed((docs[a:b] - base).view(np.uint64)),
                packed(firsts[a:b]), packed(counts[a:b]),
            ))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), kinds, strict=True)],
            ["bucket", "n", "known", "base", "keys", "docs", "firsts", "counts"],
        )

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in small_batches(batches):
            hashes, doc, first, counts = anchors(*text_bytes(batch.column("text")))
            if len(hashes):
                parts.append((hashes, batch.column("doc_id").to_numpy()[doc], first, counts))
                held += len(hashes)
            if held >= FLUSH_ANCHORS:
                yield rows(parts)
                parts, held = [], 0
        if parts:
            yield rows(parts)

    return post


def repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, entry`` of the anchors whose string two documents have; blocks come sorted by bucket.

    An entry is the first window, the number of windows and the bucket, in 31, 6 and 26 bits.
    """

    def out(docs: np.ndarray, firsts: np.ndarray, counts: np.ndarray, bucket: int) -> pa.RecordBatch:
        entry = firsts << 32 | counts << 26 | bucket
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(entry, pa.int64())], ["doc_id", "entry"])

    def resolved(bucket: int, single: list[tuple[np.ndarray, ...]], known: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, docs, firsts, counts = (np.concatenate(p) for p in zip(*single, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        new = changes(keys)
        if len(new):
            again = np.minimum.reduceat(docs, new) != np.maximum.reduceat(docs, new)
            again |= np.isin(keys[new], np.concatenate(known))
            keep = np.repeat(again, np.diff(np.append(new, len(keys))))
            order = order[keep]
            if len(order):
                yield out(docs[keep], firsts[order], counts[order], bucket)

    current, single, known = None, [], []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            if row["bucket"] != current:
                if single:
                    yield from resolved(current, single, known)
                current, single, known = row["bucket"], [], []
            n, first = row["n"], row["known"]
            keys = np.frombuffer(row["keys"], "<u4")
            docs = (unpacked(row["docs"], n).view(np.uint64) + np.int64(row["base"]).view(np.uint64)).view(np.int64)
            firsts, counts = unpacked(row["firsts"], n), unpacked(row["counts"], n)
            if first:
                yield out(docs[:first], firsts[:first], counts[:first], current)
            known.append(np.unique(keys[:first]))
            single.append((keys[first:], docs[first:], firsts[first:], counts[first:]))
    if single:
        yield from resolved(current, single, known)


def context_blocks(bounds: list[int]):
    """Blocks of contexts by bucket and batch of ids, from ``doc_id, copy, text, entries`` in ascending order of ids."""
    edges = np.array(bounds, np.int64)

    def rows(batch: int, held: dict[int, dict[bytes, list[tuple[int, int, int]]]]) -> pa.RecordBatch:
        found = []
        for bucket, contexts in held.items():
            owners = [len(o) for o in contexts.values()]
            docs, copies, firsts = (np.array(x, np.int64) for x in zip(*(o for own in contexts.values() for o in own), strict=True))
            base = docs.min()
            found.append((
                bucket, batch, pa.compress(b"".join(contexts), codec="zstd", asbytes=True), packed(np.array([len(c) - LENGTH + 1 for c in contexts])), packed(np.array(owners)), base,
                packed((docs - base).view(np.uint64)), packed(copies), packed(firsts),
            ))
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), *[pa.binary()] * 3)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), kinds, strict=True)],
            ["bucket", "batch", "texts", "counts", "owners", "base", "docs", "copies", "firsts"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[bytes, list[tuple[int, int, int]]]] = {}
        current, size = -1, 0
        for batch in small_batches(batches, 64):
            for doc, copy, text, entries in zip(*(batch.column(c) for c in ("doc_id", "copy", "text", "entries")), strict=True):
                doc, copy, data = doc.as_py(), copy.as_py(), text.as_py().encode()
                at = int(np.searchsorted(edges, doc, "right"))
                if held and (at != current or size >= FLUSH_BYTES):
                    yield rows(current, held)
                    held, size = {}, 0
                current = at
                packed_entries = entries.values.to_numpy()
                firsts, counts = packed_entries >> 32, packed_entries >> 26 & 63
                # Another row of this id may be the shorter one.
                counts = np.minimum(counts, len(data) - LENGTH + 1 - firsts)
                for first, count, bucket in zip(firsts.tolist(), counts.tolist(), (packed_entries & (1 << 26) - 1).tolist(), strict=True):
                    if count > 0:
                        context = data[first : first + count + LENGTH - 1]
                        held.setdefault(bucket, {}).setdefault(context, []).append((doc, copy, first))
                        size += len(context) + 32
        if held:
            yield rows(current, held)

    return cut


class Level:
    """Distinct windows in the order of their bytes: places in a text, and the smallest id that has each."""

    def __init__(self, text: np.ndarray, places: np.ndarray, docs: np.ndarray) -> None:
        self.text, self.places, self.docs = text, places, docs

    def windows(self, low: int = 0, high: int | None = None) -> np.ndarray:
        return windows_at(self.text, self.places[low:high])

    def locate(self, windows: np.ndarray, step: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
        """For sorted windows: how many of the level lie below each, and whether the level has it."""
        below, has = np.full(len(windows), len(self.places), np.int64), np.zeros(len(windows), bool)
        done = 0
        for low in range(0, len(self.places), step):
            if done == len(windows):
                break
            held = self.windows(low, low + step)
            upto = int(np.searchsorted(windows, held[-1], "right"))
            at = np.searchsorted(held, windows[done:upto])
            below[done:upto], has[done:upto] = low + at, held[at] == windows[done:upto]
            done = upto
        return below, has

    def merged(self, other: Level) -> Level:
        """Both levels as one; they have no window in common."""
        below, _ = self.locate(other.windows())
        return Level(
            np.concatenate([self.text, other.text]), np.insert(self.places, below, other.places + len(self.text)),
            np.insert(self.docs, below, other.docs),
        )


class Family:
    """Levels, each at least twice as large as the next."""

    def __init__(self) -> None:
        self.levels: list[Level] = []

    def least_docs(self, windows: np.ndarray) -> np.ndarray:
        """Smallest id for each of the sorted windows, ``NONE`` where no level has it."""
        least = np.full(len(windows), NONE)
        for level in self.levels:
            below, has = level.locate(windows)
            least[has] = np.minimum(least[has], level.docs[below[has]])
        return least

    def add(self, level: Level) -> None:
        if not len(level.places):
            return
        self.levels.append(level)
        while len(self.levels) > 1 and len(self.levels[-2].places) < 2 * len(self.levels[-1].places):
            last = self.levels.pop()
            self.levels.append(self.levels.pop().merged(last))


def windows_at(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The windows at these places, comparable as byte strings."""
    if not len(places):
        return np.empty(0, f"S{LENGTH}")
    return np.ndarray(len(text) - LENGTH + 1, f"S{LENGTH}", text, strides=(1,))[places]


def scan(family: Family, contexts: list[bytes], owner: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scan a batch against the family and add it; owners are sorted by context.

    Returns the smallest id of every window of all contexts, side by side, and where each context's begin and
    how many they are.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    counts = sizes - LENGTH + 1
    begin, first = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
    places = np.repeat(begin, counts) + runs(counts)
    own = np.minimum.reduceat(docs, changes(owner))
    windows = windows_at(text, places)
    order = np.argsort(windows)
    windows = windows[order]
    new = changes(windows)
    windows = windows[new]
    here = np.minimum.reduceat(np.repeat(own, counts)[order], new)
    before = family.least_docs(windows)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(order))))
    fresh = before == NONE
    at = places[order[new][fresh]]
    if len(at) * LENGTH < len(text):  # few are new: their bytes alone stay
        family.add(Level(windows[fresh].view(np.uint8), np.arange(len(at)) * LENGTH, here[fresh]))
    else:
        family.add(Level(text, at, here[fresh]))
    return np.minimum(before, here)[rank], first, counts


def repeated_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, run`` from blocks of contexts sorted by bucket and batch: start, length and copy in 31, 7 and 25 bits."""

    def resolved(family: Family, blocks: list[dict]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        owner, docs, copies, firsts = [], [], [], []
        for block in blocks:
            counts = np.frombuffer(block["counts"], np.uint8).astype(np.int64)
            ends = np.cumsum(counts + LENGTH - 1).tolist()
            texts = pa.decompress(block["texts"], decompressed_size=ends[-1], codec="zstd", asbytes=True)
            ids = [known.setdefault(texts[a:b], len(known)) for a, b in zip([0, *ends], ends, strict=False)]
            owners = unpacked(block["owners"], len(counts))
            n = int(owners.sum())
            owner.append(np.repeat(ids, owners))
            docs.append((unpacked(block["docs"], n).view(np.uint64) + np.int64(block["base"]).view(np.uint64)).view(np.int64))
            copies.append(unpacked(block["copies"], n))
            firsts.append(unpacked(block["firsts"], n))
        owner, docs, copies, firsts = (np.concatenate(x) for x in (owner, docs, copies, firsts))
        order = np.argsort(owner, kind="stable")
        owner, docs, copies, firsts = owner[order], docs[order], copies[order], firsts[order]
        least, first, counts = scan(family, list(known), owner, docs)
        low, high = np.minimum.reduceat(least, first)[owner], np.maximum.reduceat(least, first)[owner]
        # All windows of a context go, or some of them: those are looked at one by one.
        whole, some = high < docs, (low < docs) & (high >= docs)
        sizes = counts[owner[some]]
        step = runs(sizes)
        gone = least[np.repeat(first[owner[some]], sizes) + step] < np.repeat(docs[some], sizes)
        before = np.concatenate([[False], gone[:-1]]) & (step > 0)
        after = np.concatenate([gone[1:], [False]]) & (step + 1 < np.repeat(sizes, sizes))
        starts, stops = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
        of = np.flatnonzero(some)[np.repeat(np.arange(len(sizes)), sizes)[starts]]
        at = np.concatenate([firsts[whole], firsts[of] + step[starts]])
        length = np.concatenate([counts[owner[whole]], stops - starts + 1]) + LENGTH - 1
        rows = np.concatenate([np.flatnonzero(whole), of])
        return pa.RecordBatch.from_arrays(
            [pa.array(docs[rows], pa.int64()), pa.array(at << 32 | length << 25 | copies[rows], pa.int64())], ["doc_id", "run"]
        )

    family, bucket, number, blocks = Family(), None, None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            if blocks and (row["bucket"], row["batch"]) != (bucket, number):
                yield resolved(family, blocks)
                blocks = []
            if row["bucket"] != bucket:
                family = Family()
            bucket, number = row["bucket"], row["batch"]
            blocks.append(row)
    if blocks:
        yield resolved(family, blocks)


def cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` from ``doc_id, copy, text, found``."""
    for batch in small_batches(batches):
        sizes, removed, spans, kept = [], [], [], []
        for copy, text, found in zip(batch.column("copy").to_pylist(), batch.column("text").to_pylist(), batch.column("found"), strict=True):
            data = text.encode()
            every = found.values.to_numpy() if found.is_valid else np.empty(0, np.int64)
            mine = np.sort(every[every & (1 << 25) - 1 == copy])
            begin = mine >> 32
            reach = np.maximum.accumulate(begin + (mine >> 25 & 127))
            new = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]])) if len(mine) else np.empty(0, np.int64)
            starts = begin[new].tolist()
            stops = reach[np.append(new[1:], len(mine)) - 1].tolist() if len(mine) else []
            sizes.append(len(data))
            removed.append(sum(stops) - sum(starts))
            spans.append(len(starts))
            kept.append(b"".join(data[a:b] for a, b in zip([0, *stops], [*starts, len(data)], strict=True)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def without_repeats(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary: a cut may fall inside a letter) for every row.

    Null texts count as empty. Rows that repeat an id are cut each on its own, and not by each other; a null
    id is neither cut nor cuts others. A text shorter than a window stays. No rows in, no rows out; other
    columns are left out. Texts are shuffled once, by id: both joins with them read the same exchange.
    ``bucket_bytes`` is how many bytes of text there are for each bucket.
    """
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    texts = keyed_texts(df, id_column, text_column).withColumn("text", F.coalesce("text", F.lit("")))
    rows = texts.where("doc_id IS NOT NULL")
    cuts = [i / BATCHES for i in range(1, BATCHES)]
    bounds, size = rows.agg(F.percentile_approx("doc_id", cuts, 1000), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    # As many buckets as the texts' bytes ask for, whatever the number of partitions: a bucket is what one task holds.
    buckets = min(1 + size // bucket_bytes, (1 << 26) - 1)

    blocks = rows.mapInArrow(anchor_blocks(buckets), ANCHORS).repartition(parts, "bucket").sortWithinPartitions("bucket")
    entries = (
        blocks.mapInArrow(repeated_anchors, "doc_id long, entry long").groupBy("doc_id").agg(F.collect_list("entry").alias("entries"))
    )
    numbered = rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
    contexts = numbered.join(entries.hint("merge"), "doc_id").select("doc_id", "copy", "text", "entries").mapInArrow(
        context_blocks(sorted(set(bounds or []))), CONTEXTS
    )
    found = (
        contexts.repartition(parts, "bucket").sortWithinPartitions("bucket", "batch")
        .mapInArrow(repeated_runs, "doc_id long, run long").groupBy("doc_id").agg(F.collect_list("run").alias("found"))
    )
    cut = numbered.join(found.hint("merge"), "doc_id", "left").select("doc_id", "copy", "text", "found").mapInArrow(
        cut_runs, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    nobody = texts.where("doc_id IS NULL").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"),
    )
    return cut.unionByName(nobody)
