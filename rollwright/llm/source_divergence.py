"""Divergence of the word use of sources, with terms as digests until the results are known.

A task turns whole texts into rows ``lang, source, digest, n, docs``: how often a term occurs in the texts of a
group that the task has seen, and in how many of them. Beside them it gives each distinct term once, with its
digest. Both are written once. From then on only 64-bit digests are shuffled, and terms are read for two uses:

* digests that enough documents hold get their smallest and largest term. Where these differ, terms collide:
  such digests are counted again with the term beside them, and every later step knows them by both.
* the terms of the rows that are returned, and of those that tie with the last of them, are joined back.

Values are whole numbers: per 10^9, products of counts as decimals of 38 digits, quotients rounded down.
The sum over all kept terms for two sources of a language is taken in tasks that hold a few terms of all
sources: the terms that one source lacks count there with its share of an unseen term.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwright.llm.common import small_batches
from rollwright.session import materialise

SCALE = 1_000_000_000
COUNTED = "lang string, source string, digest long, term string, n long, docs long"
COLUMNS = ["lang", "source", "digest", "term", "n", "docs"]
# A byte that belongs to no term becomes a blank; A-Z become a-z.
TERM_BYTES = bytes(
    b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Group, digest, occurrences and documents, added up by group and digest."""
    group, digest, n, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((digest, group))
    group, digest = group[order], digest[order]
    new = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (digest[1:] != digest[:-1])]))
    return group[new], digest[new], np.add.reduceat(n[order], new), np.add.reduceat(docs[order], new)


def _digest(bits: int) -> Callable[[bytes], int]:
    mask = (1 << bits) - 1

    def digest(term: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(term) & mask
        return value - (1 << 64) if value >> 63 else value

    return digest


def _groups_and_texts(df: DataFrame, text_column: str, lang_column: str, source_column: str) -> DataFrame:
    names = {"lang": lang_column, "source": source_column, "text": text_column}
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for name, c in names.items()))


def term_counts(texts: DataFrame, digest_bits: int = 64, held_rows: int = 1 << 19) -> DataFrame:
    """Counts by group and digest (``term`` is null), and the terms of all digests (``n`` and ``docs`` are 0).

    A task adds up what it has seen, gives it out once it has ``held_rows`` counts or terms, and holds no more.
    """
    digest = _digest(digest_bits)

    def counts(parts: list[tuple[np.ndarray, ...]], names: list[tuple[str, str]]) -> pa.RecordBatch:
        group, digests, n, docs = parts[0]
        langs, sources = (pa.array(x, pa.string()) for x in zip(*names, strict=True))
        at = pa.array(group)
        return pa.RecordBatch.from_arrays(
            [langs.take(at), sources.take(at), pa.array(digests), pa.nulls(len(group), pa.string()), pa.array(n), pa.array(docs)], COLUMNS
        )

    def terms(known: dict[bytes, int]) -> pa.RecordBatch:
        zeros = pa.array(np.zeros(len(known), np.int64))
        blank = pa.array([""] * len(known), pa.string())
        return pa.RecordBatch.from_arrays(
            [blank, blank, pa.array(list(known.values()), pa.int64()), pa.array([t.decode() for t in known], pa.string()), zeros, zeros], COLUMNS
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        groups: dict[tuple[str, str], int] = {}
        parts: list[tuple[np.ndarray, ...]] = []
        pending = least = 0
        for batch in small_batches(batches):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                found = Counter(text.encode().translate(TERM_BYTES).split())
                if not found:
                    continue
                for term in found:
                    if term not in known:
                        known[term] = digest(term)
                size = len(found)
                group = groups.setdefault((lang, source), len(groups))
                pending += size
                parts.append((
                    np.full(size, group), np.fromiter(map(known.__getitem__, found), np.int64, size),
                    np.fromiter(found.values(), np.int64, size), np.ones(size, np.int64),
                ))
            if pending > max(least, held_rows // 4):
                parts, pending = [summed(parts)], 0
                least = len(parts[0][0])
                if least >= held_rows:
                    yield counts(parts, list(groups))
                    parts, groups, least = [], {}, 0
            if len(known) >= held_rows:
                yield terms(known)
                known = {}
        if parts:
            yield counts([summed(parts)], list(groups))
        if known:
            yield terms(known)

    return texts.mapInArrow(count, COUNTED)


def counts_by_term(texts: DataFrame, digest_bits: int = 64) -> DataFrame:
    """Counts by group and term, a row for each text and term, with the term's digest."""
    digest = _digest(digest_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            rows = [
                (lang, source, digest(term), term.decode(), n, 1)
                for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True)
                for term, n in Counter(text.encode().translate(TERM_BYTES).split()).items()
            ]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], COLUMNS)

    return texts.mapInArrow(count, COUNTED)


def share(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kinds)), exact."""
    over = (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    under = (total + 2 * kinds).cast("decimal(20,0)")
    return F.call_function("div", over, under) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def split_counts(texts: DataFrame, least_docs: int, digest_bits: int) -> tuple[DataFrame, DataFrame]:
    """Counts by ``lang, source, digest, split`` of terms that may be kept, and ``digest, split, term`` of them.

    ``split`` is the term itself where its digest is that of another term too, '' otherwise. Texts are read again
    for such digests only.
    """
    counted = materialise(term_counts(texts, digest_bits), "counted")
    by_digest = materialise(
        counted.where("term IS NULL").groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "digests"
    )
    frequent = by_digest.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    candidates = frequent.select("digest").distinct()
    held = materialise(
        counted.where("term IS NOT NULL").groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high"))
        .join(candidates, "digest", "left_semi"), "terms",
    )
    alone = held.where("low = high")
    clear = by_digest.join(alone.select("digest"), "digest", "left_semi").withColumn("split", F.lit(""))
    terms = alone.select("digest", F.lit("").alias("split"), F.col("low").alias("term"))
    mixed = held.where("low < high").select("digest")
    if not mixed.isEmpty():
        again = counts_by_term(texts, digest_bits).join(mixed, "digest", "left_semi").groupBy(
            "lang", "source", "digest", F.col("term").alias("split")
        ).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        again = materialise(again, "collisions")
        clear = clear.unionByName(again)
        terms = terms.unionByName(again.select("digest", "split", F.col("split").alias("term")).distinct())
    return clear, terms


def pair_sums(group: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of one group for every two sources: a row of shares for each source, in blocks."""
    order = sources.sort_values("source")
    names, unseen = order["source"].to_numpy(), order["unseen"].to_numpy(np.int64)
    place = {name: i for i, name in enumerate(names)}
    column = group.groupby(["digest", "split"], sort=False).ngroup().to_numpy()
    shares = np.repeat(unseen[:, None], column.max() + 1, axis=1)
    shares[group["source"].map(place).to_numpy(), column] = group["p"].to_numpy(np.int64)
    left, right, values = [], [], []
    for i in range(len(names) - 1):
        p, q = shares[i], shares[i + 1 :]
        values.append(((q - p) ** 2 // (q + p)).sum(axis=1))
        left.append(np.full(len(q), i))
        right.append(np.arange(i + 1, len(names)))
    if not values:
        return pd.DataFrame({"lang": [], "source": [], "item": [], "value": []})
    left, right, values = np.concatenate(left), np.concatenate(right), np.concatenate(values)
    return pd.DataFrame({
        "lang": order["lang"].iloc[0], "source": names[np.concatenate([left, right])], "item": names[np.concatenate([right, left])],
        "value": np.concatenate([values, values]),
    })


def source_divergence(
    df: DataFrame, least_docs: int = 10, top: int = 10, text_column: str = "text", lang_column: str = "lang",
    source_column: str = "source", digest_bits: int = 64, cells: int = 1 << 19,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far a source lies from the others of its language, and by which terms.

    Null texts, languages and sources count as ''. Each row is a document of its own, rows that repeat too.
    Part ``pair`` has every other source of the language, part ``term`` the ``top`` terms that the group uses
    more than its language; a language with one source has no pair, one without kept terms pairs of value 0.
    ``digest_bits`` may be set low to force collisions. ``cells`` bounds sources times terms in one task. No
    rows in, no rows out; other columns are left out.
    """
    groups = materialise(
        df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_column, "lang"), (source_column, "source")))).distinct(),
        "groups",
    )
    clear, terms = split_counts(_groups_and_texts(df, text_column, lang_column, source_column), least_docs, digest_bits)
    key = ["lang", "digest", "split"]
    kept = clear.groupBy(*key).agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least_docs).drop("docs")
    used = materialise(clear.drop("docs").join(kept, key), "used")

    of_lang = used.groupBy(*key).agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("lang_total"))
    of_group = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    totals = materialise(
        groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").join(sizes, "lang")
        .fillna(0, ["total", "kinds", "lang_total"]), "totals",
    )
    zero = F.lit(0).cast("long")
    shares = used.join(totals, ["lang", "source"]).select(
        "lang", "source", "digest", "split", share(F.col("n"), F.col("total"), F.col("kinds")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kinds")).alias("q"),
        F.greatest(F.lit(1), F.ceil(F.col("sources") * F.col("kinds") / F.lit(cells))).cast("long").alias("buckets"),
    )

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    near = (
        shares.where("p > q").select("lang", "source", "digest", "split", gap(F.col("p"), F.col("q")).alias("value"))
        .withColumn("at", F.rank().over(by_value)).where(F.col("at") <= top).drop("at")
    )
    by_rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    named = near.join(terms, ["digest", "split"]).select("lang", "source", F.col("term").alias("item"), "value")
    best = named.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= top)

    dealt = shares.select("lang", "source", "digest", "split", "p", F.pmod(F.xxhash64("digest", "split"), F.col("buckets")).alias("bucket"))
    full = dealt.select("lang", F.col("bucket").alias("part")).distinct()
    beside = totals.where("kinds > 0 AND sources > 1").select(
        "lang", "source", share(zero, F.col("total"), F.col("kinds")).alias("unseen")
    ).join(full, "lang").withColumnRenamed("part", "bucket")
    sums = (
        dealt.join(sizes.where("sources > 1"), "lang", "left_semi").groupBy("lang", "bucket").cogroup(beside.groupBy("lang", "bucket"))
        .applyInPandas(pair_sums, "lang string, source string, item string, value long")
    )
    bare = totals.where("kinds = 0").select("lang", "source")
    nothing = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").withColumn("value", zero)
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(nothing)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    ranked = pairs.withColumn("rank", F.row_number().over(by_rank)).withColumn("part", F.lit("pair")).select(columns)
    return ranked.unionByName(best.withColumn("part", F.lit("term")).select(columns))
