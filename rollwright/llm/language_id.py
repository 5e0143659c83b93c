"""Language by Bayesian fusion of the text with where and how it was published.

log P(language | evidence) = log prior of the host + log likelihood of the text + log P(declared | language)
+ log P(address suffix | language). Text likelihoods come from counts of letter pairs for each language;
a long text's pairs are not independent, so the sum is tempered to at most ``PAIRS`` of them. All other
tables are grouped counts over the whole input of the language that the text alone suggests: declared
language and suffix with add-one smoothing, and host priors smoothed from level to level, a host towards its
domain, the domain towards its suffix, and the suffix towards all pages, each with the weight of
``STRENGTH`` observations. No list of languages is built in: it is that of the training rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwright.llm.common import small_batches
from rollwright.session import materialise

PAIRS = 40
STRENGTH = 20.0
CODES = 512  # letters fold into so many codes; a pair has one count
TRAINING_ROWS = 4_000  # rows of each language that the letter tables are fitted on at most, whole texts

SKIPPED = regex.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&\w+;")
DECLARED = r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]+)"


def pair_codes(text: str) -> np.ndarray:
    """Codes of neighbouring letters, lower-cased, with a blank for every run of other characters."""
    letters = regex.sub(r"[^\p{L}]+", " ", text.lower())
    codes = np.frombuffer(letters.encode("utf-32-le"), "<u4").astype(np.int64) % CODES
    return codes[:-1] * CODES + codes[1:]


def letter_tables(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """All languages, and log probabilities of letter pairs in each (1 MB for one), from ``text, lang``."""

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            orders, names = batch.column("order").to_numpy(), batch.column("lang").dictionary_encode()
            at = names.indices.to_numpy()
            for i, lang in enumerate(names.dictionary.to_pylist()):
                both = np.concatenate([held.get(lang, np.zeros(0, np.int64)), orders[at == i]])
                held[lang] = np.unique(both)[:TRAINING_ROWS]
        for lang, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own, pa.int64())], ["lang", "order"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            codes: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                codes.setdefault(lang, []).append(pair_codes(text or ""))
            for lang, own in codes.items():
                pairs, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(pairs), pa.string()), pa.array(pairs, pa.int64()), pa.array(n, pa.int64())],
                    ["lang", "pair", "n"],
                )

    ranked = rows.where("lang IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("order"))
    # Hashes alone are ranked, so no whole texts meet in one task; copies of a text count once. Each task hands
    # on its lowest hashes of each language, and the last one in use comes back: a row for each language.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    few = ranked.select("lang", "order").mapInArrow(lowest, "lang string, order long").distinct()
    last = few.withColumn("rank", rank).where(F.col("rank") <= TRAINING_ROWS).groupBy("lang").agg(F.max("order").alias("last"))
    limits = last.collect()
    langs = sorted(r["lang"] for r in limits)
    size = CODES * CODES
    tables = np.full((len(langs), size), -np.log(size), np.float32)
    if not langs:
        return langs, tables
    small = rows.sparkSession.createDataFrame(limits, "lang string, last long")
    sample = ranked.join(F.broadcast(small), "lang").where(F.col("order") <= F.col("last")).dropDuplicates(["lang", "order"])
    counted = sample.select("text", "lang").mapInArrow(count, "lang string, pair long, n long")
    counted = counted.groupBy("lang", "pair").agg(F.sum("n").alias("n"))
    at = {lang: i for i, lang in enumerate(langs)}
    for row in counted.groupBy("lang").agg(F.collect_list("pair").alias("pairs"), F.collect_list("n").alias("counts")).toLocalIterator():
        own = np.full(size, 0.1)
        own[row["pairs"]] += row["counts"]
        tables[at[row["lang"]]] = np.log(own / own.sum())
    return langs, tables


def text_evidence(df: DataFrame, langs: list[str], tables: np.ndarray, markup: bool) -> DataFrame:
    """Adds ``evidence`` (tempered log likelihood of each language, best is 0) and ``letters``; drops ``text``."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(np.ascontiguousarray(tables.T))
    names = [c for c in df.columns if c != "text"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            evidence, sizes = [], []
            for text in batch.column("text").to_pylist():
                pairs = pair_codes(SKIPPED.sub(" ", text or "") if markup else text or "")
                sizes.append(len(pairs))
                total = shared.value[pairs].sum(axis=0, dtype=np.float64) if len(pairs) else np.zeros(len(langs))
                total *= min(1.0, PAIRS / max(1, len(pairs)))
                evidence.append((total - total.max()).tolist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(evidence, pa.list_(pa.float64())), pa.array(sizes, pa.int64())],
                [*names, "evidence", "letters"],
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name != "text")
    return df.mapInArrow(judge, f"{fields}, evidence array<double>, letters long")


def host_levels(url: Column) -> list[tuple[str, Column]]:
    """Host, its domain (last two labels) and suffix (last label); '' where the address has none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1))
    return [
        ("host", host), ("domain", F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1)), ("suffix", F.regexp_extract(host, r"([^.]*)$", 1)),
    ]


def fuse(judged: DataFrame, langs: list[str], levels: list[str]) -> DataFrame:
    """Adds ``language``, ``posterior`` and ``posteriors`` to rows with ``evidence, letters, declared`` and the levels.

    ``levels`` run from the narrowest group to the widest. Each level's counts are one grouped aggregate with
    a row for each group; they meet rows by joins on the group, whose hot keys Spark can split.
    """
    size = len(langs)
    array = lambda columns: F.array(*columns)
    guess = F.array_position("evidence", F.array_max("evidence")) - 1
    judged = materialise(judged.withColumn("guess", F.when(F.col("letters") > 0, guess)), "judged")
    seen = array([F.count_if(F.col("guess") == i) for i in range(size)])
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)

    def smoothed(counts: str, parent: Column) -> Column:
        return F.zip_with(counts, parent, lambda n, p: (n + STRENGTH * p) / (total(counts) + STRENGTH))

    overall = judged.agg(seen.alias("counts")).withColumn("prior", smoothed("counts", array([F.lit(1 / size)] * size)))
    # Priors descend from the widest level; each group's own counts are pulled towards the level above.
    priors = overall.select(F.lit(1).alias("all"), F.col("prior").alias("prior_0"))
    table = None
    for depth in range(len(levels), 0, -1):
        names = levels[depth - 1 :]
        counts = judged.groupBy(*names).agg(seen.alias("counts"))
        if table is None:
            above = counts.withColumn("all", F.lit(1)).join(F.broadcast(priors), "all").withColumnRenamed("prior_0", "parent")
        else:
            above = counts.join(table.withColumnRenamed("prior", "parent"), levels[depth:])
        table = above.select(*names, smoothed("counts", F.col("parent")).alias("prior"))
    declared = judged.groupBy("declared").agg(seen.alias("said"))
    sums = judged.agg(seen.alias("each"), F.count_distinct("declared").alias("kinds"))
    said = declared.withColumn("all", F.lit(1)).join(F.broadcast(sums.withColumn("all", F.lit(1))), "all")
    said = said.select("declared", F.zip_with("said", "each", lambda n, e: F.log((n + 1.0) / (e + F.col("kinds") + 1.0))).alias("says"))
    fused = judged.join(table, levels).join(said, "declared")
    logs = F.zip_with(F.zip_with("evidence", "prior", lambda e, p: e + F.log(p)), "says", lambda x, s: x + s)
    weights = F.transform("logs", lambda x: F.exp(x - F.array_max("logs")))
    names = array([F.lit(lang) for lang in langs])
    return (
        fused.withColumn("logs", logs).withColumn("weights", weights)
        .withColumn("posteriors", F.transform("weights", lambda w: w / F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)))
        .withColumn("posterior", F.array_max("posteriors"))
        .withColumn("language", F.element_at(names, F.array_position("posteriors", F.array_max("posteriors")).cast("int")))
        .drop("logs", "weights", "prior", "says", "evidence", "guess")
    )


def page_languages(pages: DataFrame, training: DataFrame) -> DataFrame:
    """``page_id, language, posterior, declared, host`` for every page; ``training`` has ``text, lang``.

    Null pages, addresses and declarations count as empty: such rows are judged by what is left, down to the
    prior over all pages. Rows that repeat are judged each. No rows in, no rows out; with no training rows no
    language is known and no row comes out. Other columns are left out.
    """
    langs, tables = letter_tables(training)
    if not langs:
        return pages.select(
            F.col("page_id").cast("long"), F.lit("").alias("language"), F.lit(0.0).alias("posterior"),
            F.lit("").alias("declared"), F.lit("").alias("host"),
        ).limit(0)
    text = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.lower(F.regexp_extract(text, DECLARED, 1)).alias("declared"),
        *(c.alias(n) for n, c in host_levels(F.col("url"))), text.alias("text"),
    )
    fused = fuse(text_evidence(rows, langs, tables, markup=True), langs, ["host", "domain", "suffix"])
    return fused.select("page_id", "language", "posterior", "declared", "host")


def documents_in_language(docs: DataFrame, least: float = 1e-6) -> DataFrame:
    """Rows whose declared language is not refuted, in their own columns.

    The declared language is ``lang``, the host is ``source``. A row goes when it holds letters and its
    declared language keeps a posterior under ``least``; rows without a declaration or letters stay.
    """
    langs, tables = letter_tables(docs.select("text", "lang"))
    if not langs:
        return docs
    rows = materialise(docs.withColumn("row_key", F.monotonically_increasing_id()), "documents")
    judged = text_evidence(
        rows.select(
            "row_key", F.coalesce(F.col("lang"), F.lit("")).alias("declared"), F.coalesce(F.col("source"), F.lit("")).alias("host"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ), langs, tables, markup=False,
    )
    fused = fuse(judged, langs, ["host"])
    at = F.array_position(F.array(*(F.lit(lang) for lang in langs)), F.col("declared")).cast("int")
    own = F.when(at > 0, F.get("posteriors", at - 1))
    gone = fused.where((F.col("letters") > 0) & (own < least)).select("row_key")
    return rows.join(gone, "row_key", "left_anti").select(*docs.columns)
