"""Quality rules whose cutoffs are chosen under a bound on false rejection.

Measures are counted on whole texts. A rule rejects a text whose measure lies above a cutoff. For every
stratum and measure the candidate cutoffs are a fixed grid; on a labelled holdout the false rejections of
a cutoff are the good texts that it rejects. If a rule's true rate of false rejection were over its
``limit``, the chance of so few false rejections would be at most the binomial tail P(X <= r), X ~ Bin(n, limit),
which is the exact Clopper-Pearson bound. The limit is shared evenly by the measures.

The cutoffs of a measure are nested, so they are tested in fixed sequence, from the loosest to the strictest, until
one fails: that needs no division by their number. The sequences of all strata and measures share the risk by Holm's
steps: each has an equal share, and those accepted to their end leave theirs to the others. A stratum too small for
any cutoff, even without a false rejection, counts as scarce: scarce strata are tested as one, with a share of the
risk of its own (``pooled``), and use its cutoffs. Of the accepted cutoffs the strictest is used; without
one a rule rejects nothing. With probability 1 - ``risk``, the cutoffs in use together reject at most ``limit``
of the good texts of every stratum tested by itself, and of the scarce ones taken together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwright.session import materialise

# Fixed values of the contract: what a word is made of, and which characters count as symbols.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Cutoffs on a grid, the same for every input: measures are per mille of the text's words or characters.
GRID = {
    "symbol_rate": [20, 50, 100, 200, 300, 500],
    "dup_line_rate": [20, 50, 100, 200, 300, 500],
    "repeat_rate": [20, 50, 100, 150, 200],
    "long_words": [8, 10, 12, 15, 20, 30],
    "short_text": [-15, -20, -30, -50],
}


def base_measures(
    df: DataFrame, stratum: str, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id, stratum``, counts and ``base_failed``, a row for each row.

    Null and empty texts have none of everything and fail the base rules. ``n_repeat_words`` counts the
    words that lie in a five-word window found twice or more in the text; ``n_dup_lines`` the lines with a
    word that equal an earlier line.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("int")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = df.select(
        F.col(id_column).cast("long").alias("doc_id"), words.alias("words"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    # Hashes of all windows in order; a window found again has its hash at more than one place. Sorting the
    # (hash, place) pairs puts equal windows side by side.
    at = F.sequence(F.lit(0), F.size("words") - WINDOW)
    windows = F.when(
        F.size("words") >= WINDOW + 1,
        F.array_sort(F.transform(at, lambda i: F.struct(
            F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW))).alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    twice = F.filter(
        F.transform(
            F.col("sorted"),
            lambda x, j: F.when(
                F.get("sorted", j - 1).getField("h").eqNullSafe(x["h"]) | F.get("sorted", j + 1).getField("h").eqNullSafe(x["h"]),
                x["i"],
            ).otherwise(none),
        ),
        lambda i: i.isNotNull(),
    )
    # Words covered by windows at ascending places: each adds what the one before it left uncovered.
    covered = F.aggregate(
        F.array_sort("repeated"),
        F.struct(zero.alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("long").alias("n"), i.alias("last")
        ),
        lambda a: a["n"],
    )
    counted = (
        rows.withColumn("sorted", windows).withColumn("repeated", twice)
        .select(
            "doc_id", "stratum", F.size("words").cast("long").alias("n_words"),
            F.aggregate("words", zero, lambda a, w: a + F.length(w)).alias("word_chars"), "n_symbols",
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.size("lines").cast("long").alias("n_lines"), covered.alias("n_repeat_words"),
        )
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def rates(measured: DataFrame) -> DataFrame:
    """Adds the measures that cutoffs apply to, as whole numbers, so that both sides of a test are exact."""

    def per_mille(count: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.floor(1000 * F.col(count) / F.col(of))).otherwise(F.lit(0)).cast("long")

    return measured.withColumns({
        "symbol_rate": per_mille("n_symbols", "word_chars"),
        "dup_line_rate": per_mille("n_dup_lines", "n_lines"),
        "repeat_rate": per_mille("n_repeat_words", "n_words"),
        "long_words": F.when(F.col("n_words") > 0, F.floor(F.col("word_chars") / F.col("n_words"))).otherwise(F.lit(0)).cast("long"),
        "short_text": -F.col("n_words"),
    })


def log_tail(n: Column, r: Column, limit: float) -> Column:
    """ln P(Bin(n, limit) <= r), summed term by term in logarithms from 0 on."""
    first = n * math.log(1 - limit)

    def step(a: Column, k: Column) -> Column:
        term = a["term"] + F.log((n - k + 1).cast("double") / k) + math.log(limit / (1 - limit))
        high, low = F.greatest(a["total"], term), F.least(a["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    terms = F.when(r >= 1, F.sequence(F.lit(1).cast("long"), r)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, F.struct(first.alias("term"), first.alias("total")), step, lambda a: a["total"])


def held_levels(tests: DataFrame, risk: float) -> DataFrame:
    """``stratum, measure, cutoff`` accepted at ``risk``, from ``stratum, measure, cutoff, place, worst``.

    ``place`` counts the cutoffs of a sequence from the loosest on; ``worst`` is the largest logarithm of a tail
    up to it. Sequences are a few for each stratum: those that hold to their end, sorted by that tail, are
    compared with the risk over the sequences left, and what is left shares the risk evenly.
    """
    ends = tests.groupBy("stratum", "measure").agg(F.max("worst").alias("end"))
    steps = ends.select(
        "stratum", "measure", "end", F.row_number().over(Window.orderBy("end", "stratum", "measure")).alias("step"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("m"),
    )
    short = steps.where(F.col("end") > F.log(F.lit(risk) / (F.col("m") - F.col("step") + 1)))
    # Where every sequence holds to its end nothing is left to share, and any level up to the whole risk will do.
    level = F.coalesce(
        short.groupBy().agg(F.min(F.log(F.lit(risk) / (F.col("m") - F.col("step") + 1))).alias("level")).select("level").scalar(), F.lit(math.log(risk))
    )
    return tests.where(F.col("worst") <= level).select("stratum", "measure", "cutoff")


def cutoffs(
    measured: DataFrame, labels: DataFrame, limit: float = 0.01, risk: float = 0.05, pooled: float = 0.5,
) -> DataFrame:
    """``stratum, measure, cutoff`` for each cutoff in use.

    ``labels`` has ``doc_id, quality``; a row counts as a good text where quality is 1 and the base rules
    pass. Rows without a label, id or measure count nowhere; labels of one id given twice count once. A stratum
    without a good text has no cutoff.
    """
    grid = [(measure, int(cut), place) for measure, cuts in GRID.items() for place, cut in enumerate(sorted(cuts, reverse=True))]
    share = limit / len(GRID)
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    holdout = measured.where("NOT base_failed").join(good, "doc_id", "left_semi")
    counts = holdout.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(F.col(m) > c).alias(f"r{i}") for i, (m, c, _) in enumerate(grid)),
    )
    # One row for each stratum; the number of strata is an aggregate over those.
    strata = counts.select("stratum").groupBy().count().select("count").scalar()
    needed = F.log(F.lit(risk * (1 - pooled) / len(GRID)) / strata)
    counts = materialise(counts.withColumn("scarce", F.col("n") * math.log(1 - share) > needed), "holdout")
    sums = [F.sum(c).alias(c) for c in counts.columns if c not in ("stratum", "scarce")]
    together = counts.where("scarce").groupBy().agg(*sums).where("n > 0").select(F.lit("").alias("stratum"), F.lit(True).alias("scarce"), *(s for s in counts.columns if s not in ("stratum", "scarce")))

    def tested(rows: DataFrame) -> DataFrame:
        unfolded = rows.select("stratum", "n", F.explode(F.array(*(
            F.struct(F.lit(m).alias("measure"), F.lit(c).cast("long").alias("cutoff"), F.lit(place).alias("place"), F.col(f"r{i}").alias("r"))
            for i, (m, c, place) in enumerate(grid)
        ))).alias("t")).select("stratum", "n", "t.*")
        # A tail over more than the mean is no evidence, and is not summed: more terms than n * limit never help.
        tail = F.when(F.col("r") <= F.col("n") * share, log_tail(F.col("n"), F.col("r"), share)).otherwise(F.lit(0.0))
        so_far = Window.partitionBy("stratum", "measure").orderBy("place")
        return unfolded.withColumn("worst", F.max(tail).over(so_far))

    own = held_levels(tested(counts.where("NOT scarce")), risk * (1 - pooled))
    shared = held_levels(tested(together), risk * pooled).select("measure", "cutoff")
    # At most one row for each measure.
    pool = shared.groupBy("measure").agg(F.min("cutoff").alias("cutoff")).groupBy().agg(F.collect_list(F.struct("measure", "cutoff")).alias("held"))
    scarce = counts.where("scarce").select("stratum", F.explode(pool.select("held").scalar()).alias("t")).select("stratum", "t.*")
    use = own.unionByName(scarce)
    return use.groupBy("stratum", "measure").agg(F.min("cutoff").alias("cutoff"))


def quality_verdicts(
    df: DataFrame, labels: DataFrame, stratum: str = "lang", id_column: str = "doc_id", text_column: str = "text",
    limit: float = 0.01, risk: float = 0.05, pooled: float = 0.5,
) -> DataFrame:
    """Base measures of every row, ``stratum``, and ``kept``: base rules pass and no cutoff of the stratum rejects.

    A null stratum counts as ''. Measures are written once, as labels and verdicts both read them. Cutoffs
    become one row for each stratum. No rows in, no rows out; without labels the base rules decide alone.
    """
    measured = materialise(rates(base_measures(df, stratum, id_column, text_column)), "measures")
    in_use = cutoffs(measured, labels, limit, risk, pooled).groupBy("stratum").agg(
        *(F.max(F.when(F.col("measure") == m, F.col("cutoff"))).alias(f"{m}_cutoff") for m in GRID)
    )
    rejected = F.lit(False)
    for m in GRID:
        rejected = rejected | F.coalesce(F.col(m) > F.col(f"{m}_cutoff"), F.lit(False))
    # One row for each stratum that has cutoffs, so no stratum is hot; Spark broadcasts it where it has found it small.
    return measured.join(in_use, "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"), "stratum",
    )
