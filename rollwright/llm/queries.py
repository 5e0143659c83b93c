"""Registered queries of the numbered operators, and the SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwright.llm import (
    bpe_prefix,
    content_sort,
    fill_middle,
    id_shards,
    language_id,
    line_alignment,
    packing,
    preference,
    quality_rules,
    signature_join,
    source_divergence,
    suffix_family,
    toxicity,
)
from rollwright.llm.common import BYTE_VOCABULARY, WORD_VOCABULARY, tokenizer_path
from rollwright.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def little_endian(value: int) -> str:
    return value.to_bytes(4, "little").hex()


@query
def op3_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, indexed, found by key and read back; END is the contract's end id."""
    documents = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "shards")
    blocks = id_shards.write_shards(documents, folder, tokenizer_path(WORD_VOCABULARY), end_id=2, vocabulary_size=49_408)
    buckets = id_shards.write_index(spark, folder)
    keys = documents.groupBy("doc_id").count().select(
        "doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("copy")
    )
    found = id_shards.look_up(keys, folder, buckets)
    read = id_shards.read_documents(blocks).select("shard", "block", "slot", F.crc32("ids").alias("ids_crc32"))
    return (
        found.join(read, ["shard", "block", "slot"])
        .join(id_shards.block_starts(blocks), ["shard", "block"])
        .select(
            "doc_id", (F.col("block_start") + F.col("first")).alias("start"), F.col("length").alias("n_tokens"), "ids_crc32",
            "shard", "block", "slot",
        )
    )


@query
def op8_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(BYTE_VOCABULARY)
    encoded = bpe_prefix.encode_documents(table(spark, sf_dir, "documents"), path)
    return bpe_prefix.decode_documents(encoded, path).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op9_bound_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(
        table(spark, sf_dir, "documents"), tokenizer_path(BYTE_VOCABULARY), capacity=2048, end_id=0
    ).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces, 2048)


@query
def op4_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_sort(table(spark, sf_dir, "documents"), keep="largest")


ORACLES["op4_content_sort"] = """
    WITH t AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
        doc_id = max(doc_id) OVER (PARTITION BY s) AS kept, sha256(s) AS text_sha256
    FROM t
"""


@query
def op5_risk_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("stratum")


def _op5_sql() -> str:
    grid = [(m, c, i) for m, cuts in quality_rules.GRID.items() for i, c in enumerate(sorted(cuts, reverse=True))]
    tests = ", ".join(f"('{m}', {c}, {i})" for m, c, i in grid)
    value = "CASE g.measure " + " ".join(f"WHEN '{m}' THEN f.{m}" for m in quality_rules.GRID) + " END"
    limit = 0.01 / len(quality_rules.GRID)
    blank = "[\\x20\\x09-\\x0D]"
    return f"""
    WITH d AS (
        SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) AS u(i) WHERE len(w) > 5
    ), twice AS (
        SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1
    ), covered AS (
        SELECT doc_id, sum(least(5, i - before)) AS n FROM (
            SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -9) AS before FROM twice
        ) GROUP BY doc_id
    ), m AS (
        SELECT d.doc_id, stratum, len(w)::BIGINT AS n_words,
            length(regexp_replace(t, '{blank}', '', 'g'))::BIGINT AS word_chars,
            (length(t) - length(translate(t, '{quality_rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
            [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines,
            coalesce(covered.n, 0)::BIGINT AS n_repeat_words
        FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id
    ), f AS (
        SELECT doc_id, stratum, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
            n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
            CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbol_rate,
            CASE WHEN len(lines) > 0 THEN 1000 * (len(lines) - len(list_distinct(lines))) // len(lines) ELSE 0 END AS dup_line_rate,
            CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat_rate,
            CASE WHEN n_words > 0 THEN word_chars // n_words ELSE 0 END AS long_words, -n_words AS short_text
        FROM m
    ), g AS (SELECT * FROM (VALUES {tests}) AS g(measure, cutoff, place)),
    held AS (SELECT * FROM f WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
    base AS (SELECT stratum, count(*) AS n FROM held GROUP BY ALL),
    sizes AS (
        SELECT stratum, n * ln(1 - {limit}) > ln(0.025 / {len(quality_rules.GRID)} / (SELECT count(*) FROM base)) AS scarce FROM base
    ), counts AS (
        SELECT CASE WHEN scarce THEN '' ELSE stratum END AS s, scarce, g.measure, g.cutoff, g.place, count(*) AS n,
            count(*) FILTER (WHERE {value} > g.cutoff) AS r
        FROM held f JOIN sizes USING (stratum), g GROUP BY ALL
    ), tails AS (
        SELECT n, r, ln(sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({limit}) + (n - k) * ln(1 - {limit})))) AS tail
        FROM (SELECT DISTINCT n, r FROM counts WHERE r <= n * {limit}), unnest(range(0, r + 1)) AS u(k) GROUP BY ALL
    ), seq AS (
        SELECT s, scarce, measure, cutoff, max(coalesce(tail, 0)) OVER (PARTITION BY s, scarce, measure ORDER BY place) AS worst
        FROM counts LEFT JOIN tails USING (n, r)
    ), ends AS (SELECT s, scarce, measure, max(worst) AS e FROM seq GROUP BY ALL),
    steps AS (
        SELECT scarce, e, ln(0.025 / (count(*) OVER (PARTITION BY scarce) - row_number() OVER (PARTITION BY scarce ORDER BY e, s, measure) + 1)) AS level
        FROM ends
    ), levels AS (SELECT scarce, coalesce(min(level) FILTER (WHERE e > level), ln(0.025)) AS level FROM steps GROUP BY scarce),
    passed AS (SELECT s, scarce, measure, min(cutoff) AS cutoff FROM seq JOIN levels USING (scarce) WHERE worst <= level GROUP BY ALL),
    used AS (
        SELECT stratum, measure, cutoff FROM sizes JOIN passed ON sizes.scarce = passed.scarce AND (sizes.scarce OR s = stratum)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND NOT EXISTS (
            SELECT 1 FROM used g WHERE g.stratum = f.stratum AND {value} > g.cutoff
        ) AS kept
    FROM f
    """


ORACLES["op5_risk_thresholds"] = _op5_sql()


@query
def op7_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query
def op10_pattern_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letter tables come from the documents' declared languages."""
    return language_id.page_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents").select("text", "lang"))


@query
def op6_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_alignment.without_aligned_lines(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", F.when(F.col("_removed").isNull(), 0).otherwise(F.size("_removed")).cast("long").alias("n_removed"),
        F.coalesce("_blocks", F.lit(0)).cast("long").alias("n_blocks"), F.coalesce("_partners", F.lit(0)).cast("long").alias("n_partners"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


@query
def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with a weaker last reply, as the table has no rejected sides."""
    chosen = preference.conversations(table(spark, sf_dir, "conversations"))
    return preference.preference_pairs(chosen, preference.with_weaker_reply(chosen)).select(
        "pair_id", "n_prompt_turns", F.sha2(F.col("prompt").cast("binary"), 256).alias("prompt_sha256"), "chosen", "rejected",
        F.to_json("chosen_spans").alias("chosen_spans"), F.to_json("rejected_spans").alias("rejected_spans"),
    )


@query
def op11_rank_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut at two drawn line boundaries, by the learned index, and put together again from its output."""
    sha = {name: F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256") for name in ("output", "restored")}
    return fill_middle.fill_middle(table(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", *sha.values()
    )


ORACLES["op11_rank_index"] = """
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
            regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u
        FROM documents
    ), k AS (
        SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
            ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
        FROM d
    ), f AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
        FROM k
    ), p AS (
        SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix
        FROM f
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM p
"""


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language lie apart, and the ten terms that mark each of them."""
    return source_divergence.source_divergence(table(spark, sf_dir, "documents"), least_docs=10, top=10)


ORACLES["op12_source_divergence"] = """
    WITH d AS (
        SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
        FROM documents
    ), t AS (
        SELECT i, lang, source, unnest(terms) AS term FROM d
    ), kept AS (
        SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT i) >= 10
    ), v AS (
        SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY ALL
    ), g AS (
        SELECT DISTINCT lang, source FROM d
    ), c AS (
        SELECT t.lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
    ), gn AS (
        SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL
    ), p AS (
        SELECT lang, source, term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (gn.total + 2 * v.v)::HUGEINT)::BIGINT AS p,
            (1 + 1000000000::HUGEINT * (kept.n + 2) // (v.total + 2 * v.v)::HUGEINT)::BIGINT AS q
        FROM gn JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), every AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    ), parts AS (
        SELECT lang, source, 'pair' AS part, item, value FROM every
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
    )
    SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM parts
    QUALIFY part = 'pair' OR rank <= 10
"""


@query
def op13_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the bytes of 50-byte strings that an earlier document has."""
    return suffix_family.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
