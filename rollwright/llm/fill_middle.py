"""Fill-in-middle rearrangement over a learned index of line boundaries.

The units of a text are its lines, each with its line feed. The offsets (in code points) of all boundaries
between units, from 0 to the length of the text, are a rising function of their rank. It is fitted by straight
segments: each grows as far as one slope keeps every prediction within ``ERROR`` code points of the offset
(the cone of slopes that all points so far allow must not be empty). What a prediction is off by is stored in
one byte for each boundary. A cut at a rank is the prediction of the segment that holds the rank, corrected by
its residual: exact, at the price of one byte a line and no search through the text.

The index is a column beside the text, and may be stored: cuts of other seeds then need no new scan for lines.
Only the fit runs in Python; hashes, cuts, output and its reversal are column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwright.llm.common import keyed_texts, small_batches

ERROR = 120  # with the rounding of a prediction a residual still fits in one signed byte
INDEX = "struct<ranks:array<int>,starts:array<bigint>,slopes:array<double>,residuals:array<tinyint>>"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def boundaries(text: str) -> np.ndarray:
    """Offsets of all boundaries between the units of a text, in code points: 0 first, the length last."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    at = np.flatnonzero(data == 10) + 1
    if len(data) and (not len(at) or at[-1] != len(data)):
        at = np.append(at, len(data))
    at = np.concatenate([[0], at])
    if len(data) != len(text):  # bytes that go on with a code point do not count
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
    return at.astype(np.int64)


def segment(offsets: np.ndarray, first: int, error: int) -> tuple[int, float]:
    """End and slope of the longest segment from rank ``first`` on that keeps within ``error``."""
    low, high, end, step = -np.inf, np.inf, first + 1, 64
    while end < len(offsets):
        rise = offsets[end : end + step] - offsets[first]
        run = np.arange(end - first, end - first + len(rise))
        highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
        lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
        empty = lows > highs
        fits = int(empty.argmax()) if empty.any() else len(rise)
        if fits:
            low, high, end = lows[fits - 1], highs[fits - 1], end + fits
        if fits < len(rise):
            break
        step *= 2
    return end, float((low + high) / 2) if end > first + 1 else 0.0


def fit(offsets: np.ndarray, error: int = ERROR) -> tuple[list[int], list[int], list[float], np.ndarray]:
    """First ranks, first offsets and slopes of the segments, and the residual of every rank."""
    ranks, starts, slopes, first = [], [], [], 0
    residuals = np.empty(len(offsets), np.int8)
    while first < len(offsets):
        end, slope = segment(offsets, first, error)
        ranks.append(first)
        starts.append(int(offsets[first]))
        slopes.append(slope)
        predicted = offsets[first] + np.floor(slope * np.arange(end - first)).astype(np.int64)
        residuals[first:end] = offsets[first:end] - predicted
        first = end
    return ranks, starts, slopes, residuals


def with_rank_index(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text, rank_index`` for every row; a null text counts as empty, with the one boundary 0."""
    fields = [
        ("ranks", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("slopes", pa.list_(pa.float64())),
        ("residuals", pa.list_(pa.int8())),
    ]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            fits = [fit(boundaries(text)) for text in batch.column("text").to_pylist()]
            columns = [pa.array(column, kind) for column, (_, kind) in zip(zip(*fits, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.StructArray.from_arrays(columns, fields=[pa.field(*f) for f in fields])],
                ["doc_id", "text", "rank_index"],
            )

    texts = keyed_texts(df, id_column, text_column).withColumn("text", F.coalesce("text", F.lit("")))
    return texts.mapInArrow(index, f"doc_id long, text string, rank_index {INDEX}")


def offset_at(index: Column, rank: Column) -> Column:
    """The offset of a boundary: prediction of its segment, corrected by its residual."""
    held = F.size(F.filter(index["ranks"], lambda first: first <= rank))
    predicted = F.floor(F.element_at(index["slopes"], held) * (rank - F.element_at(index["ranks"], held)))
    return F.element_at(index["starts"], held) + predicted + F.element_at(index["residuals"], (rank + 1).cast("int"))


def draws(seed: int) -> list[Column]:
    """Four numbers below 2**32 that depend on the seed and the id alone; a null id draws as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def rearranged(indexed: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` from texts with their index.

    ``rate`` percent of the texts are cut, ``spm_rate`` percent of those put the suffix first. A text that is
    empty or holds a marker stays plain, with null lengths.
    """
    h1, h2, h3, h4 = (F.col(f"h{i}") for i in range(1, 5))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(marker))
    index = F.col("rank_index")
    drawn = indexed.select(
        "*", (F.size(index["residuals"]) - 1).cast("long").alias("n"), *(h.alias(f"h{i + 1}") for i, h in enumerate(draws(seed)))
    ).withColumn(
        "form", F.when((F.col("text") == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    )
    cuts = drawn.withColumns({
        "a": offset_at(index, F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))),
        "b": offset_at(index, F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))),
    })
    a, b = F.col("a").cast("int"), F.col("b").cast("int")
    prefix = F.substring("text", F.lit(1), a)
    middle = F.substring("text", a + 1, b - a)
    suffix = F.substring("text", b + 1, F.length("text"))
    plain = F.col("form") == "plain"
    output = (
        F.when(plain, F.col("text"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return cuts.select(
        "doc_id", "n", "form", F.when(~plain, F.col("a")).alias("prefix_chars"), F.when(~plain, F.col("b") - F.col("a")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text before the rearrangement, from the output and its form alone.

    No marker begins with its own end, so none can arise where a part meets a marker.
    """
    first, second = F.when(form == "psm", F.lit(PREFIX)).otherwise(F.lit(SUFFIX)), F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    after = F.substring(output, F.length(first) + 1, F.length(output))
    head = F.call_function("substring_index", after, second, F.lit(1))
    rest = F.substring(after, F.length(head) + F.length(second) + 1, F.length(after))
    tail = F.call_function("substring_index", rest, F.lit(MIDDLE), F.lit(1))
    middle = F.substring(rest, F.length(tail) + len(MIDDLE) + 1, F.length(rest))
    whole = F.when(form == "psm", F.concat(head, middle, tail)).otherwise(F.concat(tail, middle, head))
    return F.when(form == "plain", output).otherwise(whole)


def fill_middle(
    df: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output, restored`` for every row, rows that repeat too.

    Null texts count as empty: no units, plain. A text of one very long line has one unit. A null id draws as
    an empty text. No rows in, no rows out; other columns are left out.
    """
    cut = rearranged(with_rank_index(df, id_column, text_column), seed, rate, spm_rate)
    return cut.withColumn("restored", restored(F.col("output"), F.col("form")))
