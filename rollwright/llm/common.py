"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Where the given tables' public tokenizer files lie. Callers may hand in any other path.
BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    """Place of an installed public vocabulary file; each worker has the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else; null stays null."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keyed_texts(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The two columns an operator needs, as ``doc_id`` and ``text``: other columns cannot clash."""
    return df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in small pieces: what Python holds of a batch at once stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
