"""Row and model keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: stored model keys start with it.
MODEL_KEY_PREFIX = "isolation_forest"


def model_key(start: Column, end: Column) -> Column:
    """Key of the model trained on a range: ISO-like text without characters a path dislikes."""

    def safe(text: Column) -> Column:
        return F.translate(text, " :", "T-")

    return F.concat_ws("_", F.lit(MODEL_KEY_PREFIX), safe(start), F.lit("to"), safe(end))


def row_id(*columns: str | Column) -> Column:
    """Surrogate key from what identifies a row. A hash, so a retried task gives the same key."""
    return F.xxhash64(*columns)


def with_file_row_id(df: DataFrame) -> DataFrame:
    """Key every row of a parquet scan by its file and position, so exact copies get different keys."""
    return df.withColumn("row_id", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
