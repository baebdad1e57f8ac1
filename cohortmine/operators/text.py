"""Text volume (A9; H8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_text_length(df: DataFrame, col: str = "value", split_lines: bool = False) -> DataFrame:
    """H8: one row ``(total_len, n_lines)``: summed character length of all lines.

    With ``split_lines`` every value is a multi-line text split on ``\\n``: a text
    with j newlines is j+1 lines whose lengths add up to its length minus j. This is
    computed per row over the whole text (no explode), then summed with a partial
    aggregation. Newlines are counted as the byte-length drop after removing them (a
    newline is one byte in UTF-8), which avoids decoding the text twice.
    """
    c = F.col(col)
    if split_lines:
        newlines = F.octet_length(c) - F.octet_length(F.replace(c, F.lit("\n"), F.lit("")))
        lengths, lines = F.length(c) - newlines, newlines + 1
    else:
        lengths, lines = F.length(c), F.lit(1)
    present = c.isNotNull()
    return df.agg(
        F.coalesce(F.sum(F.when(present, lengths)), F.lit(0)).cast("long").alias("total_len"),
        F.coalesce(F.sum(F.when(present, lines)), F.lit(0)).cast("long").alias("n_lines"))
