"""Shared helpers of the training-data operators: reading, word rules, row keys, checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.session import ensure_checkpoint_dir

# The white space that parts words, and what a word is made of.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """All words of a text, in order (array of strings, native)."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder of the session."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than ``rows + 1`` of them."""
    return df.limit(rows + 1).count() <= rows


def semi_or_anti(df: DataFrame, keys: DataFrame, on: list[str], how: str,
                 broadcast_rows: int = 200_000) -> DataFrame:
    """Keep (``left_semi``) or drop (``left_anti``) the rows of ``df`` whose ``on`` is in ``keys``.

    Nulls match nulls. ``keys`` is broadcast when it was counted to have at most
    ``broadcast_rows`` rows, so wide texts stay where they are; beyond that both sides are
    shuffled.
    """
    side = keys.select(*[F.col(c).alias(f"__k_{c}") for c in on]).distinct()
    side = checkpointed(side)
    if small_enough(side, broadcast_rows):
        side = F.broadcast(side)
    cond = None
    for c in on:
        one = F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        cond = one if cond is None else cond & one
    return df.join(side, cond, how)


def discard(table: DataFrame | None) -> None:
    """Empty a table made by :func:`written` that nothing reads any more."""
    if table is None:
        return
    folder = table.inputFiles()[0].rsplit("/", 1)[0] if table.inputFiles() else ""
    if "/table-" in folder:
        table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(folder)


def written(df: DataFrame) -> DataFrame:
    """Cut lineage with a compressed table in the session's shared checkpoint folder."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name as Spark reads it whole, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def own_columns(df: DataFrame, made: list[str] | tuple[str, ...]) -> list[str]:
    """Quoted names of the columns that a result carries: all but those it makes itself.

    Spark resolves names without regard to case, so they are compared in lower case.
    """
    taken = {name.lower() for name in made}
    return [quoted(c) for c in df.columns if c.lower() not in taken]


def shielded(df: DataFrame, made: list[str] | tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns that clash with ``made`` renamed, and the names to give back.

    For stages that hand every column on as it was: see :func:`restored`.
    """
    taken = {name.lower() for name in made}
    hidden = {c: f"__own_{i}" for i, c in enumerate(df.columns) if c.lower() in taken}
    return df.withColumnsRenamed(hidden), hidden


def restored(out: DataFrame, columns: list[str], hidden: dict[str, str]) -> DataFrame:
    """The columns of the input of :func:`shielded`, under their own names and in their order."""
    return out.select(*[F.col(quoted(hidden.get(c, c))).alias(c) for c in columns])
