"""Readers for the driver tables and the corpora the operators consume."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet: column pruning and filter pushdown reach the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_corpus(spark: SparkSession, path: str, split: str | None = None,
                fmt: str = "parquet", text_col: str = "text") -> DataFrame:
    """A1: a named split of a text corpus; ``split`` becomes a column.

    ``fmt='text'`` reads one row per line (``value`` renamed to ``text``).
    """
    if fmt == "text":
        df = spark.read.text(path).withColumnRenamed("value", text_col)
    else:
        df = spark.read.format(fmt).load(path)
    return df.withColumn("split", F.lit(split)) if split is not None else df


def read_splits(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Several named splits stacked with a ``split`` column."""
    frames = [read_corpus(spark, p, s, fmt) for s, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """A2: every file as one document (path, text)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("path"), F.col("value").alias("text")))


MESSAGES = "array<struct<role:string,content:string>>"


def read_conversations(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A3: chat data with a nested ``messages`` column (or the flat turn table)."""
    return spark.read.format(fmt).load(path)


def read_preferences(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A4: preference pairs with nested ``chosen`` / ``rejected`` message lists."""
    return spark.read.format(fmt).load(path)


def eval_set(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A fixed evaluation set (prompts or prompt/chosen/rejected triples).

    Tiny by construction; join it with ``F.broadcast``.
    """
    return spark.createDataFrame(list(rows), schema)
