"""Sinks: training examples per split, run-log CSV, text samples."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tokenmill.operators.runlog import append_run_log, read_run_log  # noqa: F401  (A6)


def write_examples(df: DataFrame, path: str, split: str = "split", batch: str | None = "batch_id",
                   mode: str = "overwrite", fmt: str = "parquet") -> None:
    """A5: examples partitioned by split (one folder each), clustered by batch inside files.

    No repartition to a single file: every task writes its own files, and a reader
    prunes splits by folder.
    """
    w = df.sortWithinPartitions(batch) if batch and batch in df.columns else df
    w.write.mode(mode).partitionBy(split).format(fmt).save(path)


def append_samples(df: DataFrame, path: str, first: bool = False) -> None:
    """Text samples (peeks) as JSON lines: ``first`` truncates the log, later calls append."""
    df.write.mode("overwrite" if first else "append").json(path)
