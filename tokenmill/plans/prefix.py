"""Global row rank and running sums without a single-partition window.

A window with ``orderBy`` and no ``partitionBy`` pulls every row into one task. Instead:

1. range-partition on the full order key (Spark samples the key, so a hot leading
   column is still split on the later columns) and sort inside each partition;
2. stamp each row with its partition id and in-partition position, and checkpoint
   that so the numbering is fixed even if executors are lost and tasks re-run;
3. reduce to one row per partition (counts / sums), prefix-sum that small table,
   and broadcast-join it back. Its size is bounded by the partition count.

The order key must be total (unique), or ranks between equal keys are arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.session import ensure_checkpoint_dir

_PID = "__pid"
_MID = "__mid"
_BASE = "__base"
_BASE_SUM = "__base_sum"

# Upper bound on the per-partition table we broadcast.
MAX_RANGE_PARTITIONS = 100_000
# The (partition, group) carry table of grouped running sums is broadcast up to this size.
MAX_BROADCAST_CARRY = 1_000_000


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _num_partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not 1 <= partitions <= MAX_RANGE_PARTITIONS:
        raise ValueError(f"partitions must be in [1, {MAX_RANGE_PARTITIONS}]")
    return partitions


def stage_in_order(df: DataFrame, order: Sequence[str | Column],
                   partitions: int | None = None) -> DataFrame:
    """Range-partition, sort, stamp (partition id, position), checkpoint.

    Without an explicit ``partitions`` the range exchange uses the session's shuffle
    partitions and AQE may coalesce them; coalescing merges adjacent ranges in order,
    so partition ids stay monotone in the order key.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if partitions is None:
        _num_partitions(df, None)
        ranged = df.repartitionByRange(*_cols(order))
    else:
        ranged = df.repartitionByRange(_num_partitions(df, partitions), *_cols(order))
    staged = (
        ranged
        .sortWithinPartitions(*_cols(order))
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id())
    )
    return staged.checkpoint(eager=True)


def _position_in_partition() -> Column:
    return F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)


def global_rank(df: DataFrame, order: Sequence[str | Column], out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` (like row_number())."""
    staged = stage_in_order(df, order, partitions)
    counts = staged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    # One row per range partition: a single-task window here is fine.
    base = counts.select(
        _PID, (F.sum("__n").over(Window.orderBy(_PID)) - F.col("__n")).alias(_BASE))
    return (
        staged.join(F.broadcast(base), _PID)
        .withColumn(out, F.col(_BASE) + _position_in_partition() + F.lit(1))
        .drop(_PID, _MID, _BASE)
    )


def global_offsets(df: DataFrame, order: Sequence[str | Column], size: str,
                   out: str = "offset", rank_out: str | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``size`` over all rows strictly before this one in ``order``.

    Optionally also ``rank_out`` (1-based row position). Run it on a narrow table
    (keys + size); join the result back to wide rows.
    """
    staged = stage_in_order(df, order, partitions)
    per_part = staged.groupBy(_PID).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(size).alias("__s"))
    w = Window.orderBy(_PID)
    base = per_part.select(
        _PID,
        (F.sum("__n").over(w) - F.col("__n")).alias(_BASE),
        (F.sum("__s").over(w) - F.col("__s")).alias(_BASE_SUM),
    )
    # Running sum inside each range partition (balanced by construction).
    local = Window.partitionBy(_PID).orderBy(_MID).rowsBetween(Window.unboundedPreceding, -1)
    res = (
        staged.withColumn("__before", F.coalesce(F.sum(size).over(local), F.lit(0)))
        .join(F.broadcast(base), _PID)
        .withColumn(out, (F.col(_BASE_SUM) + F.col("__before")).cast("long"))
    )
    if rank_out:
        res = res.withColumn(rank_out, F.col(_BASE) + _position_in_partition() + F.lit(1))
    return res.drop(_PID, _MID, _BASE, _BASE_SUM, "__before")


def total(df: DataFrame, size: str | None = None) -> int:
    """A single scalar to the driver: row count or sum of ``size``."""
    if size is None:
        return int(df.count())
    v = df.agg(F.sum(size)).first()[0]
    return int(v or 0)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of re-running the whole
    plan) and lets later jobs prune columns: e.g. offsets read only the token counts of a
    tokenized corpus, never the token arrays.
    """
    import uuid
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.parquet(path)


_WRITTEN: list[str] = []  # tables that materialize() wrote and nobody has released


def release_tables(spark) -> int:
    """Delete the tables that :func:`materialize` has written so far and return their number.

    Results are lazy, so call this once the results built on them are written or collected.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(hadoop).delete(path, True))
    return n


def grouped_offsets(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                    size: str, out: str = "offset") -> DataFrame:
    """Add ``out`` = sum of ``size`` over the rows of the same group strictly before this
    one in ``order`` (a per-group running sum) without putting a group in one task.

    Rows are range-partitioned on (group, order), so a hot group spans several
    partitions. Inside each partition the running sum is a window over (partition,
    group); the carry-in of a group into a partition comes from a table with one row per
    (partition, group), whose window per group holds at most one row per partition.
    """
    g = list(group)
    staged = stage_in_order(df, [*g, *order])
    local = Window.partitionBy(_PID, *g).orderBy(_MID).rowsBetween(Window.unboundedPreceding, -1)
    per = staged.groupBy(_PID, *g).agg(F.sum(size).alias("__s"))
    carry = per.select(
        _PID, *g,
        F.coalesce(F.sum("__s").over(Window.partitionBy(*g).orderBy(_PID).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("__carry"))
    # one row per (partition, group): broadcast it when a count shows it is small
    side = F.broadcast(carry) if per.count() <= MAX_BROADCAST_CARRY else carry
    return (staged.withColumn("__before", F.coalesce(F.sum(size).over(local), F.lit(0)))
            .join(side, [_PID, *g])
            .withColumn(out, F.col("__carry") + F.col("__before"))
            .drop(_PID, _MID, "__carry", "__before"))
