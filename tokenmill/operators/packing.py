"""Packing (D6): documents laid into rows of a fixed length, none across two rows' bounds.

Documents longer than ``length`` are cut into parts of ``length`` tokens. The parts are packed by best
fit decreasing, planned on the histogram of part lengths alone (at most ``length`` numbers on the
driver): parts of one length are interchangeable, so the plan is a list of runs "these ranks of this
length go to these bins, k to a bin, from this place". Every part then gets its rank within its
length from a range-partitioned running count, finds its run by an equi-join on the length, and the
parts of a bin (at most ``length`` tokens) meet in one shuffle.

Output rows hold the tokens, the segment of every token (1, 2, ... in a row; attention stays within
equal numbers) and its position, which restarts in each document; padding is left to the reader
(``n_tokens`` tells the fill).

Defined cases: null and empty token arrays take no place; null and repeated keys keep all their rows
(``doc_row`` tells them apart); an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.operators.windows import BROADCAST_OFFSET_ROWS, chunk_tokens
from tokenmill.plans.prefix import grouped_offsets, materialize

MAX_LENGTH = 1 << 18  # the plan has a few runs a length; this bounds it to some MB


def plan_packing(histogram: dict[int, int], length: int) -> list[tuple[int, int, int, int, int, int, int]]:
    """Best fit decreasing over (part length -> number of parts).

    Runs (n, rank_lo, rank_hi, per_bin, bin_lo, start, segment): the parts of length n with ranks
    in [rank_lo, rank_hi) go ``per_bin`` to a bin from ``bin_lo`` on, the first at ``start``.
    """
    open_bins: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # space -> (bin, bins, segments)
    spaces: list[int] = []  # the keys of open_bins that hold bins, ascending
    runs, next_bin = [], 0

    def put(space: int, group: tuple[int, int, int]) -> None:
        if space and group[1]:
            if not open_bins[space]:
                insort(spaces, space)
            open_bins[space].append(group)

    for n in sorted(histogram, reverse=True):
        if not 0 < n <= length:
            raise ValueError(f"part of {n} tokens for rows of {length}")
        rank, left = 0, histogram[n]
        while left:
            at = bisect_left(spaces, n)
            if at < len(spaces):  # the fullest bins that still have room
                space = spaces[at]
                first, bins, segments = open_bins[space].pop()
                if not open_bins[space]:
                    spaces.pop(at)
            else:
                space, segments, first = length, 0, next_bin
                bins = -(-left // (length // n))
                next_bin += bins
            per = space // n
            full = min(bins, left // per)
            if full:
                runs.append((n, rank, rank + full * per, per, first, length - space, segments + 1))
                put(space - per * n, (first, full, segments + per))
                rank, left = rank + full * per, left - full * per
            if full < bins and left:  # one bin takes the rest
                runs.append((n, rank, rank + left, left, first + full, length - space, segments + 1))
                put(space - left * n, (first + full, 1, segments + left))
                rank, left, full = rank + left, 0, full + 1
            put(space, (first + full, bins - full, segments))
    return runs


def _with_places(parts: DataFrame, order: Sequence[str], length: int) -> DataFrame:
    """(__part, bin, start, segment) of every part."""
    histogram = {r["n"]: r["c"] for r in parts.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    runs = plan_packing(histogram, length)
    spark = parts.sparkSession
    by_length = defaultdict(list)
    for n, *run in runs:
        by_length[n].append(tuple(run))
    plan = spark.createDataFrame(
        list(by_length.items()), "n long, runs array<struct<lo:long,hi:long,per:long,bin:long,"
        "start:long,segment:long>>")  # at most one row a length
    ranked = grouped_offsets(parts.withColumn("__one", F.lit(1)), ["n"], [*order, "__hash", "doc_row", "part_no"],
                             "__one", out="rank")
    run = F.filter("runs", lambda r: (r["lo"] <= F.col("rank")) & (F.col("rank") < r["hi"]))[0]
    placed = ranked.join(F.broadcast(plan), "n").withColumn("run", run)
    r = F.col("rank") - F.col("run.lo")
    slot = r % F.col("run.per")
    return placed.select("__part", (F.col("run.bin") + F.floor(r / F.col("run.per"))).alias("bin"),
                         (F.col("run.start") + slot * F.col("n")).alias("start"),
                         (F.col("run.segment") + slot).cast("int").alias("segment"))


def pack_documents(df: DataFrame, order: Sequence[str], length: int, tokens: str = "tokens") -> DataFrame:
    """(bin, n_tokens, tokens, segment_ids, positions, documents): packed rows of at most ``length``
    tokens. ``documents`` lists (start, segment, n, doc_row, part_no, doc_pos, and the ``order``
    columns) of the row's parts."""
    if not 1 <= length <= MAX_LENGTH:
        raise ValueError(f"length must be in [1, {MAX_LENGTH}]")
    order = list(order)
    rows = (df.select(*order, F.col(tokens).alias("__tokens")).where(F.size("__tokens") > 0)
            .withColumn("doc_row", F.monotonically_increasing_id())
            .withColumn("__hash", F.xxhash64("__tokens")))
    parts = materialize(chunk_tokens(rows, "__tokens", length).withColumnRenamed("chunk_no", "part_no")
                        .withColumn("__part", F.monotonically_increasing_id()), "parts")  # numbers stay
    narrow = parts.select(*order, "__hash", "doc_row", "part_no", "__part", "n")
    places = materialize(_with_places(narrow, order, length), "places")
    side = F.broadcast(places) if places.count() <= BROADCAST_OFFSET_ROWS else places
    laid = parts.join(side, "__part").withColumn("doc_pos", F.col("part_no").cast("long") * length)
    listed = ["start", "segment", "n", "doc_row", "part_no", "doc_pos", *order]
    bins = laid.groupBy("bin").agg(F.sort_array(F.collect_list(F.struct(*listed, "piece"))).alias("p"))

    def flat(f) -> Column:
        return F.flatten(F.transform("p", f))

    return bins.select(
        "bin", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_tokens"),
        F.flatten("p.piece").alias(tokens),
        flat(lambda x: F.array_repeat(x["segment"], x["n"].cast("int"))).alias("segment_ids"),
        flat(lambda x: F.sequence(x["doc_pos"], x["doc_pos"] + x["n"] - 1)).alias("positions"),
        F.transform("p", lambda x: F.struct(*[x[c].alias(c) for c in listed])).alias("documents"))


def unpack_documents(packed: DataFrame, order: Sequence[str], tokens: str = "tokens") -> DataFrame:
    """The parts read back from packed rows: (order, doc_row, part_no, doc_pos, tokens), each cut
    out where its segment number stands, its position taken from the first token."""
    d = F.col("d")
    inside = packed.select(tokens, "segment_ids", "positions", F.explode("documents").alias("d"))
    start = F.array_position("segment_ids", d["segment"]).cast("int")
    n = F.size(F.filter("segment_ids", lambda s: s == d["segment"]))
    return inside.select(*[d[c].alias(c) for c in order], d["doc_row"].alias("doc_row"),
                         d["part_no"].alias("part_no"), F.get("positions", start - 1).alias("doc_pos"),
                         F.slice(tokens, start, n).alias(tokens))


def packing_report(packed: DataFrame, length: int) -> DataFrame:
    """One row: bins, documents' parts, tokens, empty places and their share of all places."""
    a = packed.agg(F.count(F.lit(1)).alias("n_bins"), F.sum(F.size("documents")).cast("long").alias("n_parts"),
                   F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("fullest"))
    waste = F.col("n_bins") * length - F.col("n_tokens")
    return a.select("n_bins", "n_parts", "n_tokens", "fullest", waste.alias("n_empty"),
                    (waste / (F.col("n_bins") * length)).alias("empty_share"))
