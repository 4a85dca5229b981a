"""Benchmark decontamination by spaced seeds, in DataFrame expressions only.

A fixed mask reads 6 of 9 consecutive tokens and ignores the rest, so a substituted word at an
ignored place does not hide a copied passage; three masks with different holes are used. Masked
hashes of every position of every document meet those of the benchmark in an equi-join. A hit
fixes an alignment; around it (16 tokens to either side of the mask) the aligned tokens are
compared, and the passage counts when at least 13 of them are equal, or 70% of a shorter item.

Tokens are runs of letters and digits of the lower-cased text. Benchmark items of fewer than 9
tokens are searched by a hash of all their tokens. The benchmark is two tables: its seeds, as numbers
only, and the tokens of each item, once. Both are broadcast only while their estimated size is below
``MAX_BROADCAST_BYTES``; it grows with the number of benchmark tokens, not with the square of an item's.
Texts are cut into parts of ``PART`` positions, each with the tokens that a comparison can reach, and
a hit takes the compared tokens only: what a task holds for the hits of a part is bounded by their number,
not by the text's length times their number. Beyond the broadcast size the same joins shuffle, and of the documents' seeds only those that a bit table of the
benchmark's seeds (one number of ``MAX_MARK_BITS`` bits at most, no seed of the benchmark is missing) lets pass.

Defined cases: null texts and texts without tokens match nothing; null ids are carried as they
are; repeated rows give one result row; benchmark rows that share an id (or have none) are compared
text by text, each against its own length; an empty benchmark gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASKS = ((0, 1, 3, 4, 7, 8), (0, 2, 3, 5, 6, 8), (0, 1, 2, 4, 6, 8))
SPAN = 9
REACH = 16
PART = 1024  # positions of a text in one row
MIN_EQUAL, MIN_SHARE = 13, 0.7
MAX_BROADCAST_BYTES = 64 << 20
SEED_BYTES = 64  # of a seed in a broadcast hash table
MAX_MARK_BITS = 1 << 26


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _token_hashes(df: DataFrame, text_col: str, *keys: Column) -> DataFrame:
    return df.select(*keys, F.transform(tokens(F.col(text_col)), lambda t: F.xxhash64(t)).alias("th"))


def _parts(df: DataFrame) -> DataFrame:
    """Each text as rows of ``PART`` positions: th with up to ``REACH`` tokens before its positions and
    ``SPAN + REACH`` behind, so that hits are found and compared as in the whole text; from: its first."""
    from_ = F.col("part") * PART
    before = F.least(from_, F.lit(REACH))
    return df.withColumn("part", F.explode(F.when(F.size("th") > 0, F.sequence(
        F.lit(0), F.floor((F.size("th") - 1) / PART).cast("int"))))).withColumns({
            "th": F.slice("th", from_ - before + 1, before + (PART + SPAN + REACH)), "from": before})


def _seeds(df: DataFrame, lengths: list[int], part: bool = False) -> DataFrame:
    """One row for each position and mask: the columns of ``df`` (rows of :func:`_parts` if ``part``), p, seed."""
    n = F.size("th")
    least = min([SPAN, *lengths])
    first, last = F.lit(0), n - least
    if part:
        first, last = F.col("from"), F.least(last, F.col("from") + (PART - 1))
    at = df.withColumn("p", F.explode(F.when(last >= first, F.sequence(first, last))))

    def seed(which: int, offsets, span: int) -> Column:
        h = F.xxhash64(F.lit(which), *[F.get("th", F.col("p") + o) for o in offsets])
        return h if span == least else F.when(F.col("p") + span <= n, h)

    keys = [seed(i, m, SPAN) for i, m in enumerate(MASKS)]
    keys += [seed(100 + x, range(x), x) for x in lengths]
    out = at.withColumn("seed", F.explode(F.array(*keys)))
    return out if least == SPAN else out.where("seed is not null")


def _marked(df: DataFrame, seeds: DataFrame, n_seeds: int) -> DataFrame:
    """The rows of ``df`` whose seed may be one of ``seeds``: a bit table of these, as one scalar."""
    bits = min(MAX_MARK_BITS, max(1 << 12, 1 << (8 * n_seeds).bit_length()))
    at = F.col("seed").bitwiseAND(F.lit(bits - 1))
    word, bit = F.shiftright(at, 6), F.expr(f"shiftleft(1L, cast(seed & {bits - 1} & 63 AS int))")
    words = seeds.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("set"))
    table = (df.sparkSession.range(bits >> 6).withColumnRenamed("id", "word").join(words, "word", "left")
             .agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("set", F.lit(0)).alias("set"))))
                  .alias("t")).select(F.col("t.set").alias("t")))
    found = F.get(table.scalar(), word.cast("int")).bitwiseAND(bit)
    return df.where(found != 0)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """(id, text_key, item, matched): the most equal aligned tokens around any hit."""
    # a benchmark row's own key: ids may be null or repeated, equal keys hold equal tokens
    items = _token_hashes(benchmark, item_text_col, F.col(item_col).alias("item")
                          ).where(F.size("th") > 0).withColumn("item_key", F.xxhash64("item", "th"))
    size = items.agg(F.count(F.lit(1)).alias("items"), F.sum(F.size("th")).alias("n")).first()
    n = size["n"] or 0
    lengths = [r["n"] for r in items.where(F.size("th") < SPAN)
               .select(F.size("th").alias("n")).distinct().orderBy("n").collect()]  # below 9
    seeds = _seeds(items, lengths).select("seed", "item_key", F.col("p").alias("q"))
    whole = items.select("item_key", "item", F.col("th").alias("bh")).dropDuplicates(["item_key"])
    src = _parts(_token_hashes(docs, text_col, F.col(id_col).alias("id"),
                               F.xxhash64(F.col(text_col)).alias("text_key")))
    at = _seeds(src, lengths, part=True)
    n_seeds = n * (len(MASKS) + len(lengths))
    if n_seeds * SEED_BYTES + 8 * n + SEED_BYTES * size["items"] <= MAX_BROADCAST_BYTES:
        hits = at.join(F.broadcast(seeds), "seed").join(F.broadcast(whole), "item_key")
    else:  # shuffle seeds without their texts, then fetch the texts of the hits
        # merge hints: by the size of its file Spark takes the benchmark for small
        hits = (_marked(at.select("id", "text_key", "part", "p", "seed"), seeds, n_seeds)
                .join(seeds.hint("merge"), "seed").join(whole.hint("merge"), "item_key"))
        again = src.select(F.col("id").alias("__id"), F.col("text_key").alias("__key"),
                           F.col("part").alias("__part"), "th")
        hits = hits.join(again, hits["id"].eqNullSafe(again["__id"]) & (
            hits["text_key"] == again["__key"]) & (hits["part"] == again["__part"]))
    # aligned stretches around the hit: item positions lo..hi-1, the document shifted by p - q
    shift = F.col("p") - F.col("q")
    lo = F.greatest(F.col("q") - REACH, F.lit(0), -shift)
    hi = F.least(F.col("q") + (SPAN + REACH), F.size("bh"), F.size("th") - shift)
    needed = F.least(F.lit(MIN_EQUAL), F.ceil(F.size("bh") * MIN_SHARE))
    # the tokens to compare are cut in the join's generated code, which keeps the hits of an input row
    # until it is done with the row: with the whole part each, they would be held as often as it has hits.
    # The comparison (lambdas, not generated) and the test stand above, as they would keep the join from
    # running in generated code; the two reads of "a" keep the projections apart
    cut = hits.select("id", "text_key", "item", "item_key", needed.alias("needed"),
                      F.slice("th", lo + shift + 1, hi - lo).alias("a"),
                      F.slice("bh", lo + 1, hi - lo).alias("b"))
    unequal = F.zip_with("a", "b", lambda a, b: (a != b).cast("int"))
    matched = F.size("a") - F.aggregate(unequal, F.lit(0), lambda a, b: a + b)
    return (cut.select("id", "text_key", "item", "item_key", matched.alias("matched"), "needed")
            .groupBy("id", "text_key", "item", "item_key")
            .agg(F.max("matched").alias("matched"), F.first("needed").alias("needed"))
            .where("matched >= needed")
            .groupBy("id", "text_key", "item").agg(F.max("matched").alias("matched")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the documents that hold a passage of the benchmark."""
    bad = find_overlaps(docs, benchmark, id_col, text_col, **kw).select(
        F.col("id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__id"])
                     & (F.xxhash64(docs[text_col]) == bad["__key"]), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: (doc_id, item_id, matched) of every benchmark passage found in a document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_overlaps(docs, bench).groupBy(F.col("id").alias("doc_id"),
                                              F.col("item").alias("item_id")).agg(
        F.max("matched").cast("long").alias("matched"))


def _sql() -> str:
    def toks(table, key):
        return (f"SELECT {key} AS k, list_filter(regexp_split_to_array(lower(text), "
                f"'[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t FROM {table}")

    def seeds(table, name):
        parts = []
        for i, m in enumerate(MASKS):
            key = " || ' ' || ".join(f"t[p + {o + 1}]" for o in m)
            parts.append(f"SELECT k, t, p, '{i} ' || {key} AS seed FROM {table} "
                         f"WHERE p + {SPAN} <= len(t)")
        short = f"SELECT k, t, p, 's' || n || ' ' || array_to_string(t[p + 1:p + n], ' ') AS seed " \
                f"FROM {table}, (SELECT DISTINCT len(t) AS n FROM bt WHERE len(t) BETWEEN 1 AND " \
                f"{SPAN - 1}) WHERE p + n <= len(t)"
        return f"{name} AS (" + " UNION ALL ".join([*parts, short]) + ")"

    return f"""
WITH dt AS ({toks("documents", "doc_id")}), bt AS ({toks("benchmark", "item_id")}),
dp AS (SELECT k, t, unnest(range(len(t))) AS p FROM dt),
bp AS (SELECT k, t, unnest(range(len(t))) AS p FROM bt),
{seeds("dp", "ds")}, {seeds("bp", "bs")},
hit AS (
  SELECT ds.k AS doc_id, bs.k AS item_id, ds.t AS a, bs.t AS b, ds.p - bs.p AS shift,
         greatest(bs.p - {REACH}, 0, bs.p - ds.p) AS lo,
         least(bs.p + {SPAN + REACH}, len(bs.t), len(ds.t) - ds.p + bs.p) AS hi
  FROM ds JOIN bs USING (seed)),
m AS (
  SELECT doc_id, item_id, len(b) AS n,
         len(list_filter(range(lo, hi), lambda i: a[i + shift + 1] = b[i + 1])) AS matched
  FROM hit)
SELECT doc_id, item_id, max(matched) AS matched FROM m
WHERE matched >= least({MIN_EQUAL}, ceil(n * {MIN_SHARE}))
GROUP BY doc_id, item_id
"""


SQL = _sql()
