r"""Spelling variants by asymmetric q-chunks: words that differ by one edit, and the form to use.

Words: maximal runs of letters (``A-Z a-z`` and U+00C0 to U+00FF) of whole texts, A-Z lower-cased; of
the runs whose ``crc32("<doc_id>:<run>")`` is divisible by 199, one code point is deleted. Words of at
least 6 code points and 5 occurrences are compared.

Join. The shorter word of a pair (of equal lengths the smaller) contributes two disjoint chunks,
``x[:q]`` and ``x[q:]`` with q half its length L. The other word contributes its positional grams of
those lengths, for L its own length or one less; grams at positions that no chunk within shift one can
have are not made. One edit leaves a chunk whole, at its place or shifted by the difference in length,
so the pair meets in an equi-join on (L, difference, chunk) and Levenshtein distance 1 is verified. A
pair that shares both chunks counts at the first place only, so no distinct step is needed.

Hot chunks. A chunk tells a range [a, b] of places for the edit; where a chunk joins more than
``HOT_PAIRS`` pairs, its words are not joined but cut again: the range is halved and the key becomes all
of the word outside the half. This goes on until no key is hot or the range is one place, where
all words of a key are true neighbours (no more than the alphabet has letters). So no group emits pairs
that are not links, and none is dropped.

``root`` follows ``form`` to the last by pointer doubling; counts rise fivefold at every step, so there
are no cycles and few rounds.

Defined cases: null texts hold no words; a null id is written as an empty text in the crc; repeated rows
and ties count as they are; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.plans.prefix import materialize

MIN_LENGTH, MIN_COUNT, FORM_RATIO = 6, 5, 5
SLIP_EVERY = 199
HOT_PAIRS = 4096
RUN = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words with ``min_length`` code points and ``min_count`` occurrences."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(F.col(text_col), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run"))
    runs = runs.select("id", lower.alias("run"))
    h = F.crc32(F.encode(F.concat_ws(":", "id", "run"), "UTF-8"))
    at = (h % F.length("run")).cast("int")
    slipped = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return (runs.select(F.when(h % SLIP_EVERY == 0, slipped).otherwise(F.col("run")).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") >= min_count) & (F.length("word") >= min_length)))


def _sub(word: Column, start: Column, end: Column) -> Column:
    return F.substr(word, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))


def _key(first: bool) -> Column:
    """The words' shared part for an edit at a place in [a, b]: all before a, all after b.

    At the first cut the range starts or ends with the word and the key is one chunk. Later ranges
    leave the inserted letter alone in a range of one place: the tail of x begins at b, not b + 1.
    """
    w, n = F.col("word"), F.length("word")
    # the word of L letters has its tail at b + 1 (or b + 1 - d), the other d places further
    tail = F.col("b") + 1 - (F.lit(0) if first else F.col("d")) + F.when(
        F.col("gram"), F.col("d")).otherwise(F.lit(0))
    return F.xxhash64(F.col("L"), F.col("d"), F.col("a"), F.col("b"),
                      _sub(w, F.lit(0), F.col("a")), _sub(w, tail, n))


def _chunks(words: DataFrame) -> DataFrame:
    """Both roles of every word: its own chunks (gram false) and its positional grams (gram true)."""
    n = F.length("word")
    roles = words.select("word", "n", F.explode(F.array(*[
        F.struct(F.lit(gram).alias("gram"), F.lit(d).alias("d"), (n - (d if gram else 0)).alias("L"))
        for gram in (False, True) for d in (0, 1)])).alias("r")).select("word", "n", "r.*")
    # places of the edit: 0..L-1 when a letter is replaced, 0..L when one is inserted
    q, end = F.floor(F.col("L") / 2), F.col("L") - 1 + F.col("d")
    return roles.withColumn("range", F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("a"), (q - 1).alias("b")),
        F.struct(q.alias("a"), end.cast("bigint").alias("b"))))).select(
        "word", "n", "gram", "d", "L", "range.a", "range.b").withColumn("key", _key(True))


def _halves(entries: DataFrame) -> DataFrame:
    m = F.floor((F.col("a") + F.col("b")) / 2)
    halves = F.explode(F.array(F.struct(F.col("a").alias("a"), m.alias("b")),
                               F.struct((m + 1).alias("a"), F.col("b").alias("b"))))
    return entries.withColumn("range", halves).select(
        "word", "n", "gram", "d", "L", "range.a", "range.b").withColumn("key", _key(False))


def _meet(entries: DataFrame) -> DataFrame:
    """Verified pairs (x, nx, y, ny) of the entries of a key."""
    x = entries.where("not gram").select("key", F.col("word").alias("x"), F.col("n").alias("nx"),
                                         "d", "L", "b")
    y = entries.where("gram").select("key", F.col("word").alias("y"), F.col("n").alias("ny"))
    # the first place at which the words differ lies in the range: else another range has the pair
    first_place = (F.col("b") >= F.col("L") - 1 + F.col("d")) | (
        F.substr("x", F.lit(1), (F.col("b") + 1).cast("int"))
        != F.substr("y", F.lit(1), (F.col("b") + 1).cast("int")))
    return (x.join(y, "key").where((F.length("y") == F.length("x") + F.col("d"))
                                   & ((F.col("d") == 1) | (F.col("x") < F.col("y"))))
            .where((F.levenshtein("x", "y", 1) == 1) & first_place).select("x", "nx", "y", "ny"))


def near_pairs(words: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Every pair of ``words`` (word, n) that one edit apart: (x, nx, y, ny), each pair once."""
    entries, found = _chunks(words), None
    while True:
        hot = materialize(
            entries.groupBy("key").agg(F.count_if("gram").alias("g"), F.count_if(~F.col("gram")).alias("c"),
                                       F.max(F.col("b") - F.col("a")).alias("width"))
            .where((F.col("g") * F.col("c") > hot_pairs) & (F.col("width") > 0)).select("key"), "hot_chunks")
        any_hot = not hot.isEmpty()
        pairs = _meet(entries.join(hot, "key", "left_anti") if any_hot else entries)
        pairs = materialize(pairs, "near_words")
        found = pairs if found is None else found.unionByName(pairs)
        if not any_hot:
            return found
        entries = materialize(_halves(entries.join(hot, "key", "left_semi")), "chunk_halves")


def spelling_groups(words: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n)."""
    words = materialize(words.select("word", "n"), "words")
    pairs = near_pairs(words, hot_pairs)
    both = pairs.select(F.col("x").alias("word"), F.col("nx").alias("n"), F.col("y").alias("other"),
                        F.col("ny").alias("m")).unionByName(
        pairs.select(F.col("y").alias("word"), F.col("ny").alias("n"), F.col("x").alias("other"),
                     F.col("nx").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(
        F.struct((-F.col("m")).alias("neg"), F.col("other").alias("other"))).alias("best"))
    m = -F.col("best.neg")
    forms = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(m >= FORM_RATIO * F.col("n"), F.col("best.other")).alias("form"),
        F.when(m >= FORM_RATIO * F.col("n"), m).alias("form_n"))
    forms = materialize(forms, "forms")
    step = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # pointer doubling over the words that have a form
        up = step.select(F.col("word").alias("root"), F.col("root").alias("up"))
        longer = materialize(step.join(up, "root", "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "roots")
        step = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    return forms.join(step, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), F.col("n").cast("bigint").alias("n"),
        "n_near", F.col("form_n").cast("bigint").alias("form_n"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: every frequent word with its near words, form and root."""
    return spelling_groups(count_words(spark.read.parquet(f"{sf_dir}/documents.parquet")))
