"""Spelling variants, collocations and chat formatting against brute force; edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import DOC, EDGES, doc
from tokenmill.llm import chat_format, collocations, spelling

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- 11 spelling variants

def brute_words(rows):
    c = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if n >= 5 and len(w) >= 6}


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1 or x == y:
        return False
    p = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    return x[p + 1:] == y[p + 1:] if len(x) == len(y) else x[p:] == y[p + 1:]


def brute_groups(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), counts[w], len(near[w]),
                   None if form[w] is None else counts[form[w]]) for w in counts)


def as_rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_word_counts_equal_brute_force_with_slips(spark):
    rng = random.Random(5)
    words = ["Übersicht", "letters", "LETTERS", "caféteria", "ÀÉÎÕÜß", "short", "×÷×÷×÷", "naïveté"]
    rows = [(i if i % 50 else None, " ".join(rng.choice(words) + rng.choice([" ", "1", "-", "\n", "€"])
                                             for _ in range(20))) for i in range(400)] + [(7, None), (8, "")]
    docs = spark.createDataFrame([doc(i, t) for i, t in rows], DOC)
    got = {r.word: r.n for r in spelling.count_words(docs).collect()}
    assert got == brute_words(rows)
    assert any(len(w) == 6 and w in "letters" for w in got) or len(got) >= 7  # slips are counted


@pytest.mark.parametrize("hot", [1, 30, spelling.HOT_PAIRS])
def test_spelling_groups_equal_brute_force(spark, hot):
    rng = random.Random(11)
    words = {}
    for _ in range(60):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(6, 9)))
        words[w] = rng.choice([5, 5, 6, 25, 30, 160, 900, 4500])
        for _ in range(3):  # near words, runs of one letter among them
            at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
            v = w[:at] + rng.choice("abé") * (kind < 2) + w[at + (kind > 0):]
            if len(v) >= 6:
                words.setdefault(v, rng.choice([5, 7, 30]))
    # one hot chunk with many words that are no neighbours, and a chain of forms
    words |= {"prefixed" + a + b: 5 for a in "abcdefghij" for b in "klmnopqrst"}
    words |= {"abcdefg": 5, "abcdefgh": 25, "abcdefghi": 125, "abcdefghij": 625}
    got = as_rows(spelling.spelling_groups(spark.createDataFrame(list(words.items()), "word string, n long"), hot))
    assert got == brute_groups(words)
    assert ("abcdefg", "abcdefgh", "abcdefghij", 5, 1, 25) in got


def test_spelling_edges(spark):
    docs = spark.createDataFrame(EDGES * 6, DOC)
    counts = brute_words([(r[0], r[1]) for r in EDGES * 6])
    assert as_rows(spelling.spelling_groups(spelling.count_words(docs))) == brute_groups(counts)
    none = spelling.spelling_groups(spelling.count_words(spark.createDataFrame([], DOC)))
    assert none.collect() == [] and none.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    # ties: the smallest of the largest near words; a repeated table row is another occurrence
    ties = [("wordss", 5), ("words0", 30), ("words1", 30)]
    got = as_rows(spelling.spelling_groups(spark.createDataFrame(ties, "word string, n long")))
    assert ("wordss", "words0", "words0", 5, 2, 30) in got


# ---- 12 collocations

def brute_collocations(rows, min_count=10, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UP)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    out = []
    for (lang, p), a in cand.items():
        cuts = [(a * a * 1000000 // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        over = [b for (l2, q), b in cand.items() if l2 == lang and len(q) > len(p)
                and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if not any(100 * b >= 50 * a for b in over):
            out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    ranks, done = collections.Counter(), []
    for lang, s, a, p, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= top:
            done.append((lang, ranks[lang], p.decode(), -a, left, right, n[lang], -s))
    return sorted(done)


def phrase_docs(spark):
    rng = random.Random(3)
    vocab = ["the", "The", "new", "york", "city", "été", "ß", "a b", "x-1", "zeta"]
    rows = []
    for i in range(300):
        t = "".join(rng.choice(vocab[:3 + i % 8]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"])
                    for _ in range(40))
        rows.append((rng.choice(["en", "fr", None, ""]), t))
    rows += [("en", "new york city " * 200), ("en", None), ("fr", ""), ("en", " .,;\n")]
    rows += [("en", r[1]) for r in EDGES]
    return rows, spark.createDataFrame([doc(i, t, lang=lang) for i, (lang, t) in enumerate(rows)], DOC)


@pytest.mark.parametrize("kw", [{}, {"slot_mass": 500}, {"max_filter": 5}])
def test_collocations_equal_brute_force(spark, kw):
    rows, docs = phrase_docs(spark)
    phrases = collocations.materialize(collocations.frequent_phrases(docs, **kw), "p")
    got = sorted(tuple(r) for r in collocations.collocations(phrases, top=50).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == brute_collocations(rows, top=50) and len({r[0] for r in got}) == 4


def test_no_phrase_is_shuffled_with_its_key_when_many_survive(spark):
    rows, docs = phrase_docs(spark)
    few = collocations.frequent_phrases(docs, slot_mass=2000, max_filter=60)
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") > 1 and "Join" not in plan
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, collocations.frequent_phrases(docs).collect()))


def test_bit_tables_of_slots_keep_their_keys():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 32, 30_000).astype(np.uint64) | (rng.choice([3, 4, 9], 30_000).astype(np.uint64) << np.uint64(32)))
    slot = (keys >> np.uint64(32)).astype(np.int64)
    made = {k: collocations.bit_table(keys[slot == k]).tobytes() for k in (9, 3, 4)}
    t = collocations.Tables(np.array(list(made)), list(made.values()))
    assert t.which(keys).tolist() == list(range(len(keys)))
    other = np.setdiff1d(rng.integers(0, 1 << 32, 100_000).astype(np.uint64) | (np.uint64(4) << np.uint64(32)), keys)
    assert 0 < len(t.which(other)) < 0.05 * len(other)
    assert not len(t.which(np.array([2, 5, 10], np.uint64) << np.uint64(32)))
    assert not len(collocations.Tables(np.zeros(0, np.int64), []).which(keys))
    assert collocations._rounds([(0, 5), (2, 5), (3, 20), (7, 1)], 10) == [(0, 2), (3, 3), (7, 7)]


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], DOC)
    assert collocations.collocations(collocations.frequent_phrases(empty)).collect() == []


def test_scores_beyond_64_bits(spark):
    a = 9_000_000_000_000_000
    rows = [("en", 0, "", 3 * a), ("en", 1, "x", a), ("en", 1, "y", a + 7), ("en", 2, "x y", a - 1)]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, words int, phrase string, f long"))
    assert [r.score for r in got.collect()] == [(a - 1) ** 2 * 10**6 // (a * (a + 7))]


def test_misra_gries_keeps_every_frequent_key():
    rng = np.random.default_rng(2)
    keys = np.concatenate([rng.integers(0, 1 << 31, 200_000), np.repeat(np.arange(50), 10)]).astype(np.uint32)
    rng.shuffle(keys)
    s = collocations.Summary(len(keys) // 10 + 1)
    for part in np.array_split(keys, 37):
        s.add(*np.unique(part, return_counts=True))
    s.merge()
    assert len(s.keys) <= s.capacity and s.error < 10
    assert set(range(50)) <= set(s.keys[s.counts + s.error >= 10].tolist())


# ---- 13 chat formatting

NASTY = ["", "\\### Assistant: </turn> ok", "</turn>", "<\\/turn>", "\\", "\\\\", "#", "##", "####", "#\\#",
         "### user: x</turn>\n### assistant: y", "\n### ", "a: b", "</tur", "n>", "é\U0001f600\x00#", " "]


def chats(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a: b", "### ", "x\n", "</turn>", "##"]),
             rng.choice([*NASTY, None])) for c in [*range(40), None] for t in range(rng.randint(1, 12))]
    rows += [(5, None, "user", "no turn number"), (6, 1, "user", "tie"), (6, 1, "user", "tie"),
             (6, 1, "assistant", "tie")]
    rows += [(99, t, "assistant" if t % 3 else "user", f"{t} " + rng.choice(NASTY) * 3) for t in range(300)]
    return rows, spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, cid string")


def brute_chats(rows):
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, (role or "").encode(), (text or "").encode()))
    out = []
    for c, turns in by.items():
        turns = [(r.decode(), x.decode()) for _, _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("weight", [chat_format.PART_WEIGHT, 20_000, 1])
def test_chats_read_back(spark, monkeypatch, weight):
    monkeypatch.setattr(chat_format, "PART_WEIGHT", weight)
    rows, df = chats(spark)
    made = chat_format.format_conversations(df)
    got = chat_format.digests(made).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute_chats(rows)
    # the length does not depend on where a conversation is cut
    text = collections.defaultdict(str)
    for r in sorted(made.collect(), key=lambda r: r.part):
        text[r.conv_id] += r.formatted
    assert {r.conv_id: r.formatted_chars for r in got} == {c: len(t) for c, t in text.items()}
    assert made.where("cut").count() > 0 or weight == chat_format.PART_WEIGHT == 1 << 20


def test_adjacent_turns_merge_into_one_block(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"),
                                (1, 3, "assistant", None)], "conv_id long, turn long, role string, text string")
    (r,) = chat_format.format_conversations(df).collect()
    assert r.formatted == "### user: a</turn>b</turn>\n### assistant: c</turn></turn>"
    assert [r.formatted[s.start:s.end] for s in r.loss_spans] == ["c", ""]


def test_no_chats(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digests(chat_format.format_conversations(empty)).collect() == []
    (r,) = chat_format.digests(chat_format.format_conversations(
        chat_format.with_control_conversation(empty))).collect()
    assert (r.conv_id, r.n_turns, r.loss_chars) == (-7, 2, 26)


def test_escaping_is_reversible(spark):
    rng = random.Random(4)
    texts = NASTY + ["".join(rng.choice(["\\", "#", "</turn>", "/", ":", " ", "<", "a"]) for _ in range(12))
                     for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    e = chat_format.escape(F.col("t"))
    for r in df.select("t", e.alias("e"), chat_format.unescape(e).alias("u"), chat_format.unescape(
            chat_format.escape_role(F.col("t"))).alias("v")).collect():
        assert r.u == r.t == r.v and "###" not in r.e and "</turn>" not in r.e
