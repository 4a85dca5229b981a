"""License scan: TF-IDF cosine of headers and license files to templates, then inheritance by path.

Headers are the segments of a text (lines and whole paragraphs, cut at sentence ends, and windows of up to
``WINDOW`` lines without a blank one, for headers wrapped anyhow) that hold a license cue. A segment and
every template are sparse vectors of word counts times inverse document frequency, the frequencies
counted over all documents (words outside the templates weigh as unseen words). The template of
largest cosine at or above ``MIN_COSINE`` is the segment's license, ties by name. Near licenses differ in
single words, so a name needs more: the segment has every mark (``MARKS``: words that tell licenses apart,
and version digits) of the template and none that the license lacks, a template without marks is there
almost whole (``HELD``), and the license leads the next allowed one by ``MARGIN``; else the segment names none.
An SPDX tag names its license (or expression) itself, at cosine 1. A document's own
license is that of its best segment. A document at least half of whose words are license segments is
a license file and declares its license for its directory; so is one whose whole text has a cosine of at
least ``FILE_COSINE`` to a full license text of ``license_texts`` and whose title lines hold no mark that this
license lacks; that text's name is its license (with such a mark it is a license unknown here: no name).

A document without a license of its own takes that of the nearest ancestor directory with a license
file: each distinct directory meets its ancestors in an equi-join by path, the deepest wins, and the
result is joined back by directory. Directories, not files, are expanded, and a directory's license
files are reduced to one before the join.

Defined cases: null text is empty; a null path has no directory and inherits nothing; several
license files in a directory: the largest cosine, then the smallest license name; an empty table
gives an empty result; repeated rows count each; extra columns are not read.
"""

from __future__ import annotations

import re
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.llm import textnp as X
from tokenmill.plans.prefix import materialize

MIN_COSINE = 0.6
FILE_SHARE = 0.5
FILE_COSINE = 0.9
WINDOW = 5
HELD, MARGIN = 0.95, 0.02
MAX_DIRS = 200_000  # directories with an inherited license that are broadcast; more are joined by salt
SALTS = 16
CUE = re.compile(rb"licen[sc]e|copyright|permission is hereby|public domain|redistribution and use in source",
                 re.I)
_SEGMENT = re.compile(rb"[^\n]+")
_SENTENCE = re.compile(rb"(?<=[.!?]) +(?=[A-Z])")
_LEADER = re.compile(rb"^[ \t]*(?:[#*;%!]+|//+|--+|/\*+|<!--|\.\.)*[ \t]*")
_SPDX = re.compile(rb"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+:() -]*[A-Za-z0-9.+)])", re.I)

# Words that tell licenses, their families and variants apart; single digits but 0 count too.
MARKS = frozenset(
    b"academic affero afl agpl apache apsl artistic beerware boost bsd bsl by cc0 cddl cecill cpl creative cc "
    b"derivatives ecl eclipse epl eupl fdl general gnu gpl isc lesser lgpl libpng library lppl microsoft mit "
    b"mozilla mpl mulan nc ncsa nd noderivatives noderivs noncommercial odbl ofl opl openssl osl php postgresql "
    b"psf python ruby sa sharealike sil sleepycat unlicense vim w3c wtfpl x11 zlib zope zpl".split())
# what says the same as another mark
_SAME = {b"cc": b"creative", b"gpl": b"gnu"}

# Header statements of well-known licenses (SPDX name, statement).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this "
                   "file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met. Copyright."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 Universal License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU Affero General Public License as published by the Free Software Foundation, either version 3 "
                 "of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the "
                 "GNU Lesser General Public License as published by the Free Software Foundation; either version "
                 "2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 "
                 "of the License, or (at your option) any later version."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
)


def marks(raw: bytes) -> frozenset[bytes]:
    """What tells the license of a statement: its words of ``MARKS`` and its version digits."""
    # "library" and "python" are common words: they count beside "general" and "license" only
    low = raw.lower()
    found = {w for w in re.findall(rb"[a-z0-9]+", low) if w in MARKS or (len(w) == 1 and w in b"123456789")}
    if b"library general" not in low:
        found.discard(b"library")
    if b"cc" not in found and b"creative" not in found:
        found.discard(b"by")
    return frozenset(_SAME.get(w, w) for w in found)


def title(raw: bytes) -> bytes:
    """The first three lines with words that are no copyright line and no more than a title's length."""
    lines = [x for x in raw[:4096].split(b"\n") if re.search(rb"\w", x)]
    return b"\n".join(x for x in lines[:3] if len(x) <= 80 and not re.search(rb"copyright", x, re.I))


def word_hashes(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    return X.words(data, np.array([0, len(data)]), X.ALNUM)[2]


def full_texts() -> list[tuple[str, bytes]]:
    """(name, text) of the full licenses; read on the driver."""
    return [(f.stem, f.read_bytes())
            for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]


def vocabulary(texts: list[tuple[str, bytes]] = ()) -> np.ndarray:
    return np.unique(np.concatenate([word_hashes(t.encode()) for _, t in TEMPLATES]
                                    + [word_hashes(t) for _, t in texts]))


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, dict[int, int]]:
    """(documents, word hash of a template or full text -> documents that hold it), over the whole table."""
    vocab = vocabulary(full_texts())

    def run(batches):
        for rec, data, off in X.blocks(batches, "__text"):
            _, _, h, first = X.words(data, off, X.ALNUM)
            at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
            known = vocab[at] == h
            row = np.repeat(np.arange(rec.num_rows), np.diff(first))[known]
            once = np.unique(row * len(vocab) + at[known]) % len(vocab)
            n = np.bincount(once, minlength=len(vocab))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[np.arange(len(vocab)), -1]), pa.array(np.r_[n, rec.num_rows])],
                names=["at", "n"])

    got = (X.map_arrow(docs.select(F.col(text_col).alias("__text")), run, "at long, n long")
           .groupBy("at").agg(F.sum("n").alias("n")).collect())  # one row a template word
    n = {r["at"]: r["n"] for r in got}
    return n.get(-1, 0), {int(vocab[i]): c for i, c in n.items() if i >= 0}


class Matcher:
    """Cosine of segments to the templates."""

    def __init__(self, n_docs: int, frequency: dict[int, int], texts: list[tuple[str, bytes]] = ()):
        own = set(vocabulary().tolist())
        self.n, self.frequency = n_docs, {w: c for w, c in frequency.items() if w in own}
        self.vocab = np.sort(np.array(list(frequency), np.uint64))
        held = np.array([frequency[int(w)] for w in self.vocab], float)
        self.idf = np.log((n_docs + 1) / (held + 1)) + 1
        self.names = [name for name, _ in texts]
        self.texts = np.array([self.whole_vector(t) for _, t in texts])
        self.templates = [(name, self.vector(t.encode()), marks(t.encode())) for name, t in TEMPLATES]
        self.allowed: dict[str, frozenset[bytes]] = {}
        for name, raw in [*((n, t.encode()) for n, t in TEMPLATES), *((n, title(t)) for n, t in texts)]:
            self.allowed[name] = self.allowed.get(name, marks(name.encode())) | marks(raw)

    def vector(self, raw: bytes) -> dict[int, float]:
        words, count = np.unique(word_hashes(raw), return_counts=True)
        v = {int(w): c * float(np.log((self.n + 1) / (self.frequency.get(int(w), 0) + 1)) + 1)
             for w, c in zip(words, count)}
        norm = sum(x * x for x in v.values()) ** 0.5
        return {w: x / norm for w, x in v.items()} if norm else {}

    def whole_vector(self, raw: bytes) -> np.ndarray:
        """Weights of the vocabulary's words in a whole text, by the norm of all its words."""
        words, count = np.unique(word_hashes(raw), return_counts=True)
        v = np.zeros(len(self.vocab))
        if not len(words) or not len(v):
            return v
        at = np.minimum(np.searchsorted(self.vocab, words), len(v) - 1)
        known = self.vocab[at] == words
        v[at[known]] = count[known] * self.idf[at[known]]
        strange = float((count[~known].astype(float) ** 2).sum()) * (np.log(self.n + 1) + 1) ** 2
        return v / np.sqrt((v * v).sum() + strange)

    def whole(self, raw: bytes) -> tuple[str | None, float] | None:
        """The full license whose text a whole document is; no name for a near relative of one."""
        if not self.names:
            return None
        cosine = self.texts @ self.whole_vector(raw)
        i = int(cosine.argmax())
        if cosine[i] < FILE_COSINE:
            return None
        return None if marks(title(raw)) - self.allowed[self.names[i]] else self.names[i], float(cosine[i])

    def best(self, raw: bytes) -> tuple[str, float] | None:
        """The license that a segment names, and its cosine."""
        v, said = self.vector(raw), marks(raw)
        found: dict[str, float] = {}
        for name, t, own in self.templates:
            cosine = sum(x * v.get(w, 0.0) for w, x in t.items())
            if cosine < MIN_COSINE or own - said or said - self.allowed[name]:
                continue
            if not own and sum(x * x for w, x in t.items() if w in v) < HELD:
                continue
            found[name] = max(cosine, found.get(name, 0.0))
        first = sorted((-c, name) for name, c in found.items())[:2]
        if not first or len(first) == 2 and first[1][0] - first[0][0] < MARGIN:
            return None
        return first[0][1], -first[0][0]


def spdx_name(raw: bytes) -> str | None:
    """The expression of the first SPDX tag, single spaces between its words."""
    m = _SPDX.search(raw)
    return " ".join(m.group(1).decode().split()) if m else None


def license_segments(raw: bytes):
    """(start, segment) of the segments of a text that hold a cue."""
    if not CUE.search(raw):
        return
    for line in _SEGMENT.finditer(raw):
        if CUE.search(line.group()):
            at = line.start()
            for part in _SENTENCE.split(line.group()):
                if CUE.search(part):
                    yield raw.index(part, at), part


def license_windows(raw: bytes):
    """Runs of 2 to ``WINDOW`` lines, none blank, that hold a cue, each joined to one line."""
    lines = [x if re.search(rb"\w", x) else b"" for x in raw.split(b"\n")]
    cued = [bool(CUE.search(x)) for x in lines]
    near = sorted({k for i, c in enumerate(cued) if c for k in range(max(i - WINDOW + 1, 0), i + 1)}
                  | {i - 1 for i in range(1, len(lines)) if CUE.search(lines[i - 1] + b" " + lines[i])})
    for lo in near:
        for hi in range(lo + 2, min(lo + WINDOW, len(lines)) + 1):
            if not all(lines[lo:hi]):
                break
            joined = b" ".join(lines[lo:hi])
            if CUE.search(joined):
                yield joined


def license_paragraphs(raw: bytes):
    """Sentences with a cue of each run of lines without a blank one, joined without comment signs."""
    if not CUE.search(raw):
        return
    for run in re.split(rb"\n[^\w\n]*(?=\n|\Z)", raw):
        if b"\n" in run and CUE.search(re.sub(rb"\s+", b" ", run)):
            joined = b" ".join(_LEADER.sub(b"", x).strip() for x in run.split(b"\n"))
            yield from (part for part in _SENTENCE.split(joined) if CUE.search(part))


def own_licenses(files: DataFrame, n_docs: int, frequency: dict[int, int]) -> DataFrame:
    """(id, path, license, cosine, is_file) of each row of (id, path, __text)."""
    texts = full_texts()

    def run(batches):
        match = Matcher(n_docs, frequency, texts)
        for rec, data, off in X.blocks(batches, "__text"):
            block = data.tobytes()
            hinted = {int(np.searchsorted(off, m.start(), side="right")) - 1
                      for m in CUE.finditer(block)}
            name, cosine, whole = [None] * rec.num_rows, [None] * rec.num_rows, [False] * rec.num_rows
            for i in hinted:
                raw = block[off[i]:off[i + 1]]
                full = match.whole(raw)
                if full:  # the notices that an unknown license quotes are not its own
                    if full[0]:
                        (name[i], cosine[i]), whole[i] = full, True
                    continue
                tag = spdx_name(raw)
                found, covered = [(-1.0, tag)] if tag else [], len(word_hashes(tag.encode())) + 3 if tag else 0
                for _, part in license_segments(raw):
                    got = match.best(part)
                    if got:
                        found.append((-got[1], got[0]))
                        covered += len(word_hashes(part))
                for part in chain(license_windows(raw), license_paragraphs(raw)):
                    got = match.best(part)
                    if got and -got[1] < min(found, default=(0.0, ""))[0]:
                        found.append((-got[1], got[0]))
                        covered = max(covered, len(word_hashes(part)))
                if found:
                    c, name[i] = min(found)
                    cosine[i] = -c
                    whole[i] = covered >= FILE_SHARE * len(word_hashes(raw))
            yield pa.RecordBatch.from_arrays(
                [rec.column(0), rec.column(1), pa.array(name, pa.string()),
                 pa.array(cosine, pa.float64()), pa.array(whole)],
                names=["id", "path", "license", "cosine", "is_file"])

    return X.map_arrow(files, run, T.StructType([
        T.StructField("id", files.schema["id"].dataType), T.StructField("path", T.StringType()),
        T.StructField("license", T.StringType()), T.StructField("cosine", T.DoubleType()),
        T.StructField("is_file", T.BooleanType())]))


def directory(path: Column) -> Column:
    """All but the last part of a path; "" for a path of one part."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(files: DataFrame, id_col: str = "doc_id", path_col: str = "path",
                  text_col: str = "text") -> DataFrame:
    """(id, path, license, cosine, origin): origin is header, file, inherited or null."""
    src = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"),
                       F.col(text_col).alias("__text"))
    own = materialize(own_licenses(src, *document_frequencies(src, "__text"))
                      .withColumn("dir", directory(F.col("path"))), "licenses")
    declared = (own.where("is_file and dir is not null").groupBy("dir")
                .agg(F.min(F.struct(-F.col("cosine"), "license")).alias("best"))
                .select(F.col("dir").alias("up"), F.col("best.license").alias("inherited")))
    dirs = own.select("dir").where("dir is not null").distinct()
    # a directory, its ancestors and their depth: a/b/c -> a/b/c 3, a/b 2, a 1, "" 0
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    up = dirs.withColumn("parts", parts).select(
        "dir", F.explode(F.transform(
            F.sequence(F.lit(0), F.size("parts")),
            lambda k: F.struct(k.alias("depth"),
                               F.array_join(F.slice("parts", 1, k), "/").alias("up")))).alias("a")
    ).select("dir", "a.depth", "a.up")
    nearest = materialize(up.join(declared, "up").groupBy("dir")
                          .agg(F.max(F.struct("depth", "inherited")).alias("best"))
                          .select("dir", F.col("best.inherited").alias("inherited")), "nearest")
    origin = (F.when(F.col("is_file"), "file").when(F.col("license").isNotNull(), "header")
              .when(F.col("inherited").isNotNull(), "inherited"))
    if nearest.count() <= MAX_DIRS:
        joined = own.join(F.broadcast(nearest), "dir", "left")
    else:  # one directory may hold a third of all files: its rows go to SALTS tasks
        salted = nearest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = own.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")).join(
            salted, ["dir", "salt"], "left")
    return joined.select(
        F.col("id").alias(id_col), "path", F.coalesce("license", "inherited").alias("license"),
        "cosine", origin.alias("origin"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: license of every document; its path is source/lang/id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn(
        "path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    return scan_licenses(docs)
