"""License scans: base phrases, and templates found by diagonal voting.

Words are runs of digits, letters and characters beyond ASCII after lower-casing A-Z. The
hashes of all runs of ``K`` words of a text are joined by Spark to the positions of equal runs
in the templates. A hit at text position p and template position q votes for diagonal p - q
of its text and template. Diagonals within ``DIAGONAL_GAP`` of each other whose hits lie within
the template's length of one another are merged, and a merged group is kept if its hits cover
``MIN_COVER`` of the template's positions: that is a verified span.

Base phrases are places where a phrase's words stand consecutively; they need no vote. Null
and empty texts have no words and no labels. Every row gets a row, repeated ids and null ids
included; rows of one id and text are scanned together, under a 128-bit hash of both. Other
columns play no part. Any number of hits of one text and template only fills that text's own
group, which its length bounds. Words are compared by the 64-bit hashes of their runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.llm.session import table
from quirework.llm.textvec import SpanHasher, column_bytes, gram_hashes, text_slices, word_bounds, word_hashes, words_of

K = 3
DIAGONAL_GAP = 2
MIN_COVER = 0.8
#: (phrase, label)
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: (label, text); the whole list is broadcast, so it is held below MAX_TEMPLATE_WORDS words.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related rights to this work"),
    ("public-domain", "This work has been released into the public domain"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)
MAX_TEMPLATE_WORDS = 1 << 20


def template_positions(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """Columns h, t (template number), q (position) of all runs of k template words."""
    rows, total = [], 0
    for t, (_, text) in enumerate(templates):
        words = words_of(text)
        total += len(words)
        if len(words) < k:
            raise ValueError(f"template {t} has fewer than {k} words")
        hashes, at = gram_hashes(word_hashes(words), np.array([0, len(words)]), k)
        rows += [(int(h), t, int(q)) for h, q in zip(hashes.view(np.int64), at)]
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError("too many template words to broadcast")
    return spark.createDataFrame(rows, "h long, t int, q int")


def _gram_rows(df: DataFrame, phrases, text_col: str, id_col: str, k: int) -> DataFrame:
    """A row for each text (pos -1, with its counts and base finds) and one for each run of k words (pos, h)."""
    wanted = [(word_hashes(words_of(p)), label) for p, label in phrases]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            for b in text_slices(whole, "_text"):
                n = b.num_rows
                buf, offs = column_bytes(b.column(1))
                # Named by what they hold, so that a task that runs again names them alike.
                names_of = [xxhash.xxh3_128_digest(buf[a:z].tobytes() + repr(i).encode()) for a, z, i in zip(offs, offs[1:], b.column(0).to_pylist())]
                uid = np.frombuffer(b"".join(names_of), "<i8").reshape(n, 2)
                starts, ends, firsts = word_bounds(buf, offs)
                words = SpanHasher(buf)(starts, ends)
                doc = np.repeat(np.arange(n), np.diff(firsts))
                place = np.arange(len(words)) - firsts[:-1][doc] if len(words) else np.zeros(0, np.int64)
                n_base, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                labels = [set() for _ in range(n)]
                for phrase, label in wanted:
                    m = len(phrase)
                    if len(words) < m or not m:
                        continue
                    hit = words[: len(words) - m + 1] == phrase[0]
                    for i in range(1, m):
                        hit &= (words[i : len(words) - m + 1 + i] == phrase[i]) & (doc[i : len(words) - m + 1 + i] == doc[: len(words) - m + 1])
                    at = np.flatnonzero(hit)
                    np.add.at(n_base, doc[at], 1)
                    np.minimum.at(first, doc[at], place[at])
                    np.maximum.at(last, doc[at], place[at])
                    for d in set(doc[at].tolist()):
                        labels[d].add(label)
                none = n_base == 0
                base = pa.array([",".join(sorted(x)) for x in labels], pa.string())
                zeros = pa.array(np.zeros(n, np.int64))
                names = ["u0", "u1", "doc_id", "pos", "h", "n_words", "n_base", "first_word", "last_word", "base_labels"]
                yield pa.RecordBatch.from_arrays([pa.array(uid[:, 0]), pa.array(uid[:, 1]), b.column(0), pa.array(np.full(n, -1, np.int32)), zeros, pa.array(np.diff(firsts).astype(np.int64)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none), base], names)
                hashes, at = gram_hashes(words, firsts, k)
                m = len(at)
                if m:
                    void = pa.nulls(m, pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(uid[doc[at], 0]), pa.array(uid[doc[at], 1]), void, pa.array(place[at].astype(np.int32)), pa.array(hashes.view(np.int64)), void, void, void, void, pa.nulls(m, pa.string())], names)

    source = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return source.mapInArrow(run, "u0 long, u1 long, doc_id long, pos int, h long, n_words long, n_base long, first_word long, last_word long, base_labels string")


def scan_licenses(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", phrases=PHRASES, templates=TEMPLATES, k: int = K, min_cover: float = MIN_COVER) -> DataFrame:
    """One row for each row of ``df``: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    spans: array of (label, start word, end word, cover); score: the best cover, 1 if a base phrase stands in the text.
    """
    spark = df.sparkSession
    names = spark.createDataFrame([(t, label, len(words_of(text)) - k + 1) for t, (label, text) in enumerate(templates)], "t int, label string, length int")
    # A row of each text passes the join by a mark of its own; the templates are a bounded list.
    marked = template_positions(spark, templates, k).withColumn("whole", F.lit(False)).union(spark.createDataFrame([(0, -1, -1, True)], "h long, t int, q int, whole boolean"))
    grams = _gram_rows(df, phrases, text_col, id_col, k).withColumn("whole", F.col("pos") == -1)
    hits = grams.join(F.broadcast(marked), ["h", "whole"]).join(F.broadcast(names), "t", "left")
    # Votes of a diagonal: which template positions, and where in the text.
    votes = hits.groupBy("u0", "u1", "t", (F.when(F.col("t") >= 0, F.col("pos") - F.col("q")).otherwise(-1)).alias("diagonal")).agg(
        F.any_value("label").alias("label"), F.any_value("length").alias("length"), F.collect_set("q").alias("qs"), F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.sum(F.col("whole").cast("long")).alias("copies"),
        *[F.max(c).alias(c) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")])
    by = Window.partitionBy("u0", "u1", "t").orderBy("diagonal")
    near = (F.col("diagonal") - F.lag("diagonal").over(by) <= DIAGONAL_GAP) & (F.col("lo") - F.lag("lo").over(by) < F.col("length"))
    grouped = votes.withColumn("new", F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1)).withColumn("g", F.sum("new").over(by))
    groups = grouped.groupBy("u0", "u1", "t", "g").agg(
        F.any_value("label").alias("label"), F.any_value("length").alias("length"), F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("covered"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("copies").alias("copies"),
        *[F.max(c).alias(c) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")])
    cover = F.col("covered") / F.col("length")
    span = F.when((F.col("t") >= 0) & (cover >= min_cover), F.struct("label", F.col("lo").cast("long").alias("start"), (F.col("hi") + k).cast("long").alias("end"), cover.alias("cover")))
    rows = groups.groupBy("u0", "u1").agg(F.sort_array(F.collect_list(span)).alias("spans"), F.sum("copies").alias("copies"), *[F.max(c).alias(c) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")])
    base = F.filter(F.split("base_labels", ","), lambda x: x != "")
    labels = F.array_join(F.array_sort(F.array_distinct(F.concat(base, F.transform("spans", lambda s: s["label"])))), ",")
    best = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)))
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select(F.col("doc_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), best.alias("score"), "spans")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def _oracle() -> str:
    grams = []
    for t, (label, text) in enumerate(TEMPLATES):
        w = words_of(text)
        grams += [f"({t}, '{label}', {len(w) - K + 1}, {q}, '{' '.join(w[q : q + K])}')" for q in range(len(w) - K + 1)]
    phrases = ", ".join(f"('{' '.join(words_of(p))}', {len(words_of(p))}, '{label}')" for p, label in PHRASES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
tg(t, label, length, q, g) AS (VALUES {", ".join(grams)}),
ph(p, m, label) AS (VALUES {phrases}),
pos AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d),
bh AS (SELECT doc_id, i, label FROM pos JOIN ph ON array_to_string(w[i + 1 : i + m], ' ') = p),
b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS ls FROM bh GROUP BY doc_id),
hit AS (SELECT doc_id, t, label, length, i AS pos, q, i - q AS diagonal FROM pos JOIN tg ON array_to_string(w[i + 1 : i + {K}], ' ') = g),
v AS (SELECT doc_id, t, label, length, diagonal, list(DISTINCT q) AS qs, min(pos) AS lo FROM hit GROUP BY ALL),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= {DIAGONAL_GAP} AND lo - lag(lo) OVER o < length THEN 0 ELSE 1 END AS new FROM v WINDOW o AS (PARTITION BY doc_id, t ORDER BY diagonal)),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS g FROM n),
c AS (SELECT doc_id, t, label, length, len(list_distinct(flatten(list(qs)))) / CAST(length AS DOUBLE) AS cover FROM g GROUP BY doc_id, t, label, length, g),
s AS (SELECT doc_id, list(label) AS ls, max(cover) AS best FROM c WHERE cover >= {MIN_COVER} GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(b.ls), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.ls, []), coalesce(s.ls, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id
"""


ORACLE_OP3 = _oracle()
