"""License scan as an exact set-similarity join of text blocks with license templates.

A block is a paragraph of a document, the lines between two empty ones, so that a notice may be
wrapped; a template is the set of words of a license notice. A block
matches if it holds at least ``CONTAINMENT`` of a template's words. Words are ordered by how
often they occur in all documents, rarest first. Of a template of n words that needs m, any
match holds one of its n - m + 1 rarest (prefix filter), has at least m words of the templates'
vocabulary (length filter), and the places of a shared word in both orders must leave room for
m shared words (positional filter). What passes is counted exactly, so no match is missed and
none is wrong. Words outside the vocabulary cannot add to a containment and are left out.

Scale: documents are read twice and never shuffled. Word counts and the index of rarest words are
bounded by the templates, which are a parameter, so the join is a broadcast one; blocks without
a rare word never leave the scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta.llm.words import blocks, bound_batches, split_words
from folianta.storage import materialize

PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
CONTAINMENT = 0.9
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def word_list(text: str) -> list[str]:
    """Words of a short text."""
    words = split_words(pa.array([text]))
    return words.text(0, len(words.hashes)).split(" ") if len(words.hashes) else []


def needed(size: int, containment: float) -> int:
    """How many of ``size`` words a match holds."""
    return max(1, math.ceil(round(containment * size, 9)))


def _hashes(vocabulary: list[str]) -> np.ndarray:
    return split_words(pa.array([" ".join(vocabulary)])).hashes


def _numbers(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Place of each hash in ``vocabulary``, -1 for others."""
    order = np.argsort(vocabulary)
    at = np.searchsorted(vocabulary[order], hashes).clip(max=max(len(vocabulary) - 1, 0))
    known = order[at]
    return np.where(vocabulary[known] == hashes, known, -1)


def word_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Occurrences of each word of ``vocabulary`` in all of ``docs``."""
    known = _hashes(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), dtype=np.int64)
        for batch in blocks(batches, "text"):
            numbers = _numbers(split_words(batch.column("text")).hashes, known)
            total += np.bincount(numbers[numbers >= 0], minlength=len(known))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(known), dtype=np.int32)), pa.array(total)], ["word", "places"]
        )

    counted = docs.select("text").mapInArrow(run, "word int, places bigint")
    sums = counted.groupBy("word").agg(F.sum("places").alias("places")).collect()
    return dict.fromkeys(vocabulary, 0) | {vocabulary[r["word"]]: r["places"] for r in sums}


def _paragraph_ends(data: np.ndarray) -> np.ndarray:
    """Places of line ends that close an empty line."""
    ends = np.flatnonzero(data == 10)
    filled = np.concatenate([[0], np.cumsum(~np.isin(data, (9, 10, 13, 32)))])
    return ends[1:][filled[ends[1:]] == filled[ends[:-1]]]


def _scan(ordered: list[str], rare: np.ndarray, least: int, phrases: list[tuple[str, str]], names: list[str]):
    known = _hashes(ordered)
    wanted = [(phrase, label, _hashes(phrase.split(" "))) for phrase, label in phrases]
    kind = pa.list_(pa.struct([("block", pa.int64()), ("words", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            words = split_words(batch.column("text"))
            first = words.first
            sizes = np.diff(first)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            places: list[list[int]] = [[] for _ in sizes]
            labels: list[set[str]] = [set() for _ in sizes]
            for phrase, label, hashes in wanted:
                count = max(0, len(owner) - len(hashes) + 1)
                same = np.ones(count, dtype=bool)
                for i, value in enumerate(hashes):
                    same &= words.hashes[i : i + count] == value
                for at in np.flatnonzero(same).tolist():
                    text = int(owner[at])
                    if at + len(hashes) <= first[text + 1] and words.text(at, at + len(hashes)) == phrase:
                        places[text].append(at - int(first[text]))
                        labels[text].add(label)
            numbers = _numbers(words.hashes, known)
            parts = np.searchsorted(_paragraph_ends(words.data), words.starts) + owner
            hit = np.isin(parts, np.unique(parts[np.isin(numbers, rare)])) & (numbers >= 0)
            found: list[list[dict]] = [[] for _ in sizes]
            at = np.flatnonzero(hit)
            edges = np.flatnonzero(np.diff(parts[at], prepend=-1, append=-1)) if len(at) else at
            for low, high in zip(edges[:-1], edges[1:]):
                mine = np.unique(numbers[at[low:high]])
                if len(mine) >= least:
                    found[owner[at[low]]].append({"block": int(parts[at[low]]), "words": mine.tolist()})
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array(sizes.astype(np.int64)),
                    pa.array([sorted(x) for x in places], pa.list_(pa.int64())),
                    pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                    pa.array(found, kind),
                ],
                [*names, "n_words", "places", "base", "blocks"],
            )

    return run


def scan_licenses(
    docs: DataFrame,
    doc_id: str = "doc_id",
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: list[tuple[str, str]] = PHRASES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``_row, doc_id, n_words, places, base, matches``, one row per row of ``docs``.

    ``places`` are the word numbers at which a phrase starts, ``base`` the labels of phrases,
    ``matches`` the labels of templates with the best containment of each. Null and empty texts
    have no words and no match; repeated rows are scanned each; an empty table gives no rows;
    other columns are ignored. ``docs`` must be a plain scan of files.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    sets = [(label, sorted(set(word_list(text)))) for label, text in templates]
    sets = [(label, words) for label, words in sets if words]
    counts = word_counts(docs, sorted({w for _, words in sets for w in words}))
    ordered = sorted(counts, key=lambda word: (counts[word], word))
    number = {word: i for i, word in enumerate(ordered)}
    index, rare, least = [], set(), len(ordered)
    for template, (label, words) in enumerate(sets):
        numbers = sorted(number[w] for w in words)
        need = needed(len(numbers), containment)
        least = min(least, need)
        for at, word in enumerate(numbers[: len(numbers) - need + 1]):
            rare.add(word)
            index.append((word, at, template, label, need, numbers))
    source = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).alias("doc_id"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    scanned = materialize(
        source.mapInArrow(
            _scan(ordered, np.array(sorted(rare)), least, phrases, ["_row", "doc_id"]),
            f"_row bigint, doc_id {kind}, n_words bigint, places array<bigint>, base array<string>, "
            "blocks array<struct<block:bigint,words:array<int>>>",
        ),
        "license-blocks",
    )
    prefixes = spark.createDataFrame(
        index, "word int, at int, template int, label string, need int, numbers array<int>"
    )
    probes = (
        scanned.select("_row", F.explode("blocks").alias("b"))
        .select("_row", "b.*")
        .select("_row", "block", "words", F.posexplode("words").alias("place", "word"))
    )
    room = F.least("at", "place") + 1 + F.least(
        F.size("numbers") - F.col("at") - 1, F.size("words") - F.col("place") - 1
    )
    matches = (
        probes.join(F.broadcast(prefixes), "word")
        .where((F.size("words") >= F.col("need")) & (room >= F.col("need")))
        .select("_row", "block", "template", "label", "need", "words", "numbers")
        .withColumn("shared", F.size(F.array_intersect("words", "numbers")))
        .where("shared >= need")
        .groupBy("_row", "label")
        .agg(F.max(F.col("shared") / F.size("numbers")).alias("score"))
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct("label", "score"))).alias("matches"))
    )
    nothing = F.expr("cast(array() as array<struct<label:string,score:double>>)")
    return scanned.join(matches, "_row", "left").select(
        "_row", "doc_id", "n_words", "places", "base", F.coalesce("matches", nothing).alias("matches")
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = F.array_sort(F.array_union("base", F.transform("matches", lambda m: m["label"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATE_ROWS = ", ".join(
    f"({i}, {_quoted(label)}, {_quoted(word)}, {len(words)}, {needed(len(words), CONTAINMENT)})"
    for i, (label, words) in enumerate((label, sorted(set(word_list(text)))) for label, text in TEMPLATES)
    for word in words
)
_PHRASE_ROWS = ", ".join(f"({_quoted(p)}, {_quoted(label)}, {len(p.split())})" for p, label in PHRASES)
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
WITH texts AS (
    SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents
), words AS (
    SELECT doc_id, {_WORDS.format("t")} AS w FROM texts
), phrases(phrase, label, n) AS (VALUES {_PHRASE_ROWS}),
places AS (
    SELECT doc_id, i - 1 AS spot, label
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words), phrases
    WHERE array_to_string(w[i : i + n - 1], ' ') = phrase
), base AS (
    SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word,
           list(DISTINCT label) AS labels
    FROM places GROUP BY doc_id
), templates(template, label, word, size, need) AS (VALUES {_TEMPLATE_ROWS}),
paragraphs AS (
    SELECT doc_id, string_split_regex(t, '\\n[ \\t\\r]*\\n') AS l FROM texts
), blocks AS (
    SELECT doc_id, i, unnest(list_distinct({_WORDS.format("l[i]")})) AS word
    FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM paragraphs)
), matched AS (
    SELECT doc_id, label, count(*) / any_value(size) AS score
    FROM blocks JOIN templates USING (word)
    GROUP BY doc_id, i, template, label HAVING count(*) >= any_value(need)
), own AS (
    SELECT doc_id, max(score) AS score, list(DISTINCT label) AS labels FROM matched GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') AS labels,
       coalesce(own.score, 0.0) AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
"""

QUERIES = {"op3_license_scan": op3_license_scan}
ORACLES = {"op3_license_scan": ORACLE}
