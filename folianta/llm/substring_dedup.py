"""Removal of passages that repeat across documents, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the least hash among its grams of
``GRAM`` words. Consecutive windows of a text mostly share their minimiser; such a run, a
super-k-mer, travels to the minimiser's bucket as one packed string of words instead of a string
per window. Equal windows have equal minimisers, so they meet in one bucket, where sorting brings
them together and shows exactly in which document each window begins first.

In steps, each over all texts:

1. Minimisers with their smallest and largest document are aggregated. Where both are the same
   document, no window can repeat. The others mark a bit table of fixed size.
2. Super-k-mers with a marked minimiser are listed by hash, without their words, and the smallest
   document of each marks a second bit table.
3. That document alone packs the words and sends them to the bucket. Buckets are sorted and name
   the first document of each window. A bucket with a minimiser of more than ``BUCKET`` texts (a
   common phrase in many contexts) is dealt out by whole windows instead, so that no task
   gets it as one group.
4. The list of step 2 meets the first documents by minimiser and hash (128 bits) and goes back to
   the texts by document and text hash.

Scale: bit tables only save work. Where the corpus has so many repeated minimisers that they fill
up, more super-k-mers travel (about three times the text, if all do) and results stay the same.
However many copies of a text or passage there are, its words travel once; the way back is a join
whose other side has one row per super-k-mer, so AQE can split any hot one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta.llm.tables import small
from folianta.llm.words import NOT_SPACE, UNCHANGED, Words, blocks, bound_batches, grams, split_words
from folianta.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 13
GRAM = 4
BITS = 1 << 27
PART_BITS = 1 << 15  # that Spark's bitmap functions put into one row
BUCKET = 4_096


def _words(texts: pa.Array) -> Words:
    return split_words(texts, NOT_SPACE, UNCHANGED)


def super_kmers(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """``text, first, windows, minimiser`` of all runs of windows with one minimiser.

    ``first`` is the run's first word among those of the block, ``windows`` how many it has.
    """
    count = len(words.hashes) - window + 1
    none = np.zeros(0, dtype=np.int64)
    if count <= 0:
        return none, none, none, none
    sizes = np.diff(words.first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    hashes = grams(words.hashes, gram)
    seen = np.lib.stride_tricks.sliding_window_view(hashes, window - gram + 1)
    place = seen.argmin(axis=1) + np.arange(count)
    whole = owner[:count] == owner[window - 1 :]
    opens = whole.copy()
    opens[1:] &= ~whole[:-1] | (place[1:] != place[:-1])
    first = np.flatnonzero(opens)
    closes = whole.copy()
    closes[:-1] &= ~whole[1:] | opens[1:]
    last = np.flatnonzero(closes)
    return owner[first], first, last - first + 1, hashes[place[first]].view(np.int64)


def _minimisers(window: int, gram: int):
    """Distinct minimisers of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            text, _, _, found = super_kmers(_words(batch.column("text")), window, gram)
            pairs = np.unique(np.stack([text, found]), axis=1) if len(text) else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(pairs[0])), pa.array(pairs[1])], ["id", "minimiser"]
            )

    return run


def _marked(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    places = places & np.int64(8 * len(table) - 1)
    return (table[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def _runs(shared, window: int, gram: int):
    """Super-k-mers with a marked minimiser, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in blocks(batches, "text"):
            words = _words(batch.column("text"))
            found = super_kmers(words, window, gram)
            text, first, windows, minimiser = (x[_marked(marked, found[3])] for x in found)
            spans = words.spans(first, first + windows + window - 1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).take(pa.array(text)) for name in ("id", "hash")),
                    *map(pa.array, (minimiser, spans, first - words.first[text], windows)),
                ],
                ["id", "hash", "minimiser", "run", "start", "windows"],
            )

    return run


def _packed(shared, window: int, gram: int):
    """Super-k-mers whose minimiser and document are marked, as packed strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minimisers, owners = (np.frombuffer(table.value, dtype=np.uint8) for table in shared)
        for batch in blocks(batches, "text"):
            words = _words(batch.column("text"))
            found = super_kmers(words, window, gram)
            text, first, windows, minimiser = (x[_marked(minimisers, found[3])] for x in found)
            spans = words.spans(first, first + windows + window - 1).view(np.int64)
            ids = batch.column("id").to_numpy()[text]
            kept = _marked(owners, minimiser ^ spans ^ ids)
            first, windows, spans, ids, minimiser = (x[kept] for x in (first, windows, spans, ids, minimiser))
            spaced, begins = words.spaced()
            last = first + windows + window - 2
            low, high = begins[first], begins[last] + (words.ends - words.starts)[last]
            sizes = high - low
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            at = np.arange(offsets[-1]) + np.repeat(low - offsets[:-1], sizes)
            strings = pa.LargeStringArray.from_buffers(
                len(low), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(spaced[at].tobytes())
            )
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, (ids, minimiser, spans)), strings.cast(pa.string())],
                ["id", "minimiser", "run", "packed"],
            )

    return run


def first_documents(packed: pa.Array, first: np.ndarray, window: int) -> list[np.ndarray]:
    """For each packed string, the smallest document of each of its windows among all strings."""
    texts = [p.split(b" ") for p in packed.cast(pa.binary()).to_pylist()]
    counts = np.array([len(t) - window + 1 for t in texts], dtype=np.int64)
    windows = [b" ".join(t[i : i + window]) for t, n in zip(texts, counts) for i in range(n)]
    documents = np.repeat(first, counts)
    table = pa.table([pa.array(windows, pa.binary()), pa.array(documents)], ["window", "document"])
    order = pc.sort_indices(table, [("window", "ascending"), ("document", "ascending")]).to_numpy()
    ordered = table.column("window").combine_chunks().take(pa.array(order))
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = pc.not_equal(ordered[1:], ordered[:-1]).to_numpy(zero_copy_only=False)
    least = np.empty(len(order), dtype=np.int64)
    least[order] = documents[order[np.flatnonzero(opens)]][np.cumsum(opens) - 1]
    return np.split(least, np.cumsum(counts)[:-1])


def _buckets(window: int):
    """First documents of the windows of each super-k-mer; rows come sorted by bucket."""

    def settle(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        ids = rows.column("id").to_numpy()
        found = first_documents(rows.column("packed").combine_chunks(), ids, window)
        keys = zip(rows.column("minimiser").to_pylist(), rows.column("run").to_pylist())
        once = list(dict(zip(keys, range(len(ids)))).values())
        return pa.RecordBatch.from_arrays(
            [
                *(rows.column(name).combine_chunks().take(pa.array(once, pa.int64())) for name in ("minimiser", "run")),
                pa.array([found[i] for i in once], pa.list_(pa.int64())),
            ],
            ["minimiser", "run", "firsts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            keys = batch.column("minimiser").to_numpy()
            cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
            before = held[-2].column("minimiser")[-1].as_py() if len(held) > 1 else keys[0]
            if cut or before != keys[0]:  # all but the last bucket are whole
                yield settle(pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]))
                held = [batch.slice(cut)]
        if held:
            yield settle(pa.Table.from_batches(held))

    return run


def _bit_table(places: DataFrame, bits: int) -> bytes:
    """``bits`` bits, of which those that the values of ``place`` end with are set."""
    place = F.col("place").bitwiseAND(F.lit(bits - 1))
    rows = (
        places.select(place.alias("place"))
        .select(F.shiftright("place", 15).alias("part"), F.col("place").bitwiseAND(F.lit(PART_BITS - 1)).alias("at"))
        .repartition("part")
        .groupBy("part")
        .agg(F.bitmap_construct_agg("at").alias("bitmap"))
        .toArrow()
    )
    size = PART_BITS // 8
    table = np.zeros(bits // 8, dtype=np.uint8)
    for part, bitmap in zip(rows.column("part").to_pylist(), rows.column("bitmap")):
        table[part * size : (part + 1) * size] = np.frombuffer(bitmap.as_buffer(), dtype=np.uint8)
    return table.tobytes()


def _by_windows(packed: DataFrame, window: int) -> DataFrame:
    """First documents of super-k-mers of crowded buckets, window by window."""
    parts = F.expr(
        f"transform(sequence(0, size(w) - {window}), i -> array_join(slice(w, i + 1, {window}), ' '))"
    )
    rows = (
        packed.groupBy("minimiser", "run")
        .agg(F.min("id").alias("id"), F.first("packed").alias("packed"))
        .withColumn("w", F.split("packed", " "))
        .select("minimiser", "run", "id", F.posexplode(parts).alias("at", "words"))
    )
    least = rows.groupBy("words").agg(F.min("id").alias("least"))
    listed = F.array_sort(F.collect_list(F.struct("at", "least")))
    return (
        rows.join(least, "words")
        .groupBy("minimiser", "run")
        .agg(F.transform(listed, lambda x: x["least"]).alias("firsts"))
    )


def repeated_windows(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    bits: int = BITS,
    bucket: int = BUCKET,
) -> DataFrame:
    """``id, hash, marks``: documents with windows that begin in a smaller document.

    ``hash`` is that of the text, so that rows with one id are told apart. ``marks`` lists
    ``start`` (a word) and ``flags``, in whose binary digits the last stands for the last window
    of a run: 1 if it is repeated. Documents with a null id are smaller and larger than none.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    met = materialize(
        rows.mapInArrow(_minimisers(window, gram), "id bigint, minimiser bigint")
        .groupBy("minimiser")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
        .where("low < high")
        .select("minimiser", F.when(F.col("n") > bucket, True).alias("crowded")),
        "shared-minimisers",
    )
    shared = spark.sparkContext.broadcast(_bit_table(met.select(F.col("minimiser").alias("place")), bits))
    runs = materialize(
        rows.select("id", F.xxhash64("text").alias("hash"), "text").mapInArrow(
            _runs(shared, window, gram),
            "id bigint, hash bigint, minimiser bigint, run bigint, start bigint, windows bigint",
        ),
        "super-k-mers",
    )
    owners = runs.groupBy("minimiser", "run").agg(F.min("id").alias("id"))
    place = F.col("minimiser").bitwiseXOR(F.col("run")).bitwiseXOR(F.col("id"))
    owned = spark.sparkContext.broadcast(_bit_table(owners.select(place.alias("place")), bits))
    packed = rows.mapInArrow(
        _packed((shared, owned), window, gram), "id bigint, minimiser bigint, run bigint, packed string"
    )
    crowded = small(met.where("crowded").select("minimiser"), 16)
    firsts = (
        packed.join(crowded, "minimiser", "left_anti")
        .repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(_buckets(window), "minimiser bigint, run bigint, firsts array<bigint>")
    )
    if not met.where("crowded").isEmpty():
        firsts = firsts.unionByName(_by_windows(packed.join(crowded, "minimiser", "left_semi"), window))
    firsts = materialize(firsts, "first-documents")
    flags = F.expr("aggregate(firsts, 0L, (flags, first) -> 2 * flags + IF(first < id, 1L, 0L))")
    return (
        runs.join(firsts, ["minimiser", "run"])
        .select("id", "hash", "start", "windows", flags.alias("flags"))
        .where("flags > 0")
        .distinct()
        .groupBy("id", "hash")
        .agg(F.collect_list(F.struct("start", "windows", "flags")).alias("marks"))
    )


def _covered(words: Words, marks: pa.ListArray, window: int) -> np.ndarray:
    """Which words of a block a marked window covers."""
    edges = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    text = np.repeat(np.arange(len(marks)), pc.fill_null(pc.list_value_length(marks), 0).to_numpy())
    listed = marks.flatten()
    start, windows, flags = (pc.struct_field(listed, name).to_numpy() for name in ("start", "windows", "flags"))
    begin = words.first[text] + start
    for i in range(int(windows.max(initial=0))):
        at = begin[(windows > i) & (flags >> np.maximum(windows - 1 - i, 0) & 1 == 1)] + i
        np.add.at(edges, at, 1)
        np.add.at(edges, at + window, -1)
    return np.cumsum(edges)[:-1] > 0


def _kept(window: int):
    """Texts without their covered words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            words = _words(batch.column("text"))
            spaced, begins = words.spaced()
            covered = _covered(words, batch.column("marks"), window)
            sizes = np.diff(np.append(begins, len(spaced)))
            left = np.concatenate([[0], np.cumsum(np.where(covered, 0, sizes))])[words.first]
            removed = np.diff(np.concatenate([[0], np.cumsum(covered)])[words.first])
            kept = spaced[~np.repeat(covered, sizes)].tobytes()
            texts = [kept[a:b] for a, b in zip(left[:-1], left[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(np.diff(words.first)),
                    pa.array(removed.astype(np.int64)),
                    pa.array([t[:-1].decode() for t in texts], pa.string()),
                ],
                ["row", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, **parameters
) -> DataFrame:
    """``docs`` as struct ``row``, with ``n_words``, ``n_removed`` and ``kept``.

    ``kept`` holds the words, joined by single spaces, that no window covers which also begins
    in a document with a smaller id. Null and empty texts have no words. Rows with the same id
    do not remove each other's words, and rows with a null id neither remove nor lose any. A very
    long text is one row and one Arrow batch: a task needs about a hundred bytes a word of it.
    Other columns may have any name. An empty table gives no rows.
    """
    marks = repeated_windows(docs, doc_id, text, window, **parameters)
    known = materialize(
        marks.select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), "marks"), "removed-words"
    )
    rows = docs.select(
        F.struct(*[c for c in docs.columns if c != text]).alias("row"),
        F.col(text).alias("text"),
        F.col(doc_id).cast("bigint").alias("_id"),
        F.xxhash64(text).alias("_hash"),
    )
    met = rows.join(small(known, 64 + 32 * F.size("marks")), ["_id", "_hash"], "left").select("row", "text", "marks")
    kind = met.schema["row"].dataType.simpleString()
    return met.mapInArrow(_kept(window), f"row {kind}, n_words bigint, n_removed bigint, kept string")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document once passages of smaller documents are removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeated(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE = rf"""
WITH listed AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
windows AS MATERIALIZED (
    SELECT r, doc_id, s, array_to_string(words[s : s + {WINDOW - 1}], ' ') AS w
    FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS s FROM listed)),
firsts AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w),
covered AS (
    SELECT DISTINCT r, unnest(range(s, s + {WINDOW})) AS i
    FROM windows JOIN firsts USING (w) WHERE least < doc_id),
gone AS (SELECT r, list(i) AS places FROM covered GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' '))
           AS kept_sha256
FROM listed LEFT JOIN gone USING (r)
"""

QUERIES = {"op12_substring_dedup": op12_substring_dedup}
ORACLES = {"op12_substring_dedup": ORACLE}
