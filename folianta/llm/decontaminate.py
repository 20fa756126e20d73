"""Benchmark decontamination by winnowing.

Of every window of consecutive k-grams the ones with the smallest hash are kept as
fingerprints, in documents and in benchmark items alike. A run of ``window`` words that both
share contains the same k-grams on both sides, hence a common fingerprint, so no shared run of
that length is missed. Fingerprints of both sides are joined by hash and each hit is extended
word by word; only runs of at least ``window`` words count, so no false hit survives.

Items shorter than a window have no window to winnow in. They are looked for as a whole: for
each such length that occurs, all runs of that many document words are fingerprints.

Scale: documents are read once and never shuffled; what leaves the scan is one narrow row per
document with the fingerprints that may occur in the benchmark, told by a bit table of at most
16 MB whatever the size of the benchmark. The join is an ordinary one, so a passage that a
third of all documents share is split by adaptive execution like any skewed key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta.llm.tables import numbered
from folianta.llm.words import blocks, bound_batches, grams, split_words
from folianta.storage import materialize

WINDOW = 13
GRAM = 5
MAX_TABLE_BITS = 27

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
PRINTS = "array<struct<hash:bigint,at:int,back:int,words:string>>"


def winnow(hashes: np.ndarray, first: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Positions of k-grams that are the smallest of some ``window``-word window of their text.

    ``hashes`` holds a hash for each run of ``gram`` words, also runs across two texts; windows
    that cross texts are ignored. Equal smallest hashes are all kept.
    """
    width = window - gram + 1
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.int64)
    least = hashes
    span = 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    inside = np.zeros(count, dtype=bool)
    for begin, end in zip(first[:-1], first[1:]):
        if end - begin >= window:
            inside[begin : end - window + 1] = True
    # the largest window minimum over all windows that contain a k-gram: equal to its hash if kept
    most = np.zeros(len(hashes) + width - 1, dtype=np.uint64)
    most[width - 1 : width - 1 + count] = np.where(inside, least, 0)
    span = 1
    while span < width:
        step = min(span, width - span)
        most = np.maximum(most[: len(most) - step], most[step:])
        span += step
    return np.flatnonzero((most == hashes) & (most > 0))


def fingerprints(
    texts: pa.Array, gram: int, window: int, lengths: list[int] | None, table: np.ndarray | None
) -> tuple[np.ndarray, list[list[tuple[int, int, int, str]]]]:
    """Words per text and its fingerprints (hash, first word, words before, nearby words).

    ``lengths`` are the short item lengths to look for; None stands for an item, which has
    fingerprints of one kind only. ``table`` drops fingerprints that no item has.
    """
    words = split_words(texts)
    sizes = np.diff(words.first)
    found: list[list[tuple[int, int, int, str]]] = [[] for _ in sizes]
    runs = []
    hashes = grams(words.hashes, gram)
    if len(hashes):
        runs.append((gram, window - gram, winnow(hashes, words.first, gram, window), hashes))
    short = sorted({int(n) for n in sizes if 0 < n < window}) if lengths is None else lengths
    for length in short:
        whole = grams(words.hashes, length)
        fits = np.repeat(words.first[1:], sizes)[: len(whole)] - np.arange(len(whole)) >= length
        if lengths is None:
            fits &= np.repeat(sizes, sizes)[: len(whole)] == length
        runs.append((length, 0, np.flatnonzero(fits), ~whole))
    for length, reach, kept, values in runs:
        if table is not None:
            shift = np.uint64(64 - int(table.size).bit_length() - 2)
            bit = values[kept] >> shift
            kept = kept[(table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7))) & 1 > 0]
        owner = np.searchsorted(words.first, kept, side="right") - 1
        for at, text in zip(kept.tolist(), owner.tolist()):
            low, high = int(words.first[text]), int(words.first[text + 1])
            begin, end = max(low, at - reach), min(high, at + length + reach)
            found[text].append(
                (int(values[at].view(np.int64)), at - low, at - begin, words.text(begin, end))
            )
    return sizes, found


def _scan(keys: list[str], gram: int, window: int, lengths: list[int] | None, shared=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if shared is None else shared.value
        kind = pa.list_(
            pa.struct(
                [("hash", pa.int64()), ("at", pa.int32()), ("back", pa.int32()), ("words", pa.string())]
            )
        )
        names = ["hash", "at", "back", "words"]
        for batch in blocks(batches, "text"):
            sizes, found = fingerprints(batch.column("text"), gram, window, lengths, table)
            prints = pa.array([[dict(zip(names, x)) for x in rows] for rows in found], kind)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(sizes.astype(np.int64)), prints],
                [*keys, "n_words", "prints"],
            )

    return run


def bit_table(spark: SparkSession, prints: DataFrame):
    """A broadcast bit table with the leading bits of each hash of ``prints`` set.

    Its size follows the number of hashes up to 2**MAX_TABLE_BITS bits (16 MB); beyond, it only
    lets more documents' fingerprints through to the join.
    """
    rows = prints.count()
    bits = min(MAX_TABLE_BITS, max(16, (64 * rows).bit_length()))
    position = F.shiftrightunsigned(F.col("hash"), 64 - bits)
    cells = prints.groupBy(F.shiftright(position, 3).alias("cell")).agg(
        F.bit_or(F.expr(f"shiftleft(1, cast(shiftrightunsigned(hash, {64 - bits}) & 7 as int))")).alias("mask")
    )
    table = np.zeros(1 << (bits - 3), dtype=np.uint8)
    found = cells.toPandas()
    table[found["cell"].to_numpy(np.int64)] = found["mask"].to_numpy(np.uint8)
    return spark.sparkContext.broadcast(table)


def _reach(mine: Column, theirs: Column, at: Column, other: Column, step: int, most: Column) -> Column:
    """How many words in a row agree, going by ``step`` from two positions (from 1)."""
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(most, F.lit(1))),
        F.lit(0),
        lambda have, i: F.when(
            (have == i - 1)
            & (i <= most)
            & (F.try_element_at(mine, at + i * step) == F.try_element_at(theirs, other + i * step)),
            i,
        ).otherwise(have),
    )


def item_prints(items: DataFrame, item_id: str, gram: int, window: int) -> DataFrame:
    """Benchmark fingerprints: one row each with the list of items of that wording.

    Items of the same words are one entry, so repeated items add no hits. Null texts and texts
    without a word have none; a null id marks words but is listed nowhere.
    """
    source = items.select(F.col(item_id).cast("string").alias("item"), F.col("text"))
    scanned = source.mapInArrow(
        _scan(["item", "text"], gram, window, None),
        f"item string, text string, n_words bigint, prints {PRINTS}",
    ).where("n_words > 0")
    wording = F.array_join(
        F.regexp_extract_all(
            F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
            F.lit(0),
        ),
        " ",
    )
    return (
        scanned.groupBy(F.sha2(wording, 256).alias("wording"))
        .agg(
            F.collect_set("item").alias("items"),
            F.first("n_words").alias("n_item"),
            F.first("prints").alias("prints"),
        )
        .select("wording", "items", "n_item", F.explode("prints").alias("print"))
        .select("wording", "items", F.least("n_item", F.lit(window)).alias("need"), "print.*")
    )


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    gram: int = GRAM,
    window: int = WINDOW,
) -> DataFrame:
    """``_row, doc_id, n_words, n_hit, hits, items``, one row per row of ``docs``.

    ``hits`` lists the hit word ranges (low, high), high exclusive, merged where they touch;
    ``items`` the ids of items with an occurring window, sorted as text. ``_row`` is the number
    that :func:`tables.numbered` gives the row, so documents that share an id stay apart. Null
    texts have no words; an empty table gives no rows; other columns are ignored. ``docs`` must
    be a plain scan of files.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    prints = materialize(item_prints(items, item_id, gram, window), "benchmark-prints")
    lengths = [r[0] for r in prints.where(F.col("need") < window).select("need").distinct().collect()]
    table = bit_table(spark, prints.select("hash"))
    source = numbered(docs, F.col(doc_id).alias("doc_id"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    scanned = materialize(
        source.mapInArrow(
            _scan(["_row", "doc_id"], gram, window, sorted(lengths), table),
            f"_row bigint, doc_id {kind}, n_words bigint, prints {PRINTS}",
        ),
        "document-prints",
    )
    seen = scanned.select("_row", F.explode("prints").alias("d")).select("_row", "d.*")
    pairs = seen.join(
        prints.select(
            "hash", "wording", "need", F.col("back").alias("other"), F.col("words").alias("theirs")
        ),
        "hash",
    )
    mine, theirs = F.split("words", " "), F.split("theirs", " ")
    core = F.when(F.col("need") < window, F.col("need")).otherwise(F.lit(gram)).cast("int")
    left = _reach(mine, theirs, F.col("back") + 1, F.col("other") + 1, -1, F.least("back", "other"))
    right = _reach(
        mine,
        theirs,
        F.col("back") + core,
        F.col("other") + core,
        1,
        F.least(F.size(mine) - F.col("back"), F.size(theirs) - F.col("other")) - core,
    )
    same = F.slice(mine, F.col("back") + 1, core) == F.slice(theirs, F.col("other") + 1, core)
    runs = (
        pairs.where(same)
        .select(
            "_row",
            "wording",
            "need",
            (F.col("at") - left).alias("low"),
            (F.col("at") + core + right).alias("high"),
        )
        .where("high - low >= need")
    )
    runs = materialize(runs.distinct(), "contaminated-runs")
    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("low", "high"))),
        F.expr("cast(array() as array<struct<low:int,high:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["high"] >= x["low"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["low"].alias("low"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["high"], x["high"]).alias("high"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    spans = runs.select("_row", "low", "high").distinct().groupBy("_row").agg(merged.alias("hits"))
    names = prints.select("wording", "items").distinct()
    listed = (
        runs.select("_row", "wording")
        .distinct()
        .join(names, "wording")
        .groupBy("_row")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )
    empty = F.expr("cast(array() as array<struct<low:int,high:int>>)")
    return (
        scanned.select("_row", "doc_id", "n_words")
        .join(spans, "_row", "left")
        .join(listed, "_row", "left")
        .select(
            "_row",
            "doc_id",
            "n_words",
            F.aggregate(
                F.coalesce("hits", empty),
                F.lit(0).cast("bigint"),
                lambda sum_, x: sum_ + (x["high"] - x["low"]).cast("bigint"),
            ).alias("n_hit"),
            F.coalesce("hits", empty).alias("hits"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )


def contaminated() -> Column:
    """At least one in twenty of a document's words lies in a benchmark window."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of every document against the whole benchmark."""
    found = find_contamination(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


ORACLE = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n,
           array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
          FROM items WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM item_windows
), doc_windows AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths WHERE len(w) >= n)
), hits AS (
    SELECT d.doc_id, d.n, d.i, m.item_id
    FROM doc_windows d JOIN item_windows m ON d.n = m.n AND d.gram = m.gram
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
    FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLES = {"op2_decontaminate": ORACLE}
