"""Near-duplicate detection by consistent weighted sampling over TF-IDF shingles.

Shingles are runs of five words (a shorter text is one shingle). A shingle weighs its count in
the text times ``1 + IDF_SHARE * ln((1+N)/(1+df)) / ln(1+N)``: its inverse document frequency,
scaled to a bounded range so that a shingle of a text copied thousands of times still counts
and copies stay similar however many there are. Document frequencies are counted over all documents in
``FREQUENCY_BINS`` hashed bins.

Improved consistent weighted sampling draws ``BANDS * BAND_ROWS`` samples per text; two texts
agree in one with a probability equal to their weighted Jaccard similarity. Texts that agree in
all samples of a band meet, and are linked if their exact weighted Jaccard similarity reaches
``SIMILARITY``. Classes are the connected components of links; exact copies (same words in the
same order) count as one text throughout.

Scale: texts are read where they lie and only those in a candidate pair are moved. A band of up
to ``TOGETHER`` texts is compared pair by pair. Every text of a larger one is first compared with
``PICKS`` of them, those that meet most other texts in all their bands, which among changed
copies of one original are the least changed ones. Where that leaves a large band with more than
one class, its texts are joined exactly: two similar texts share one of their rarest shingles, up
to a fifth of the weight of each (prefix filter), and what comes before the first such shingle in
both leaves room for the similarity (positional filter). So two texts that share a band are
compared, ruled out by a bound, or in one class already. A group of exact copies is one row from
the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta.llm.graph import components
from folianta.llm.tables import numbered, small
from folianta.llm.words import Words, blocks, bound_batches, grams, mix, powers, split_words
from folianta.storage import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 10, 3
FREQUENCY_BINS = 1 << 19
IDF_SHARE = 0.25
CHUNK = 4096  # bins in one row of counts, and shingles sampled at a time
PICKS = 6
TOGETHER = 16  # texts of a band that are compared pair by pair
SLACK = 1e-6  # left to rounding by bounds on a similarity

_U64 = np.uint64
_SAMPLES = mix(np.arange(1, 2 * BANDS * BAND_ROWS + 1, dtype=_U64) * _U64(0xD1342543DE82EF95))


def shingle_sets(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct shingle hashes, sorted, and how often each occurs."""
    every = grams(words.hashes, SHINGLE)
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= SHINGLE:
            mine = every[low : high - SHINGLE + 1]
        elif high > low:
            mine = grams(words.hashes[low:high], high - low)
        else:
            mine = every[:0]
        yield np.unique(mine, return_counts=True)


def _bins(shingles: np.ndarray) -> np.ndarray:
    return (shingles & _U64(FREQUENCY_BINS - 1)).astype(np.int64)


def sequence_digests(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's words in order."""
    count = len(words.hashes)
    found = []
    for values in (words.hashes, mix(words.hashes ^ _U64(0xA5A5A5A5A5A5A5A5))):
        sums = np.zeros(count + 1, dtype=_U64)
        base = 0x2545F4914F6CDD1D
        np.cumsum(values * powers(base, count), out=sums[1:])
        low, high = words.first[:-1], words.first[1:]
        inverse = powers(pow(base, -1, 1 << 64), count + 1)
        found.append(mix((sums[high] - sums[low]) * inverse[low] + (high - low).astype(_U64)).view(np.int64))
    return found[0], found[1]


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their digests, and at the end of the task its document frequencies."""
    names = ["_row", "high", "low", "missing", "chunk", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
    total = np.zeros(FREQUENCY_BINS, dtype=np.int32)
    for batch in blocks(batches, "text"):
        words = split_words(batch.column("text"))
        for shingles, _ in shingle_sets(words):
            np.add.at(total, _bins(shingles), 1)
        high, low = sequence_digests(words)
        nothing = [pa.nulls(batch.num_rows, kind) for kind in kinds[4:]]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), pa.array(high), pa.array(low), batch.column("text").is_null(), *nothing],
            names,
        )
    chunks = [i for i in range(FREQUENCY_BINS // CHUNK) if total[i * CHUNK : (i + 1) * CHUNK].any()]
    packed = [total[i * CHUNK : (i + 1) * CHUNK].astype(np.int64).tobytes() for i in chunks]
    yield pa.RecordBatch.from_arrays(
        [*(pa.nulls(len(chunks), kind) for kind in kinds[:4]), pa.array(chunks, kinds[4]), pa.array(packed, kinds[5])],
        names,
    )


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each chunk added up; holds one sum per chunk, however many tasks sent counts."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            counts = np.frombuffer(packed.as_buffer(), dtype=np.int64)
            sums[chunk] = sums[chunk] + counts if chunk in sums else counts
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
        ["chunk", "counts"],
    )


def shingle_weights(packed: DataFrame, rows: int) -> np.ndarray:
    """Weight of one occurrence of a shingle, by bin, from ``chunk, counts`` of all tasks."""
    sums = packed.repartition("chunk").mapInArrow(_sum_counts, "chunk int, counts binary")
    seen = np.zeros((FREQUENCY_BINS // CHUNK, CHUNK), dtype=np.int64)
    for row in sums.collect():  # one row a chunk
        seen[row["chunk"]] = np.frombuffer(row["counts"], dtype=np.int64)
    scale = np.log(1 + max(rows, 1))
    rare = np.log((1 + rows) / (1 + np.minimum(seen.ravel(), rows))) / scale
    return (1 + IDF_SHARE * rare).astype(np.float32)


def samples(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A hash of each consistent weighted sample of one set of weighted shingles.

    The sample of hash function j is the shingle x and level t with the least
    ``ln c - r (t - b) - r``, where r and c are Gamma(2, 1), b is uniform, all three functions of
    x and j, and t is ``floor(ln(weight) / r + b)``.
    """
    count = BANDS * BAND_ROWS
    best = np.full(count, np.inf, dtype=np.float32)
    chosen = np.zeros(count, dtype=_U64)
    logs = np.log(weights).astype(np.float32)
    for at in range(0, len(shingles), CHUNK):
        x, lw = shingles[None, at : at + CHUNK], logs[None, at : at + CHUNK]
        one, two = mix(x + _SAMPLES[:count, None]), mix(x + _SAMPLES[count:, None])
        unit = np.float32(2**-24)

        def uniform(bits, shift):
            return (((bits >> _U64(shift)) & _U64(0xFFFFFF)).astype(np.float32) + np.float32(0.5)) * unit

        r = np.maximum(-np.log(uniform(one, 40) * uniform(one, 16)), np.float32(1e-6))
        c = np.maximum(-np.log(uniform(two, 40) * uniform(two, 16)), np.float32(1e-12))
        b = ((two & _U64(0xFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2**-16)
        t = np.floor(lw / r + b)
        a = np.log(c) - r * (t - b) - r
        least = a.argmin(axis=1)
        pick = np.arange(count)
        value = a[pick, least]
        level = t[pick, least].astype(np.int64).view(_U64)
        print_ = mix(shingles[at + least] ^ (mix(level) + pick.astype(_U64)))
        better = value < best
        best[better], chosen[better] = value[better], print_[better]
    return chosen


def band_keys(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One hash per band of a text's samples."""
    rows = samples(shingles, weights).reshape(BANDS, BAND_ROWS)
    keys = np.arange(1, BANDS + 1, dtype=_U64)
    for i in range(BAND_ROWS):
        keys = mix(keys * _U64(0x9E3779B97F4A7C15) + rows[:, i])
    return keys.view(np.int64)


def _bands(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for batch in blocks(batches, "text"):
            keys, totals = [], []
            for shingles, counts in shingle_sets(split_words(batch.column("text"))):
                weights = counts * weight[_bins(shingles)]
                totals.append(float(weights.sum()))
                keys.append(band_keys(shingles, weights) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(totals, pa.float64()), pa.array(keys, pa.list_(pa.int64()))],
                ["_row", "total", "keys"],
            )

    return run


def weighted_jaccard(one: tuple, two: tuple, weight: np.ndarray) -> float:
    """Similarity of two (distinct shingles, counts): shared weight over joint weight."""
    _, mine, theirs = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    each = weight[_bins(one[0][mine])].astype(np.float64)
    shared = (np.minimum(one[1][mine], two[1][theirs]) * each).sum()
    joint = sum((counts * weight[_bins(s)].astype(np.float64)).sum() for s, counts in (one, two)) - shared
    return float(shared / joint) if joint else 1.0


def _verify(shared, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for batch in blocks(batches, "mine"):
            ones = shingle_sets(split_words(batch.column("mine")))
            twos = shingle_sets(split_words(batch.column("theirs")))
            near = [weighted_jaccard(x, y, weight) >= similarity for x, y in zip(ones, twos)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return run


def _members(sampled: DataFrame) -> DataFrame:
    """``key, _row, total, fame, met`` of texts in bands that others share.

    ``fame`` counts the texts that a text meets in all its bands, ``met`` those of the band.
    """
    rows = sampled.select("_row", "total", F.explode("keys").alias("key"))
    shared = materialize(rows.groupBy("key").agg(F.count("*").alias("met")).where("met > 1"), "shared-bands")
    rows = materialize(rows.join(small(shared, 32), "key"), "band-rows")
    fame = rows.groupBy("_row").agg(F.sum("met").alias("fame"))
    return materialize(rows.join(fame, "_row").select("key", "_row", "total", "fame", "met"), "band-members")


def _candidates(members: DataFrame) -> DataFrame:
    """All pairs of small bands and members of large ones with picked texts, as (a, b), once each.

    Picked are the text of most fame and, of the others, dealt to lanes by hash, those of most
    fame in each lane. Pairs whose total weights alone rule out the similarity are left out.
    """
    entry = F.struct(F.col("_row").alias("b"), F.col("total").alias("other"))
    rank = F.struct("fame", -F.col("_row"))
    lane = F.pmod(F.xxhash64("_row", "key"), F.lit(PICKS - 1))
    lanes = [F.max_by(entry, F.when(lane == i, rank)) for i in range(PICKS - 1)]
    crowded = F.col("met") > TOGETHER
    picks = members.where(crowded).groupBy("key").agg(
        F.array_distinct(F.array_compact(F.array(F.max_by(entry, rank), *lanes))).alias("picks")
    )
    every = members.where(~crowded).groupBy("key").agg(F.collect_list(entry).alias("picks"))
    fits = F.filter(
        "picks",
        lambda x: F.when(crowded, x["b"] != F.col("_row")).otherwise(x["b"] > F.col("_row"))
        & (F.least("total", x["other"]) >= (SIMILARITY - SLACK) * F.greatest("total", x["other"])),
    )
    return (
        members.join(small(materialize(picks.unionAll(every), "picked-texts"), 400), "key")
        .select(F.col("_row").alias("a"), F.explode(fits).alias("x"))
        .select(F.least("a", "x.b").alias("a"), F.greatest("a", "x.b").alias("b"))
        .distinct()
    )


def rarest(shingles: np.ndarray, counts: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Shingles, rarest first, of which similar texts share one; the weight before each; all weight.

    All shared weight lies from the first shared shingle on and is ``SIMILARITY`` of the whole.
    """
    each = weight[_bins(shingles)].astype(np.float64)
    order = np.lexsort((shingles, -each))
    weights = (counts * each)[order]
    before = np.cumsum(weights) - weights
    total = float(weights.sum())
    kept = total - before >= (SIMILARITY - SLACK) * total
    return shingles[order[kept]], before[kept], total


def _rarest(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for batch in blocks(batches, "text"):
            found = [rarest(*x, weight) for x in shingle_sets(split_words(batch.column("text")))]
            at = pa.array(np.repeat(np.arange(len(found)), [len(x[0]) for x in found]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row").take(at),
                    batch.column("root").take(at),
                    pa.array(np.concatenate([x[0] for x in found]).view(np.int64)),
                    pa.array(np.concatenate([x[1] for x in found])),
                    pa.array(np.array([x[2] for x in found])[at.to_numpy()]),
                ],
                ["_row", "root", "shingle", "before", "total"],
            )

    return run


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``_row, root`` of texts in large bands that hold more than one class of ``roots``."""
    crowded = materialize(
        members.where(F.col("met") > TOGETHER)
        .join(small(roots, 32), "_row", "left")
        .select("key", "_row", F.coalesce("root", "_row").alias("root")),
        "crowded-bands",
    )
    mixed = crowded.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    mixed = materialize(mixed.select("key"), "mixed-bands")
    return materialize(crowded.join(small(mixed, 16), "key").select("_row", "root").distinct(), "unsettled-texts")


def _prefix_pairs(texts: DataFrame, unsettled: DataFrame, weight) -> DataFrame:
    """Pairs (a, b) of different classes that no bound rules out, each once."""
    entries = materialize(
        texts.join(small(unsettled, 32), "_row").mapInArrow(
            _rarest(weight), "_row bigint, root bigint, shingle bigint, before double, total double"
        ),
        "rare-shingles",
    )
    mixed = entries.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    mixed = materialize(mixed.select("shingle"), "mixed-shingles")
    met = materialize(entries.join(small(mixed, 16), "shingle"), "met-shingles")
    one, two = (met.select("shingle", *[F.col(c).alias(f"{c}{i}") for c in ("_row", "root", "before", "total")]) for i in (1, 2))
    least = SIMILARITY / (1 + SIMILARITY) * (F.col("total1") + F.col("total2"))
    room = F.least(F.col("total1") - F.col("before1"), F.col("total2") - F.col("before2"))
    return (
        one.join(two.withColumnRenamed("shingle", "other"), (F.col("shingle") == F.col("other")) & (F.col("root1") < F.col("root2")) & (room >= (1 - SLACK) * least))
        .select(F.col("_row1").alias("a"), F.col("_row2").alias("b"))
        .distinct()
    )


def _links(texts: DataFrame, pairs: DataFrame, weight) -> DataFrame:
    """Those of ``pairs`` that are similar."""
    involved = materialize(
        pairs.select(F.col("a").alias("_row")).unionAll(pairs.select("b")).distinct(), "involved"
    )
    wanted = materialize(texts.join(small(involved, 16), "_row", "left_semi"), "candidate-texts")
    return (
        pairs.join(wanted.select(F.col("_row").alias("a"), F.col("text").alias("mine")), "a")
        .join(wanted.select(F.col("_row").alias("b"), F.col("text").alias("theirs")), "b")
        .mapInArrow(_verify(weight, SIMILARITY), "a bigint, b bigint")
    )


def classes(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``_row, doc_id, root, class_id``, one row per row of ``docs``.

    ``root`` is the first row of a row's class and ``class_id`` its id. Texts without a word are
    copies of each other; null texts are each a class of their own. Repeated rows and ids are
    separate members. An empty table gives no rows; other columns are ignored. ``docs`` must be
    a plain scan of files, as its rows are known by their place there.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    source = numbered(docs, F.col(doc_id).alias("doc_id"), "text")
    texts = source.select("_row", "text")
    profile = materialize(
        texts.mapInArrow(
            _profile, "_row bigint, high bigint, low bigint, missing boolean, chunk int, counts binary"
        ),
        "shingle-profile",
    )
    digests = profile.where("_row IS NOT NULL").select(
        "_row", F.when(F.col("missing"), F.col("_row")).otherwise(F.col("high")).alias("high"), "low", "missing"
    )
    same = materialize(
        digests.groupBy("high", "low", "missing")
        .agg(F.min("_row").alias("rep"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "copied-texts",
    )
    copies = materialize(
        digests.join(small(same, 64), ["high", "low", "missing"], "left").select(
            "_row", F.coalesce("rep", "_row").alias("rep")
        ),
        "exact-copies",
    )
    weight = spark.sparkContext.broadcast(
        shingle_weights(profile.where("chunk IS NOT NULL").select("chunk", "counts"), copies.count())
    )
    sampled = materialize(
        texts.mapInArrow(_bands(weight), "_row bigint, total double, keys array<bigint>"), "bands"
    )
    repeated = copies.where("_row <> rep").select("_row")
    members = _members(sampled.join(small(repeated, 16), "_row", "left_anti"))
    pairs = materialize(_candidates(members), "candidates")
    roots = components(_links(texts, pairs, weight)).withColumnRenamed("node", "_row")
    unsettled = _unsettled(members, roots)
    if not unsettled.isEmpty():
        rest = materialize(_prefix_pairs(texts, unsettled, weight), "prefix-candidates")
        links = roots.select(F.col("_row").alias("a"), F.col("root").alias("b")).unionAll(_links(texts, rest, weight))
        roots = components(links).withColumnRenamed("node", "_row")
    placed = copies.join(small(roots.withColumnRenamed("_row", "rep"), 32), "rep", "left").select(
        "_row", F.coalesce("root", "rep").alias("root")
    )
    named = source.select("_row", "doc_id")
    members = materialize(named.join(placed, "_row"), "near-classes")
    firsts = members.where("_row <> root").select("root").distinct()
    firsts = named.join(small(materialize(firsts, "shared-roots"), 16), F.col("_row") == F.col("root"), "left_semi")
    firsts = materialize(firsts.select(F.col("_row").alias("root"), F.col("doc_id").alias("class_id")), "class-ids")
    return members.join(small(firsts, 48), "root", "left").select(
        "_row", "doc_id", "root", F.when(F.col("_row") == F.col("root"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document; ``kept`` marks the one that stays."""
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "class_id", (F.col("_row") == F.col("root")).alias("kept"))


QUERIES = {"op10_near_duplicates": op10_near_duplicates}
ORACLES: dict[str, str] = {}
