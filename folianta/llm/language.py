"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams of 1 to 3 characters, hashed into ``BINS``
bins: a bin's share of the text's n-grams times its inverse document frequency, which is
counted over all training documents. The regression is fitted with follow-the-regularised-leader
under an elastic net, so that most weights are exactly zero, and its confidence is calibrated by
one temperature on training rows kept out of the fit.

Scale: reads of the table, no shuffle of texts. Document frequencies are summed per task
before they are shuffled, ``BINS`` numbers in all. The fit uses a bounded sample: the
``ROWS_PER_LANGUAGE`` distinct texts of each language with the least hashes, or all if it has
fewer, each once, as sparse feature vectors. Counting and prediction see every character of
every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianta.llm.words import blocks, bound_batches, mix, utf8

BINS = 1 << 16
WIDTHS = (1, 2, 3)
ROWS_PER_LANGUAGE = 600
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
SCALE = 20.0  # of features: shares of n-grams are small numbers
UNKNOWN = "und"
CONFIDENT = 0.4


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lowered characters of all texts in a row and where each text begins among them."""
    raw, offsets = utf8(pc.utf8_lower(texts))
    heads = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=heads[1:])
    codes = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    return codes, heads[offsets]


def gram_bins(codes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each width: the bin of the n-gram at each character, and which lie in one text."""
    size = len(codes)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(size)
    hashes = np.zeros(size, dtype=np.uint64)
    for width in range(1, max(WIDTHS) + 1):
        hashes[: size - width + 1] = hashes[: size - width + 1] * np.uint64(0x100000001B3) + codes[width - 1 :]
        if width in WIDTHS:
            bins = (mix(hashes + np.uint64(width)) & np.uint64(BINS - 1)).astype(np.int32)
            yield bins, left >= width


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct bins and each bin's share of its n-grams."""
    codes, first = _codes(texts)
    found = list(gram_bins(codes, first))
    for low, high in zip(first[:-1], first[1:]):
        every = np.concatenate([bins[low:high][fits[low:high]] for bins, fits in found])
        counts = np.bincount(every, minlength=BINS) if len(every) > BINS else None
        if counts is None:
            bins, counts = np.unique(every, return_counts=True)
        else:
            bins = np.flatnonzero(counts)
            counts = counts[bins]
        yield bins.astype(np.int32), counts / max(1, len(every))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(BINS, dtype=np.int64), 0
    marks = np.zeros(BINS, dtype=np.int64)
    for batch in blocks(batches, "text"):
        codes, first = _codes(batch.column("text"))
        found = list(gram_bins(codes, first))
        for low, high in zip(first[:-1], first[1:]):
            every = np.concatenate([bins[low:high][fits[low:high]] for bins, fits in found])
            marks[every] = np.arange(len(every))  # one place of each distinct bin keeps its mark
            total[every[marks[every] == np.arange(len(every))]] += 1
            rows += 1
    bins = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(bins, -1).astype(np.int32)), pa.array(np.append(total[bins], rows))],
        ["bin", "docs"],
    )


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents of ``texts`` that hold each bin, and how many there are."""
    counts = (
        texts.select("text")
        .mapInArrow(_count, "bin int, docs bigint")
        .groupBy("bin")
        .agg(F.sum("docs").alias("docs"))
        .toPandas()
    )
    found = np.zeros(BINS, dtype=np.int64)
    known = counts[counts["bin"] >= 0]
    found[known["bin"].to_numpy()] = known["docs"].to_numpy()
    return found, int(counts.loc[counts["bin"] < 0, "docs"].sum())


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        rows = list(features(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang"),
                batch.column("hash"),
                pa.array([bins for bins, _ in rows], pa.list_(pa.int32())),
                pa.array([shares.astype(np.float32) for _, shares in rows], pa.list_(pa.float32())),
            ],
            ["lang", "hash", "bins", "shares"],
        )


@dataclass
class LanguageModel:
    """``weights[bin, language]`` include the inverse document frequencies."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int
) -> np.ndarray:
    """Weights (bin, class) after ``EPOCHS`` passes over rows of (bins, values); last bin: bias."""
    z, n = np.zeros((BINS + 1, classes)), np.zeros((BINS + 1, classes))

    def leader(at):
        held = z[at]
        shrunk = np.sign(held) * np.maximum(np.abs(held) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(0)
    target = np.eye(classes)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            bins, values = rows[i]
            weights = leader(bins)
            step = values[:, None] * (_softmax(values @ weights) - target[labels[i]])
            square = step**2
            z[bins] += step - (np.sqrt(n[bins] + square) - np.sqrt(n[bins])) / ALPHA * weights
            n[bins] += square
    return leader(slice(None))


def temperature_of(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature under which ``labels`` are most likely, by golden-section search."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        chance = _softmax(scores / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(chance, 1e-12)).mean()

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    while high - low > 1e-3:
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, right) if loss(left) <= loss(right) else (left, high)
    return float(np.exp((low + high) / 2))


def least_hashes(hashed: DataFrame, most: int) -> dict[str, list[int]]:
    """The ``most`` least distinct values of ``hash`` of each ``lang``, all of one that has fewer.

    Tasks keep no more than that of each language before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, hashes = batch.column("lang").dictionary_encode(), batch.column("hash").to_numpy()
            codes = langs.indices.to_numpy()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                mine = np.concatenate([least.get(lang, hashes[:0]), hashes[codes == code]])
                least[lang] = np.unique(mine)[:most]
        for lang, found in least.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64())], ["lang", "hash"]
            )

    distinct = hashed.select("lang", "hash").mapInArrow(run, "lang string, hash bigint").distinct()
    nth = Window.partitionBy("lang").orderBy("hash")
    rows = distinct.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= most).collect()
    found: dict[str, list[int]] = {}
    for row in rows:
        found.setdefault(row["lang"], []).append(row["hash"])
    return found


def fit(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel | None:
    """A model of ``labelled`` (columns ``text, lang``); rows with a null in either are left out.

    None if no row is left. One language is learned as such.
    """
    texts = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    hashed = texts.select("text", "lang", F.xxhash64("text").alias("hash"))
    chosen = least_hashes(hashed, rows_per_language)
    if not chosen:
        return None
    docs, total = document_frequencies(texts)
    idf = np.log((1 + total) / (1 + docs)) + 1
    languages = sorted(chosen)
    last = F.coalesce(*[F.when(F.col("lang") == name, F.lit(max(chosen[name]))) for name in languages])
    wanted = hashed.where(F.col("hash") <= last).groupBy("lang", "hash").agg(F.min("text").alias("text"))
    sample = (
        wanted.select("text", "lang", "hash")
        .mapInArrow(_vectors, "lang string, hash bigint, bins array<int>, shares array<float>")
        .toPandas()
        .sort_values(["hash", "lang"], kind="stable")
    )
    rows = [
        (np.append(bins, BINS), np.append(np.asarray(shares, dtype=np.float64) * idf[bins] * SCALE, 1.0))
        for bins, shares in zip(sample["bins"], sample["shares"])
    ]
    labels = np.searchsorted(languages, sample["lang"].to_numpy(str))
    kept_out = sample.groupby("lang").cumcount().to_numpy() % 5 == 4  # never the only text of a language
    weights = follow_the_leader(
        [row for row, out in zip(rows, kept_out) if not out], labels[~kept_out], len(languages)
    )
    scores = np.array([rows[i][1] @ weights[rows[i][0]] for i in np.flatnonzero(kept_out)])
    return LanguageModel(
        languages,
        weights[:BINS] * idf[:, None] * SCALE,
        weights[BINS],
        temperature_of(scores, labels[kept_out]),
    )


def predict(docs: DataFrame, model: LanguageModel | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score`` of each whole text.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was learned. Equal
    scores go to the language that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = "text" if "text" in keep else "_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in blocks(batches, text):
            names = np.full(batch.num_rows, UNKNOWN, dtype=object)
            scores = np.zeros(batch.num_rows)
            if known:
                codes, first = _codes(batch.column(text))
                sums = np.zeros((batch.num_rows, len(known.languages)))
                grams = np.zeros(batch.num_rows)
                filled = np.flatnonzero(np.diff(first))
                for bins, fits in gram_bins(codes, first):
                    if len(filled):
                        values = known.weights[bins] * fits[:, None]
                        sums[filled] += np.add.reduceat(values, first[filled], axis=0)
                        grams[filled] += np.add.reduceat(fits.astype(np.int64), first[filled])
                chance = _softmax((sums / np.maximum(grams, 1)[:, None] + known.bias) / known.temperature)
                lettered = batch.column("_lettered").to_numpy(zero_copy_only=False).astype(bool)
                best = chance.argmax(axis=1)
                names[lettered] = np.array(known.languages, dtype=object)[best[lettered]]
                scores[lettered] = chance[np.arange(len(best)), best][lettered]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(names, pa.string()), pa.array(scores)],
                [*keep, "lang_pred", "score"],
            )

    source = docs.select(
        *keep,
        *([] if text in keep else [F.col("text").alias(text)]),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_lettered"),
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return source.mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(doc_id: str) -> Column:
    """A quarter of all documents by checksum of their id; never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: the id) of every row with ``held_out, lang_pred, score``.

    Learns from the rows outside the held-out quarter; prediction sees the text alone. A null id
    counts as not held out. Repeated rows are predicted alike; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    named = docs.withColumn("held_out", held_out(doc_id))
    model = fit(named.where("NOT held_out"))
    return predict(named, model, [*(keep or [doc_id]), "held_out"])


def rejected() -> Column:
    """No language, or none that the model is confident of."""
    return (F.col("lang_pred") == UNKNOWN) | (F.col("score") < CONFIDENT)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_language_id": op1_language_id}
ORACLES: dict[str, str] = {}
