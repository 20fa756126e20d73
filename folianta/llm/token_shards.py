"""Token shards in training order.

Documents become token ids, followed by an end mark, cut into sequences of ``LENGTH`` ids.
Sequences are counted in the order of document id; a keyed Feistel permutation of that count
gives each its global slot. It is a permutation of the next larger power of four, applied again
as long as it leads outside the number of sequences (cycle-walking), so slots are dense and a
slot is found from key, count and place alone. Slots are dealt to tasks by range, and each
task writes shards of ``SHARD`` sequences at a fixed stride: sequence ``s`` lies in shard
``s // SHARD`` at byte ``s % SHARD * stride``. A reader that stopped at any slot goes on from it.

Scale: texts never move. Token ids are written once, because the number of sequences must be
known before the first slot is, and shuffled once, by slot. Encoding remembers the ids of words
it has seen, up to ``REMEMBERED`` per worker.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianta.llm.tables import small
from folianta.llm.words import blocks, bound_batches, mix
from folianta.storage import materialize, shared_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed values of that vocabulary: its pattern of pieces and the id left for the end mark.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256

LENGTH = 512
SHARD = 1024
KEY = 20240517
ROUNDS = 6
HEADER = 4  # bytes before the ids of a sequence: how many of them are its own
REMEMBERED = 200_000
TASK_BYTES = 32 << 20

_encoders: dict[int, object] = {}


class WordIds(dict):
    """Ids, as bytes, of a word with the space before it, encoded when first asked for."""

    def __init__(self, encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = np.array(self.encoding.encode_ordinary(" " + word), dtype="<u2").tobytes()
        self[word] = ids
        return ids


# A space before another space or a line end may belong to the piece that follows it.
_LOOSE_SPACE = re.compile(r" (?:\s|$)")


def encode(text: str, words: WordIds) -> bytes:
    """Ids of ``text``, two bytes each: those of the whole text at once, found word by word.

    No piece of the pattern spans a change from another character to a space, so a text whose
    spaces all stand single between words has the ids of its words in a row. Other texts are
    encoded as they are.
    """
    if _LOOSE_SPACE.search(text) or text[:1] == " ":
        return np.array(words.encoding.encode_ordinary(text), dtype="<u2").tobytes()
    head, _, rest = text.partition(" ")
    ids = np.array(words.encoding.encode_ordinary(head), dtype="<u2").tobytes()
    return ids + b"".join([words[word] for word in rest.split(" ")]) if rest else ids


def _encoder(ranks: bytes) -> WordIds:
    """The worker's encoder of a vocabulary, built once."""
    key = hash(ranks)
    if key not in _encoders:
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        _encoders[key] = WordIds(
            tiktoken.Encoding(
                "words",
                pat_str=PIECES,
                mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
                special_tokens={},
            )
        )
    return _encoders[key]


def _tokenize(ranks, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _encoder(ranks.value)
        end = np.array([END], dtype="<u2").tobytes()
        for batch in blocks(batches, "text"):
            row, part, tokens = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if text:
                    ids = encode(text, words) + end
                    cuts = range(0, len(ids), 2 * length)
                    tokens += [ids[at : at + 2 * length] for at in cuts]
                    part += range(len(cuts))
                    row += [i] * len(cuts)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row").take(take),
                    batch.column("doc_id").take(take),
                    pa.array(part, pa.int32()),
                    pa.array(tokens, pa.binary()),
                ],
                ["_row", "doc_id", "part", "tokens"],
            )

    return run


def permuted(places: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """The slot of each place: a keyed permutation of 0 to ``count - 1``."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mix(np.array([key], dtype=np.uint64)))
    slots = places.astype(np.uint64)
    outside = np.ones(len(slots), dtype=bool)
    while outside.any():
        left, right = slots[outside] >> shift, slots[outside] & mask
        for round_key in keys:
            left, right = right, left ^ (mix(right + round_key) & mask)
        slots[outside] = (left << shift) | right
        outside = slots >= np.uint64(count)
    return slots.astype(np.int64)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences before each document within its range, and the range's number."""
    before = 0
    for batch in batches:
        sizes = batch.column("parts").to_numpy()
        upto = before + np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("range"), pa.array(upto - sizes), pa.array(upto)],
            ["_row", "range", "before", "upto"],
        )
        before = int(upto[-1]) if len(upto) else before


def first_places(sequences: DataFrame) -> DataFrame:
    """``_row, first``: how many sequences come before each document in the order of its id."""
    docs = sequences.groupBy("_row", "doc_id").agg(F.count("*").alias("parts"))
    ranged = (
        docs.repartitionByRange(F.col("doc_id").asc_nulls_last(), "_row")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "_row")
        .select("_row", "parts", F.spark_partition_id().alias("range"))
    )
    ranges = materialize(
        ranged.mapInArrow(_running, "_row bigint, range int, before bigint, upto bigint"), "sequence-ranges"
    )
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    ahead = (
        ranges.groupBy("range")
        .agg(F.max("upto").alias("held"))
        .select("range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("ahead"))
    )
    return ranges.join(F.broadcast(ahead), "range").select("_row", (F.col("ahead") + F.col("before")).alias("first"))


def _assemble(length: int):
    """Whole shards from rows that come in the order of their slots."""
    stride = HEADER + 2 * length

    def shard(rows: list[tuple[int, int, bytes]]) -> dict:
        data = np.full((len(rows), stride // 2), END, dtype="<u2")
        for at, (_, _, tokens) in enumerate(rows):
            ids = np.frombuffer(tokens, dtype="<u2")
            data[at, :2] = len(ids) & 0xFFFF, len(ids) >> 16
            data[at, 2 : 2 + len(ids)] = ids
        return {
            "shard": rows[0][0] // SHARD,
            "first_slot": rows[0][0],
            "sequences": len(rows),
            "stride": stride,
            "doc_ids": [doc for _, doc, _ in rows],
            "data": data.tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        for batch in batches:
            schema = pa.schema(
                [
                    ("shard", pa.int64()),
                    ("first_slot", pa.int64()),
                    ("sequences", pa.int32()),
                    ("stride", pa.int32()),
                    ("doc_ids", pa.list_(batch.schema.field("doc_id").type)),
                    ("data", pa.binary()),
                ]
            )
            done = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("slot", "doc_id", "tokens"))):
                if held and held[0][0] // SHARD != row[0] // SHARD:
                    done.append(shard(held))
                    held = []
                held.append(row)
            yield pa.RecordBatch.from_pylist(done, schema)
        if held:
            yield pa.RecordBatch.from_pylist([shard(held)], schema)

    return run


def token_shards(
    docs: DataFrame,
    doc_id: str = "doc_id",
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    key: int = KEY,
) -> DataFrame:
    """``shard, first_slot, sequences, stride, doc_ids, data``, one row per shard.

    ``data`` holds the sequences of the shard at a fixed stride: four bytes that say how many
    ids are its own, then ``length`` ids of two bytes, filled up with end marks; ``doc_ids``
    their documents. All but the last shard hold ``SHARD`` sequences. Null and empty texts have
    no sequence, repeated rows have theirs each, and an empty table gives no shard. ``docs``
    must be a plain scan of files, whose row numbers do not change between reads.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    ranks = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())
    source = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).alias("doc_id"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    path = shared_dir(spark, "sequences")
    source.mapInArrow(
        _tokenize(ranks, length), f"_row bigint, doc_id {kind}, part int, tokens binary"
    ).write.option("compression", "zstd").parquet(path)
    sequences = spark.read.parquet(path)
    count = sequences.count()
    places = materialize(first_places(sequences.select("_row", "doc_id")), "first-places")

    @F.pandas_udf("bigint")
    def slot_of(place):
        return place.__class__(permuted(place.to_numpy(), count, key))

    tasks = max(1, spark.sparkContext.defaultParallelism, count * (HEADER + 2 * length) // TASK_BYTES)
    shards = -(-count // SHARD) or 1
    slotted = sequences.join(small(places, 24), "_row").select(
        slot_of(F.col("first") + F.col("part")).alias("slot"), "doc_id", "tokens"
    )
    dealt = slotted.repartitionById(
        min(tasks, shards), F.expr(f"cast(slot div {SHARD} * {min(tasks, shards)} div {shards} as int)")
    )
    return dealt.sortWithinPartitions("slot").mapInArrow(
        _assemble(length),
        f"shard bigint, first_slot bigint, sequences int, stride int, doc_ids array<{kind}>, data binary",
    )


def read_sequences(shards: DataFrame, first: int, count: int) -> DataFrame:
    """``slot, tokens`` of ``count`` slots from ``first``; only shards that hold them are read."""
    last = first + count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                table = np.frombuffer(row["data"], dtype="<u2").reshape(row["sequences"], -1)
                for at in range(max(0, first - row["first_slot"]), min(len(table), last - row["first_slot"])):
                    own = int(table[at, 0]) + (int(table[at, 1]) << 16)
                    rows.append((row["first_slot"] + at, table[at, 2 : 2 + own].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int32()))],
                ["slot", "tokens"],
            )

    held = shards.where(F.col("shard").between(first // SHARD, max(first, last - 1) // SHARD))
    return held.select("first_slot", "sequences", "data").mapInArrow(run, "slot bigint, tokens array<int>")


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token shards in training order."""
    return token_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op8_token_shards": op8_token_shards}
ORACLES: dict[str, str] = {}
