"""Subword vocabularies learned from distributed word counts, and encoding with them.

Training never touches the corpus after the words are counted. Encoding is map-only: a
vocabulary has a fixed maximal size, so it is broadcast, and every task remembers the words
it has already cut instead of shuffling tokens to a table of distinct words.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.functions.text import pre_tokenize
from folianta.operators import positions
from folianta.operators.segment import (
    LONGEST_WORD,
    best_split,
    longest_match_split,
    merge_pieces,
    merge_split,
    unknown_score,
)
from folianta.storage import bounded_table, materialize, spread

Merge = tuple[int, int, int]  # left and right symbol, and what they become
UNKNOWN = "[UNK]"
REMEMBERED_WORDS = 200_000
ENCODED_ROWS = 1_000  # texts whose pieces are gathered at a time

# Training symbols are numbers: characters take their code point, characters inside a word a
# range of their own when they are marked by a prefix, and merged symbols follow.
INNER_BASE = 0x200000
MERGED_BASE = 0x400000
FIRST_PAIRS, MOST_PAIRS = 64, 8_192
MAX_SEGMENTS = 60_000
LONG_WORD = 64  # symbols


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)`` over all pre-tokens."""
    words = docs.select(F.explode(pre_tokenize(F.col(text))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def pair_counts(counts: DataFrame) -> DataFrame:
    """``(left, right, n)``: adjacent characters of the words, weighted by word count."""
    chars = F.split("word", "")
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("word") - 1),
        lambda at: F.struct(
            F.substring("word", at, F.lit(1)).alias("left"),
            F.substring("word", at + 1, F.lit(1)).alias("right"),
        ),
    )
    return (
        counts.filter(F.length("word") > 1)
        .select(F.explode(pairs).alias("pair"), "n")
        .groupBy("pair.left", "pair.right")
        .agg(F.sum("n").alias("n"))
    )


def frequency_vocabulary(counts: DataFrame, size: int) -> DataFrame:
    """``(token, id, n)``: the ``size`` most frequent words, ids from 0 in that order."""
    top = counts.orderBy(F.desc("n"), "word").limit(size)
    by_rank = Window.orderBy(F.desc("n"), "word")  # at most `size` rows are left here
    return top.select(
        F.col("word").alias("token"),
        (F.row_number().over(by_rank) - 1).cast("long").alias("id"),
        "n",
    )


def ranked_words(counts: DataFrame) -> DataFrame:
    """``(token, id, n)`` of all words in the order of :func:`frequency_vocabulary`."""
    counts = materialize(counts, "words")  # numbering reads its rows twice
    ranked = positions.number_rows(counts.withColumn("_less", -F.col("n")), ["_less", "word"], "id")
    return ranked.select(F.col("word").alias("token"), "id", "n")


@dataclass
class SubwordModel:
    """A learned vocabulary: tokens by id, with merges or scores if the kind has them."""

    kind: str
    tokens: list[str]
    merges: list[tuple[str, str]] = field(default_factory=list)
    scores: dict[str, float] = field(default_factory=dict)
    likelihoods: list[float] = field(default_factory=list)
    prefix: str = ""
    longest_word: int | None = LONGEST_WORD  # a longer one is unknown to the longest-match kind

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model below ``path``: tokens with ids and scores, merges in order, facts."""
        self.vocabulary(spark).write.parquet(f"{path}/tokens")
        merges = [(at, left, right) for at, (left, right) in enumerate(self.merges)]
        spark.createDataFrame(merges, "rank int, left string, right string").write.parquet(f"{path}/merges")
        facts = [(self.kind, self.prefix, self.longest_word, self.likelihoods)]
        schema = "kind string, prefix string, longest_word int, likelihoods array<double>"
        spark.createDataFrame(facts, schema).write.parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SubwordModel:
        """The model that :meth:`save` wrote; a vocabulary is of bounded size."""
        tokens = spark.read.parquet(f"{path}/tokens").orderBy("id").collect()
        merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        facts = spark.read.parquet(f"{path}/facts").first()
        return cls(
            facts["kind"],
            [row["token"] for row in tokens],
            [(row["left"], row["right"]) for row in merges],
            {row["token"]: row["score"] for row in tokens if row["score"] is not None},
            list(facts["likelihoods"]),
            facts["prefix"],
            facts["longest_word"],
        )

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        """``(token, id, score)``; scores are null unless the kind has them."""
        rows = [(token, at, self.scores.get(token)) for at, token in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "token string, id int, score double")

    def encode(self, spark: SparkSession, text: Column) -> Column:
        """``struct(tokens, ids)`` of a text column."""
        return self._encoder(spark)(pre_tokenize(text))

    def _cutter(self) -> Callable[[str], list[str]]:
        ids = {token: at for at, token in enumerate(self.tokens)}
        if self.kind == "bpe":
            ranks = {pair: at for at, pair in enumerate(self.merges)}
            return lambda word: [
                piece if piece in ids else UNKNOWN for piece in merge_split(word, ranks)
            ]
        if self.kind == "wordpiece":
            reach = max(map(len, ids), default=1)
            return lambda word: longest_match_split(
                word, ids, self.prefix, UNKNOWN, self.longest_word, reach
            )
        longest, floor = max(map(len, self.scores), default=1), unknown_score(self.scores)

        def cut(word: str) -> list[str]:
            pieces: list[str] = []
            for piece in best_split(word, self.scores, longest, floor)[0]:
                if piece in self.scores:
                    pieces.append(piece)
                elif not pieces or pieces[-1] != UNKNOWN:  # neighbouring unknowns are one
                    pieces.append(UNKNOWN)
            return pieces

        return cut

    def _coder(self) -> Callable[[Sequence[str]], list[bytes]]:
        """Ids of the pieces of many words at once, four bytes each; :meth:`_cutter` cuts alike."""
        ids = {token: at for at, token in enumerate(self.tokens)}
        find = {"bpe": _merge_coder, "wordpiece": _match_coder}.get(self.kind, _best_coder)(self, ids)

        def code(words: Sequence[str]) -> list[bytes]:
            if not words:
                return []
            found, sizes = find(words)
            data, ends = found.astype(np.int32).tobytes(), (4 * np.cumsum(sizes)).tolist()
            return [data[begin:end] for begin, end in zip([0, *ends], ends)]

        return code

    def _encoder(self, spark: SparkSession) -> Callable[[Column], Column]:
        shared = spark.sparkContext.broadcast(self)

        @F.arrow_udf("tokens array<string>, ids array<int>")
        def encode_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = shared.value
            tokens = pa.array(model.tokens, pa.string())
            code, known = model._coder(), {}
            for batch in batches:
                parts = []
                for begin in range(0, max(len(batch), 1), ENCODED_ROWS):
                    rows = batch.slice(begin, ENCODED_ROWS)
                    words = rows.flatten().dictionary_encode()
                    listed = words.dictionary.to_pylist()
                    new = [word for word in listed if word not in known]
                    fresh = dict(zip(new, code(new)))
                    coded = [fresh[word] if word in fresh else known[word] for word in listed]
                    known = _remembered(known, listed, coded)
                    found, sizes = _gathered(coded, words.indices.to_numpy())
                    begins = np.append(0, np.cumsum(rows.value_lengths().fill_null(0).to_numpy()))
                    offsets = pa.array(np.append(0, np.cumsum(sizes))[begins], pa.int32())
                    numbers = pa.array(found, pa.int32())
                    lists = [pa.ListArray.from_arrays(offsets, values) for values in (tokens.take(numbers), numbers)]
                    parts.append(pa.StructArray.from_arrays(lists, ["tokens", "ids"]))
                yield pa.concat_arrays(parts)

        # else a filter on the pieces would be pushed below and cut every text once more
        return encode_words.asNondeterministic()


def _remembered(
    known: dict[str, bytes], words: Sequence[str], coded: Sequence[bytes], most: int = REMEMBERED_WORDS
) -> dict[str, bytes]:
    """``known`` with ``words``; if these are too many the words that came up first, mostly frequent ones."""
    known.update(zip(words, coded))
    return known if len(known) <= most else dict(islice(zip(words, coded), most))


def _gathered(coded: Sequence[bytes], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, four bytes each, of ``coded`` at ``places`` in a row, and how many each place has."""
    numbers = np.frombuffer(b"".join(coded), np.int32)
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
    begins = (np.cumsum(sizes) - sizes)[places]
    sizes = sizes[places]
    before = np.cumsum(sizes) - sizes
    return numbers[np.repeat(begins - before, sizes) + np.arange(int(sizes.sum()))], sizes


def _chars(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row and the size of each word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return points, np.fromiter(map(len, words), np.int64, len(words))


def _walked(back: np.ndarray, place: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(word, step, place)`` of every place on each word's way along ``back`` to its ``goal``, by word.

    Where ``back`` is negative the way ends.
    """
    words, taken, step = np.flatnonzero(place != goal), [], 0
    place = place.copy()
    while len(words):
        at = place[words]
        taken.append((words, np.full(len(words), step), at))
        place[words] = back[at]
        words = words[(back[at] >= 0) & (back[at] != goal[words])]
        step += 1
    word, step, at = (np.concatenate([part[n] for part in taken] or [np.zeros(0, np.int64)]) for n in range(3))
    order = np.argsort(word, kind="stable")
    return word[order], step[order], at[order]


def _merge_coder(model: SubwordModel, ids: dict[str, int]):
    ranks = {pair: at for at, pair in enumerate(model.merges)}
    pairs = sorted(ranks, key=ranks.get)
    texts = sorted({text for left, right in pairs for text in (left, right, left + right)} | set(ids))
    number = {text: ord(text) if len(text) == 1 else MERGED_BASE + at for at, text in enumerate(texts)}
    merges = [(number[left], number[right], number[left + right]) for left, right in pairs]
    known = np.array(sorted(number[text] for text in ids), np.int64)
    id_of = {number[text]: at for text, at in ids.items()}
    named = np.array([id_of[at] for at in known.tolist()], np.int64)

    def find(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        symbols, sizes = _chars(words)
        if merges:
            symbols, sizes = merge_words(symbols, sizes, merges)
        at = np.minimum(np.searchsorted(known, symbols), len(known) - 1)
        missing = known[at] != symbols
        return np.where(missing, ids[UNKNOWN] if missing.any() else 0, named[at]), sizes

    return find


def _match_coder(model: SubwordModel, ids: dict[str, int]):
    begins = [text for text in ids if text]
    inners = [text for text in begins if text.startswith(model.prefix) and text != model.prefix]
    size_of_mark, longest = len(model.prefix), max(map(len, ids), default=1)
    trees = [PieceTree.of(begins), PieceTree.of([text[size_of_mark:] for text in inners])]
    numbers = [np.array([ids[text] for text in part], np.int64) for part in (begins, inners)]

    def find(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(sizes + 1) - sizes - 1
        follows = np.full(int((sizes + 1).sum()), -1)
        piece = np.full(len(follows), -1)
        for inner, (tree, number) in enumerate(zip(trees, numbers)):
            if not len(number):
                continue
            _, starts, ends, found, counts = tree.places(words, longest)
            offset = np.repeat(first, counts)
            chosen = (starts > 0) == bool(inner)
            at = (offset + starts)[chosen]  # the longest piece at a place comes last
            follows[at], piece[at] = (offset + ends)[chosen], number[found[chosen]]
        last = first + sizes
        tried = sizes <= (model.longest_word if model.longest_word is not None else sizes.max())
        word, _, at = _walked(follows, first, np.where(tried, last, first))
        unknown = ~tried
        unknown[word[piece[at] < 0]] = True
        if unknown.any():
            kept = ~unknown[word]
            word = np.append(word[kept], np.flatnonzero(unknown))
            found = np.append(piece[at[kept]], np.full(int(unknown.sum()), ids[UNKNOWN]))
        else:
            found = piece[at]
        order = np.argsort(word, kind="stable")
        return found[order], np.bincount(word, minlength=len(words))

    return find


def _best_coder(model: SubwordModel, ids: dict[str, int]):
    pieces = [text for text in model.scores if text]
    scores = np.array([model.scores[text] for text in pieces] + [unknown_score(model.scores)])
    numbers = np.array([ids[text] for text in pieces] + [-1], np.int64)
    tree, longest = PieceTree.of(pieces), max(map(len, pieces), default=1)

    def find(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes, starts, ends, found, counts = tree.places(words, longest)
        owner = np.repeat(np.arange(len(words)), counts)
        first = np.cumsum(sizes + 1) - sizes - 1
        last = first + sizes
        starts, ends = starts + first[owner], ends + first[owner]
        # a character without a piece of its own is an unknown one
        bare = np.ones(int((sizes + 1).sum()), dtype=bool)
        bare[starts[ends - starts == 1]] = False
        bare[last] = False
        at = np.flatnonzero(bare)
        owner = np.append(owner, np.searchsorted(last, at))
        starts, ends = np.append(starts, at), np.append(ends, at + 1)
        found = np.append(found, np.full(len(at), len(pieces)))
        order = np.argsort(starts, kind="stable")
        owner, starts, ends, found = owner[order], starts[order], ends[order], found[order]
        edges = _Edges(first, last, owner, starts, ends, found, scores[found])
        best = edges.along(np.maximum)
        good = best[starts] + edges.scores == best[ends]
        back, piece = np.full(len(bare), -1), np.full(len(bare), -1)
        back[ends[good]], piece[ends[good]] = starts[good], numbers[found[good]]  # of ties, the last start
        word, _, at = _walked(back, last, first)
        named, word = piece[at][::-1], word[::-1]  # the way leads from the end
        again = (named[1:] < 0) & (named[:-1] < 0) & (word[1:] == word[:-1])
        kept = ~np.append(False, again)[: len(named)]
        named, word = named[kept], word[kept]
        named = np.where(named < 0, ids[UNKNOWN] if (named < 0).any() else 0, named)
        order = np.argsort(word, kind="stable")
        return named[order], np.bincount(word, minlength=len(words))

    return find


# --- merge-based training ----------------------------------------------------------


def _symbol_table(counts: DataFrame, inner_base: int) -> DataFrame:
    symbols = F.transform(
        F.split("word", ""), lambda char, at: F.ascii(char) + F.when(at == 0, 0).otherwise(inner_base)
    )
    return counts.filter(F.length("word") > 1).select(symbols.alias("symbols"), "n")


def _pair_codes(symbols: np.ndarray) -> np.ndarray:
    return symbols[:-1] << 32 | symbols[1:]


def merge_words(
    symbols: np.ndarray, sizes: np.ndarray, merges: Sequence[Merge]
) -> tuple[np.ndarray, np.ndarray]:
    """Words, given as their ``symbols`` in a row and their ``sizes``, with ``merges`` applied.

    Each step merges the first of the earliest pairs in every word at once, as
    :func:`segment.merge_pieces` does word by word; words without a pair wait aside. That takes a
    step per merge, so words of more than ``LONG_WORD`` symbols are left to the heap.
    """
    codes = np.array([left << 32 | right for left, right, _ in merges], np.int64)
    order = np.argsort(codes)
    codes, news = codes[order], np.array([new for _, _, new in merges], np.int64)
    symbols, words = symbols.astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
    ended: list[tuple[np.ndarray, np.ndarray]] = []
    if len(sizes) and int(sizes.max()) > LONG_WORD:
        ranks = {(left, right): at for at, (left, right, _) in enumerate(merges)}
        names = {(left, right): new for left, right, new in merges}
        begins = np.cumsum(sizes) - sizes
        for word in np.flatnonzero(sizes > LONG_WORD):
            pieces = symbols[begins[word] : begins[word] + sizes[word]].tolist()
            pieces = np.array(merge_pieces(pieces, ranks, names.get), np.int64)
            ended.append((pieces, np.full(len(pieces), word)))
        short = (sizes <= LONG_WORD)[words]
        symbols, words = symbols[short], words[short]

    def ranked(places: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each place, if any."""
        after = np.minimum(places + 1, len(symbols) - 1)
        pairs = symbols[places] << 32 | symbols[after]
        at = np.minimum(np.searchsorted(codes, pairs), len(codes) - 1)
        hit = (codes[at] == pairs) & (words[places] == words[after]) & (places < after)
        return np.where(hit, order[at], len(codes))

    rank = ranked(np.arange(len(symbols)))
    while len(symbols):
        opens = np.flatnonzero(np.diff(words, prepend=-1))
        best = np.minimum.reduceat(rank, opens)
        lengths = np.diff(np.append(opens, len(words)))
        going = np.repeat(best < len(codes), lengths)
        ended.append((symbols[~going], words[~going]))
        chosen = np.flatnonzero(going & (rank == np.repeat(best, lengths)))
        first = chosen[np.flatnonzero(np.diff(words[chosen], prepend=-1))]
        symbols[first] = news[rank[first]]
        going[first + 1] = False
        symbols, words, rank = symbols[going], words[going], rank[going]
        # a merge changes the pair that it begins and the one before
        places = (np.cumsum(going) - 1)[first]
        places = np.append(places, places[places > 0] - 1)
        rank[places] = ranked(places)
    symbols, words = (np.concatenate([part[at] for part in ended] or [np.zeros(0, np.int64)]) for at in (0, 1))
    return symbols[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(sizes))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))


def _blobs(values: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """Lists of numbers, four bytes each, that Spark passes on as they are instead of one by one."""
    offsets = pa.array(4 * np.append(0, np.cumsum(sizes)), pa.int32())
    data = pa.py_buffer(np.ascontiguousarray(values, np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, offsets.buffers()[1], data])


def _opened(blobs: pa.BinaryArray) -> pa.ListArray:
    """The lists that :func:`_blobs` packed."""
    _, offsets, data = blobs.buffers()
    ends = np.frombuffer(offsets, np.int32)[blobs.offset : blobs.offset + len(blobs) + 1] // 4
    if data is None or not len(blobs):
        return _lists(np.zeros(0, np.int32), np.zeros(len(blobs), np.int64))
    numbers = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, data])
    return pa.ListArray.from_arrays(pa.array(ends), numbers)


def _merged(words: DataFrame, merges: Sequence[Merge]) -> DataFrame:
    """Words with ``merges`` applied; those that are one symbol now can merge no more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("symbols")
            rows = _lists(*merge_words(column.flatten().to_numpy(), column.value_lengths().to_numpy(), merges))
            kept = pa.array(np.flatnonzero(rows.value_lengths().to_numpy() > 1))
            yield pa.RecordBatch.from_arrays([rows.take(kept), batch.column("n").take(kept)], ["symbols", "n"])

    return words.mapInArrow(run, "symbols array<int>, n bigint")


def _top_pairs(words: DataFrame, min_count: int, most: int) -> list[tuple[int, int, int]]:
    """The ``most`` most frequent pairs as ``(-n, left, right)``, in the order of merging."""
    steps = F.size("symbols") - 1
    pairs = F.arrays_zip(F.slice("symbols", F.lit(1), steps), F.slice("symbols", F.lit(2), steps))
    rows = (
        words.select(F.inline(pairs).alias("left", "right"), "n")
        .groupBy("left", "right")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= min_count)
        .orderBy(F.desc("n"), "left", "right")
        .limit(most)
        .collect()
    )
    return [(-row["n"], row["left"], row["right"]) for row in rows]


def _segments(words: DataFrame, pairs: Sequence[tuple[int, int, int]], most: int) -> list[tuple[list[int], int]] | None:
    """Distinct runs of symbols that only ``pairs`` join, with their counts; None beyond ``most``."""
    hot = np.sort(np.array([left << 32 | right for _, left, right in pairs], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("symbols")
            symbols, sizes = column.flatten().to_numpy(), column.value_lengths().to_numpy()
            words, codes = np.repeat(np.arange(len(sizes)), sizes), _pair_codes(symbols.astype(np.int64))
            joined = hot[np.minimum(np.searchsorted(hot, codes), len(hot) - 1)] == codes
            joined &= words[:-1] == words[1:]
            opens = np.flatnonzero(~np.append(False, joined)[: len(symbols)])
            lengths = np.diff(np.append(opens, len(symbols)))
            several = lengths > 1
            runs = _lists(symbols, lengths).filter(pa.array(several))
            inside = runs.flatten().to_numpy()
            keys = _blobs(inside, lengths[several])
            n = batch.column("n").take(pa.array(words[opens[several]]))
            sums = pa.table({"segment": keys, "n": n}).group_by("segment").aggregate([("n", "sum")])
            yield from sums.select(["segment", "n_sum"]).rename_columns(["segment", "n"]).combine_chunks().to_batches()

    found = (
        words.mapInArrow(run, "segment binary, n bigint")
        .groupBy("segment")
        .agg(F.sum("n").alias("n"))
        .limit(most + 1)
        .toArrow()
    )
    if found.num_rows > most:
        return None
    segments = [np.frombuffer(segment, np.int32).tolist() for segment in found.column("segment").to_pylist()]
    return list(zip(segments, found.column("n").to_pylist()))


class PairIndex:
    """Counts of symbol pairs over weighted segments, and which segments hold each pair.

    A merge visits the segments with its pair only; what their pairs lose and gain is added to
    the counts. The most frequent pair waits in a heap whose stale entries are renewed when met.
    """

    def __init__(self, segments: Sequence[tuple[list[int], int]]):
        self.segments = [list(symbols) for symbols, _ in segments]
        self.weights = [n for _, n in segments]
        self.counts: dict[tuple[int, int], int] = {}
        self.places: dict[tuple[int, int], set[int]] = {}
        for at in range(len(self.segments)):
            self._add(at, 1)
        self.heap = [(-n, *pair) for pair, n in self.counts.items()]
        heapq.heapify(self.heap)

    def _add(self, at: int, sign: int) -> set[tuple[int, int]]:
        symbols, n = self.segments[at], sign * self.weights[at]
        pairs = list(zip(symbols, symbols[1:]))
        for pair in pairs:
            self.counts[pair] = self.counts.get(pair, 0) + n
            if sign > 0:
                self.places.setdefault(pair, set()).add(at)
        return set(pairs)

    def top(self) -> tuple[int, int, int] | None:
        """The next pair to merge as ``(-n, left, right)``: most frequent, then smallest."""
        while self.heap:
            less, left, right = self.heap[0]
            n = self.counts.get((left, right), 0)
            if n == -less:
                return (less, left, right) if n else None
            heapq.heappop(self.heap)
            if n:
                heapq.heappush(self.heap, (-n, left, right))
        return None

    def merge(self, left: int, right: int, new: int) -> None:
        touched: set[tuple[int, int]] = set()
        for at in self.places.pop((left, right), ()):
            before, after, place = self.segments[at], [], 0
            while place < len(before):
                if before[place : place + 2] == [left, right]:
                    after.append(new)
                    place += 2
                else:
                    after.append(before[place])
                    place += 1
            if len(after) == len(before):
                continue  # an earlier merge took the pair from here
            self._add(at, -1)
            self.segments[at] = after
            touched |= self._add(at, 1)
        for pair in touched:
            heapq.heappush(self.heap, (-self.counts[pair], *pair))


def train_merges(
    counts: DataFrame,
    vocab_size: int,
    min_frequency: int = 0,
    special_tokens: Sequence[str] = fixed.SPECIAL_TOKENS,
    prefix: str = "",
) -> SubwordModel:
    """Byte-pair merges of characters; with ``prefix``, of pieces marked inside a word.

    The pair with the highest weighted count is merged, ties going to the smaller symbols, until
    the vocabulary is full or no pair is frequent enough. A round settles many merges:

    1. the most frequent pairs of all words are found, down to some pair, the bound;
    2. words are cut at all other pairs, and equal segments are added up. A pair at a cut never
       gets more frequent, whatever is merged beside it, so it stays behind the bound;
    3. the segments, a bounded table, are merged one pair at a time through a :class:`PairIndex`,
       until the next pair would be behind the bound;
    4. the merges are applied to all words.

    So each merge costs the segments that it touches, and a round three passes over the distinct
    words. If segments are too many the round takes fewer pairs; a single pair has few segments.
    A merge that spells a token known already may make a cut pair more frequent and ends its round.
    """
    inner_base = INNER_BASE if prefix else 0
    counts = materialize(counts, "words")
    chars = F.split("word", "")
    marked = F.transform(chars, lambda char, at: F.struct(char.alias("char"), (at > 0).alias("inner")))
    seen = counts.select(F.explode(F.array_distinct(marked)).alias("c")).distinct().collect()
    firsts = sorted({row["c"]["char"] for row in seen})
    inners = sorted({row["c"]["char"] for row in seen if row["c"]["inner"]})

    tokens = [*special_tokens, *firsts]
    text_of = {ord(char): char for char in firsts}
    if prefix:
        tokens += [prefix + char for char in inners]
        text_of |= {inner_base + ord(char): prefix + char for char in inners}
    id_of = {text: symbol for symbol, text in text_of.items()}
    merges: list[tuple[str, str]] = []

    words = materialize(spread(_symbol_table(counts, inner_base)), "symbols")
    most_pairs = FIRST_PAIRS
    while len(tokens) < vocab_size:
        pairs = _top_pairs(words, max(min_frequency, 1), most_pairs + 1)
        settled: list[Merge] = []
        while pairs and not settled:
            bound = pairs[most_pairs] if len(pairs) > most_pairs else None
            segments = _segments(words, pairs[:most_pairs], MAX_SEGMENTS if most_pairs > 1 else (1 << 31) - 2)
            if segments is None:
                most_pairs = max(1, most_pairs // 4)
                continue
            index = PairIndex(segments)
            while len(tokens) < vocab_size:
                top = index.top()
                if top is None or (bound is not None and top >= bound) or -top[0] < min_frequency:
                    break
                _, left, right = top
                text = text_of[left] + text_of[right].removeprefix(prefix)
                known = id_of.get(text)
                if known is not None and settled:
                    break
                new = MERGED_BASE + len(tokens) if known is None else known
                if known is None:
                    text_of[new], id_of[text] = text, new
                    tokens.append(text)
                merges.append((text_of[left], text_of[right]))
                settled.append((left, right, new))
                if known is not None:
                    break
                index.merge(left, right, new)
            if len(segments) < MAX_SEGMENTS // 4:
                most_pairs = min(2 * most_pairs, MOST_PAIRS)
        if not settled:
            break
        if len(tokens) < vocab_size:
            words = materialize(_merged(words, settled), "merged-words")
    return SubwordModel("wordpiece" if prefix else "bpe", tokens, merges, prefix=prefix)


def train_bpe(counts: DataFrame, vocab_size: int, **options) -> SubwordModel:
    return train_merges(counts, vocab_size, **options)


def train_wordpiece(counts: DataFrame, vocab_size: int, **options) -> SubwordModel:
    return train_merges(counts, vocab_size, prefix=fixed.CONTINUATION_PREFIX, **options)


# --- unigram training --------------------------------------------------------------


SHORT_PIECE = 4


def _pieces_of(words: DataFrame, shortest: int, longest: int, starts: Column) -> DataFrame:
    """``(piece, n)``: counts of the substrings of ``shortest`` to ``longest`` characters.

    ``starts`` are the places in each word where they may begin.
    """
    at, size = F.col("at"), F.length("word")
    lengths = F.sequence(F.lit(shortest), F.least(F.lit(longest), size - at + 1))
    return (
        words.select("word", "n", F.explode(starts).alias("at"))
        .filter(at + shortest - 1 <= size)
        .select("word", "n", "at", F.explode(lengths).alias("length"))
        .groupBy(F.substring("word", at, F.col("length")).alias("piece"))
        .agg(F.sum("n").alias("n"))
    )


def _seed_pieces(counts: DataFrame, longest: int, seed_size: int) -> dict[str, float]:
    """All characters and the substrings that cover most text, with their counts.

    Short substrings are counted first. A longer one is as frequent at most as its beginning, so
    those whose beginning is too rare to get among the ``seed_size`` best are never formed.
    """
    everywhere = F.sequence(F.lit(1), F.length("word"))
    words = counts.filter(F.length("word") > 0)
    short = materialize(_pieces_of(words, 1, min(SHORT_PIECE, longest), everywhere), "short-pieces")
    covered = F.col("n") * F.length("piece")
    single = F.length("piece") == 1

    def most(pieces: DataFrame) -> list:
        found = pieces.filter(~single & (F.col("n") > 1)).orderBy(F.desc(covered), "piece")
        return found.limit(seed_size).collect()

    best = most(short)
    if longest > SHORT_PIECE:
        least = best[-1]["n"] * len(best[-1]["piece"]) if len(best) == seed_size else 0
        open_ends = bounded_table(
            short.filter((F.length("piece") == SHORT_PIECE) & (F.col("n") > 1) & (F.col("n") * longest >= least)).select(
                F.col("piece").alias("beginning")
            )
        )
        size = F.length("word")
        rest = (
            words.filter(size > SHORT_PIECE)
            .select("n", F.explode(F.sequence(F.lit(1), size - SHORT_PIECE)).alias("at"), "word")
            .select(F.substring("word", F.col("at"), F.lit(longest)).alias("word"), "n")
            .withColumn("beginning", F.substring("word", 1, SHORT_PIECE))
            .join(open_ends, "beginning")
        )
        long = _pieces_of(rest, SHORT_PIECE + 1, longest, F.array(F.lit(1)))
        best = most(short.filter(covered >= least).unionByName(long.filter(covered >= least)))
    # the alphabet is bounded by Unicode, the rest by seed_size
    return {row["piece"]: float(row["n"]) for row in [*short.filter(single).collect(), *best]}


@dataclass
class PieceTree:
    """Pieces as a prefix tree in sorted arrays, so that many places are looked up at once."""

    steps: np.ndarray  # node and next character, sorted
    nodes: np.ndarray  # where each step leads
    pieces: np.ndarray  # the piece that ends at each node, or -1

    @classmethod
    def of(cls, pieces: Sequence[str]) -> PieceTree:
        steps: dict[int, int] = {}
        ends = [-1]
        for at, piece in enumerate(pieces):
            node = 0
            for char in piece:
                step = node << 21 | ord(char)
                node = steps.setdefault(step, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = at
        order = np.array(sorted(steps), np.int64)
        return cls(order, np.array([steps[step] for step in order.tolist()], np.int64), np.array(ends, np.int64))

    def places(self, words: Sequence[str], longest: int, whole: bool = True) -> tuple[np.ndarray, ...]:
        """Sizes of the words; starts, ends and numbers of pieces in word order; how many each word has."""
        chars, sizes = _chars(words)
        owner, last = np.repeat(np.arange(len(words)), sizes), np.repeat(np.cumsum(sizes), sizes)
        first = last - sizes[owner]
        begin, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        found = []
        for length in range(1, longest + 1 if len(self.steps) else 1):
            inside = begin + length <= last[begin]
            begin, node = begin[inside], node[inside]
            step = node << 21 | chars[begin + length - 1]
            at = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            known = self.steps[at] == step
            begin, node = begin[known], self.nodes[at[known]]
            if not len(begin):
                break
            ends = self.pieces[node] >= 0
            if not whole:
                ends &= sizes[owner[begin]] > length
            found.append((begin[ends], np.full(int(ends.sum()), length), self.pieces[node[ends]]))
        begin, length, piece = (
            np.concatenate([part[at] for part in found] or [np.zeros(0, np.int64)]) for at in range(3)
        )
        order = np.argsort(begin, kind="stable")  # shorter pieces at a place were found first
        begin, length, piece = begin[order], length[order], piece[order]
        start = begin - first[begin]
        return sizes, start, start + length, piece, np.bincount(owner[begin], minlength=len(words))


def _lattice(words: DataFrame, pieces: Sequence[str], longest: int, whole: bool = True) -> DataFrame:
    """``(n, size, starts, ends, pieces)``: where each of ``pieces`` lies in each word, as :func:`_blobs`.

    Made once per training, as later rounds only drop pieces. Without ``whole`` a piece does not
    count as part of itself.
    """
    shared = words.sparkSession.sparkContext.broadcast(PieceTree.of(pieces))
    names = ["n", "size", "starts", "ends", "pieces"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, *columns, counts = shared.value.places(batch.column("word").to_pylist(), longest, whole)
            listed = [_blobs(column, counts) for column in columns]
            yield pa.RecordBatch.from_arrays(
                [batch.column("n").cast(pa.int64()), pa.array(sizes, pa.int32()), *listed], names
            )

    return words.select("word", "n").mapInArrow(
        run, "n bigint, size int, starts binary, ends binary, pieces binary"
    )


@dataclass
class _Edges:
    """Living pieces in a batch of words; positions of all words follow one another."""

    first: np.ndarray  # position of each word's begin
    last: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    pieces: np.ndarray
    scores: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, scores: np.ndarray) -> _Edges:
        sizes = batch.column("size").to_numpy()
        first = np.cumsum(sizes + 1, dtype=np.int32) - sizes - 1  # a batch holds less than 2 GB
        listed = [batch.column(name) for name in ("starts", "ends", "pieces")]
        listed = [_opened(column) if pa.types.is_binary(column.type) else column for column in listed]
        counts = listed[0].value_lengths().to_numpy()
        starts, ends, pieces = (column.flatten().to_numpy() for column in listed)
        words = np.repeat(np.arange(len(sizes)), counts)
        alive = np.isfinite(scores[pieces])
        words, pieces = words[alive], pieces[alive]
        offset = first[words]
        return cls(first, first + sizes, words, offset + starts[alive], offset + ends[alive], pieces, scores[pieces])

    def along(self, combine: np.ufunc, forward: bool = True) -> np.ndarray:
        """Combined score of all splits from each word's begin (or end) to each position."""
        near, far = (self.starts, self.ends) if forward else (self.ends, self.starts)
        origin = self.first if forward else self.last
        found = np.full(int(self.last[-1]) + 1 if len(self.last) else 0, -np.inf)
        found[origin] = 0.0
        depth = np.abs(far - origin[self.words])
        steps = np.cumsum(np.bincount(depth)).tolist()
        # edges come word by word, so within a depth those that end at one place stay together
        order = np.argsort(depth.astype(np.min_scalar_type(len(steps))), kind="stable")
        near, far, scores = near[order], far[order], self.scores[order]
        for low, high in zip([0, *steps], steps):
            if low == high:
                continue
            at = far[low:high]
            opens = np.flatnonzero(np.diff(at, prepend=-1))
            found[at[opens]] = combine.reduceat(found[near[low:high]] + scores[low:high], opens)
        return found


def expected_pieces(batch: pa.RecordBatch, scores: np.ndarray) -> tuple[np.ndarray, float]:
    """How often each piece is expected in a batch of words, and the words' log-likelihood.

    Over all splits of a word, weighted by their probability (forward-backward), times its count.
    """
    edges, n = _Edges.of(batch, scores), batch.column("n").to_numpy()
    ahead, behind = edges.along(np.logaddexp), edges.along(np.logaddexp, False)
    total = ahead[edges.last]
    share = np.exp(ahead[edges.starts] + edges.scores + behind[edges.ends] - total[edges.words])
    return np.bincount(edges.pieces, share * n[edges.words], len(scores)), float(n @ total)


def _expected_counts(lattice: DataFrame, scores: np.ndarray) -> tuple[np.ndarray, float]:
    """Expected count of every piece over all words, and the corpus log-likelihood.

    Every partition sums its own words first; what is shuffled is one row per piece and
    partition. Pieces with an infinitely low score are left out.
    """
    shared = lattice.sparkSession.sparkContext.broadcast(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sums, likelihood = np.zeros(len(known)), 0.0
        for batch in batches:
            found, score = expected_pieces(batch, known)
            sums += found
            likelihood += score
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(sums[used], likelihood))], ["piece", "weight"]
        )

    rows = (
        lattice.mapInArrow(run, "piece bigint, weight double")
        .groupBy("piece")
        .agg(F.sum("weight").alias("weight"))
        .toArrow()
    )
    shared.unpersist()
    pieces, weights = (rows.column(name).to_numpy() for name in ("piece", "weight"))
    found = np.zeros(len(scores))
    found[pieces[pieces >= 0]] = weights[pieces >= 0]
    return found, float(weights[pieces < 0].sum())


def _best_without(lattice: DataFrame, scores: np.ndarray) -> np.ndarray:
    """Score of the best split of each piece into other living pieces."""
    shared = lattice.sparkSession.sparkContext.broadcast(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = _Edges.of(batch, shared.value)
            best = edges.along(np.maximum)[edges.last]
            yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(best)], ["piece", "best"])

    rows = lattice.mapInArrow(run, "piece bigint, best double").toArrow()  # one row a seed
    shared.unpersist()
    found = np.zeros(len(scores))
    found[rows.column("piece").to_numpy()] = rows.column("best").to_numpy()
    return found


def train_unigram(
    counts: DataFrame,
    vocab_size: int,
    special_tokens: Sequence[str] = fixed.SPECIAL_TOKENS,
    seed_size: int | None = None,
    longest_piece: int = 16,
    rounds: int = 2,
    shrink: float = 0.75,
) -> SubwordModel:
    """A piece vocabulary by expectation maximization with pruning (Kudo, 2018).

    Where the seeds lie in the distinct words is found once; each round is then array arithmetic
    over those places, as one job, and so is the search for the best split of every piece without
    it. What reaches the driver is the piece table, which never exceeds ``seed_size`` plus the
    alphabet; the default is ten seeds for a token. Far above the target, more pieces go at a time.

    The result has exactly ``vocab_size`` tokens. Where the words do not hold as many different
    pieces, or their characters alone are more, this is an error.
    """
    if seed_size is None:
        seed_size = 10 * vocab_size
    if seed_size < vocab_size:
        raise ValueError(f"{seed_size} seeds cannot fill a vocabulary of {vocab_size} tokens")
    counts = materialize(counts, "words")
    spark = counts.sparkSession
    target = vocab_size - len(special_tokens)
    seeds = _seed_pieces(counts, longest_piece, seed_size)
    pieces = sorted(seeds)
    single = np.array([len(piece) == 1 for piece in pieces], dtype=bool)
    if not int(single.sum()) <= target <= len(pieces):
        raise ValueError(
            f"{len(pieces)} pieces, {int(single.sum())} of them characters, cannot make {target} tokens"
        )
    lattice = materialize(_lattice(spread(counts), pieces, longest_piece), "lattice")
    longer = [(piece, at) for at, piece in enumerate(pieces) if len(piece) > 1]
    own = spark.createDataFrame(longer, "word string, n bigint")
    own = materialize(_lattice(spread(own), pieces, longest_piece, whole=False), "piece-lattice")

    def scored(weights: np.ndarray, alive: np.ndarray) -> np.ndarray:
        # characters, and pieces that nothing needs just now, stay in reach
        kept = np.where(alive, np.maximum(weights, 1e-9), 0.0)
        with np.errstate(divide="ignore"):
            return np.log(kept) - np.log(kept.sum())

    alive = np.ones(len(pieces), dtype=bool)
    scores = scored(np.array([seeds[piece] for piece in pieces]), alive)
    likelihoods: list[float] = []
    while True:
        for _ in range(rounds):
            expected, likelihood = _expected_counts(lattice, scores)
            likelihoods.append(likelihood)
            scores = scored(expected, alive)
        count = int(alive.sum())
        if count <= target:
            break
        kept = shrink if count < 4 * target else shrink / 1.5
        loss = np.full(len(pieces), -np.inf)
        loss[alive] = (expected / expected.sum())[alive] * (scores - _best_without(own, scores))[alive]
        loss[single] = np.inf
        alive = np.zeros(len(pieces), dtype=bool)
        alive[np.argsort(-loss, kind="stable")[: max(target, int(count * kept))]] = True
        scores = scored(np.exp(scores), alive)
    found = {piece: float(score) for piece, score, lives in zip(pieces, scores, alive) if lives}
    ordered = sorted(found, key=lambda piece: (-found[piece], piece))
    return SubwordModel(
        "unigram", [*special_tokens, *ordered], scores=found, likelihoods=likelihoods
    )
