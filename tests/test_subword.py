import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers, trainers

from folianta import fixed_values as fixed
from folianta.operators import segment, subword

CORPUS = [
    "la luna clara mira la casa sola.",
    "una casa sola espera la luna nueva.",
    "la luna nueva sale clara y mira.",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 15")


@pytest.fixture(scope="module")
def texts(docs):
    return [r["text"] for r in docs.orderBy("doc_id").collect()]


def counted(spark, texts):
    return subword.word_counts(spark.createDataFrame([(t,) for t in texts], "text string"))


def library(model, trainer, texts):
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    tokenizer.train_from_iterator(texts, trainer)
    return tokenizer


def options(size, least=1):
    return dict(
        vocab_size=size, min_frequency=least, special_tokens=fixed.SPECIAL_TOKENS, show_progress=False
    )


@pytest.mark.parametrize("size", [45, 300])
def test_bpe_is_the_librarys(spark, docs, texts, size):
    corpus = CORPUS if size == 45 else texts
    theirs = library(models.BPE(unk_token="[UNK]"), trainers.BpeTrainer(**options(size)), corpus)
    vocabulary = theirs.get_vocab()
    model = subword.train_bpe(counted(spark, corpus), size, min_frequency=1)
    assert model.tokens == sorted(vocabulary, key=vocabulary.get)
    frame = spark.createDataFrame(list(enumerate(corpus)), "i int, text string")
    coded = frame.select("i", model.encode(spark, F.col("text")).alias("c")).orderBy("i").collect()
    for row, expected in zip(coded, theirs.encode_batch(corpus)):
        assert row["c"]["tokens"] == expected.tokens and row["c"]["ids"] == expected.ids


def test_repeated_characters_and_minimum_frequency(spark):
    corpus = ["aaaa aaaa abab bababa", "aaa abcabc abcabc zz"] * 3
    theirs = library(models.BPE(unk_token="[UNK]"), trainers.BpeTrainer(**options(60, 4)), corpus)
    vocabulary = theirs.get_vocab()
    model = subword.train_bpe(counted(spark, corpus), 60, min_frequency=4)
    assert model.tokens == sorted(vocabulary, key=vocabulary.get)


def test_wordpiece_is_the_librarys(spark, texts):
    theirs = library(
        models.WordPiece(unk_token="[UNK]"), trainers.WordPieceTrainer(**options(300)), texts
    )
    model = subword.train_wordpiece(counted(spark, texts), 300, min_frequency=1)
    assert set(model.tokens) == set(theirs.get_vocab())
    frame = spark.createDataFrame(list(enumerate([*texts, "Ω unknown"])), "i int, text string")
    coded = frame.select("i", model.encode(spark, F.col("text")).alias("c")).orderBy("i").collect()
    for row, expected in zip(coded, theirs.encode_batch([*texts, "Ω unknown"])):
        assert row["c"]["tokens"] == expected.tokens


def test_unigram_properties(spark, texts):
    model = subword.train_unigram(counted(spark, texts), 250, seed_size=800)
    assert len(model.tokens) == 250
    for first, second in zip(model.likelihoods[::2], model.likelihoods[1::2]):
        assert second >= first
    alphabet = {c for t in texts for c in t if not c.isspace()}
    assert alphabet <= set(model.tokens)
    frame = spark.createDataFrame([(texts[0],)], "text string")
    pieces = frame.select(model.encode(spark, F.col("text")).alias("c")).first()["c"]["tokens"]
    assert "".join(pieces) == "".join(texts[0].split())


def lattice_of(words, pieces):
    rows = [
        [(s, e, pieces.index(w[s:e])) for s in range(len(w)) for e in range(s + 1, len(w) + 1) if w[s:e] in pieces]
        if len(w) < 100
        else [(s, s + k, k - 1) for s in range(len(w)) for k in (1, 2) if s + k <= len(w)]
        for w, _ in words
    ]
    columns = [pa.array([[edge[at] for edge in row] for row in rows], pa.list_(pa.int32())) for at in range(3)]
    n, size = [n for _, n in words], [len(w) for w, _ in words]
    return pa.RecordBatch.from_arrays(
        [pa.array(n), pa.array(size, pa.int32()), *columns], ["n", "size", "starts", "ends", "pieces"]
    )


def expect(word, scores):
    """Counts of a word among others; one that does not occur must change nothing."""
    batch = lattice_of([(word, 0), (word, 1), (word[:1], 0)], list(scores))
    counts, likelihood = subword.expected_pieces(batch, np.array(list(scores.values())))
    return dict(zip(scores, counts)), likelihood


def test_expected_pieces_by_enumeration():
    import math

    scores = {"a": -1.0, "b": -1.5, "ab": -0.5, "ba": -2.0, "aba": -3.0}
    for word in ("abab", "a" * 3, "abababab"):
        splits = []

        def walk(rest, done):
            if not rest:
                splits.append(done)
            for size in range(1, 4):
                if rest[:size] in scores and len(rest[:size]) == size:
                    walk(rest[size:], [*done, rest[:size]])

        walk(word, [])
        weights = [math.exp(sum(scores[p] for p in s)) for s in splits]
        counts, likelihood = expect(word, scores)
        assert likelihood == pytest.approx(math.log(sum(weights)))
        for piece in scores:
            expected = sum(w * s.count(piece) for w, s in zip(weights, splits)) / sum(weights)
            assert counts.get(piece, 0.0) == pytest.approx(expected)
        best, score = segment.best_split(word, scores, 3, segment.unknown_score(scores))
        assert score == pytest.approx(max(math.log(w) for w in weights))
        assert "".join(best) == word


def test_expected_pieces_of_a_very_long_word():
    scores = {"a": -4.0, "aa": -5.0}
    for size in (64, 5000):
        counts, likelihood = expect("a" * size, scores)
        assert counts["a"] + 2 * counts["aa"] == pytest.approx(size)
        # per character the best splits weigh exp(-2.5); there are few others
        assert -2.5 * size < likelihood < -2.3 * size


def test_long_words_and_stored_models(spark, folder):
    words = {"a": 0, "##a": 1}
    assert segment.longest_match_split("a" * 101, words, "##", "?") == ["?"]
    assert segment.longest_match_split("a" * 101, words, "##", "?", None, 3) == ["a"] + ["##a"] * 100
    model = subword.train_bpe(counted(spark, CORPUS), 30)
    model.save(spark, f"{folder}/model")
    assert subword.SubwordModel.load(spark, f"{folder}/model") == model
    with pytest.raises(ValueError, match="seeds"):
        subword.train_unigram(counted(spark, CORPUS), 100, seed_size=50)


def test_unigram_vocabularies_are_full_or_an_error(spark, texts):
    counts = counted(spark, texts)
    chars = len({c for t in texts for c in t if not c.isspace()})
    for size in (chars + 1 + 3, chars + 40):
        assert len(subword.train_unigram(counts, size, special_tokens=["[UNK]"]).tokens) == size
    few = counted(spark, ["ab ab", "abc"])
    assert len(subword.train_unigram(few, 5, special_tokens=["[UNK]"], seed_size=10).tokens) == 5
    for size in (3, 40):
        with pytest.raises(ValueError, match="cannot make"):
            subword.train_unigram(few, size, special_tokens=["[UNK]"], seed_size=100)


@pytest.mark.parametrize("longest, size", [(3, 5), (4, 60), (16, 40), (16, 100_000), (7, 300)])
def test_seed_pieces_by_enumeration(spark, texts, longest, size):
    from collections import Counter

    counts = counted(spark, [*texts[:4], "banana bananas \U0001f600a\U0001f600a aaaaaaaaaaaaaaaaaaaaaaaa"])
    seen = Counter()
    for row in counts.collect():
        for at in range(len(row["word"])):
            for end in range(at + 1, min(at + longest, len(row["word"])) + 1):
                seen[row["word"][at:end]] += row["n"]
    chars = {piece: n for piece, n in seen.items() if len(piece) == 1}
    longer = [piece for piece, n in seen.items() if len(piece) > 1 and n > 1]
    longer.sort(key=lambda piece: (-seen[piece] * len(piece), piece.encode()))
    assert subword._seed_pieces(counts, longest, size) == chars | {p: seen[p] for p in longer[:size]}


def test_pair_index_is_a_recount():
    import random
    from collections import Counter

    for seed in range(30):
        pick = random.Random(seed)
        words = [([pick.randrange(4) for _ in range(pick.randint(1, 9))], pick.randint(1, 5)) for _ in range(20)]
        index = subword.PairIndex(words)
        for new in range(10, 25):
            recount = Counter()
            for symbols, n in zip(index.segments, index.weights):
                for pair in zip(symbols, symbols[1:]):
                    recount[pair] += n
            assert {p: n for p, n in index.counts.items() if n} == dict(recount)
            top = min(((-n, *pair) for pair, n in recount.items()), default=None)
            assert index.top() == top
            if top is None:
                break
            index.merge(top[1], top[2], new)


@pytest.mark.parametrize("pairs, segments", [(1, 50), (2, 10_000), (7, 3), (64, 10_000)])
def test_merges_do_not_depend_on_the_size_of_rounds(spark, texts, monkeypatch, pairs, segments):
    counts = counted(spark, [*texts, "aaaa aaa aaaaaaa banana"])
    known = subword.train_bpe(counts, 150)
    monkeypatch.setattr(subword, "FIRST_PAIRS", pairs)
    monkeypatch.setattr(subword, "MOST_PAIRS", pairs)
    monkeypatch.setattr(subword, "MAX_SEGMENTS", segments)
    if pairs < 3:
        counts, known = counts.filter("length(word) < 6"), subword.train_bpe(counts.filter("length(word) < 6"), 60)
        assert subword.train_bpe(counts, 60).merges == known.merges
    else:
        assert subword.train_bpe(counts, 150).merges == known.merges


def test_word_and_pair_counts(spark):
    counts = counted(spark, CORPUS)
    words = {r["word"]: r["n"] for r in counts.collect()}
    assert words["luna"] == 3 and words["."] == 3
    pairs = {(r["left"], r["right"]): r["n"] for r in subword.pair_counts(counts).collect()}
    assert pairs[("l", "u")] == 3 and pairs[("l", "a")] == 8
    top = subword.frequency_vocabulary(counts, 3).orderBy("id").collect()
    assert [r["token"] for r in top] == ["la", ".", "luna"]  # ties by word


def test_places_of_pieces_are_packed(spark):
    words = spark.createDataFrame([("abab", 2), ("ba", 3), ("", 1), ("c", 1)], "word string, n bigint").coalesce(1)
    lattice = subword._lattice(words, ["a", "ab", "b", "ba"], 2)
    assert [dict(lattice.dtypes)[name] for name in ("starts", "ends", "pieces")] == ["binary"] * 3
    rows = {row["n"]: row for row in lattice.filter("size > 1").collect()}
    assert np.frombuffer(rows[2]["pieces"], np.int32).tolist() == [0, 1, 2, 3, 0, 1, 2]
    assert np.frombuffer(rows[3]["ends"], np.int32).tolist() == [1, 2, 2]
    for length in (0, 1, 2):
        packed = subword._blobs(np.arange(5), np.array([2, 0, 3])).slice(length)
        assert subword._opened(packed).to_pylist() == [[0, 1], [], [2, 3, 4]][length:]
    assert subword._opened(subword._blobs(np.arange(0), np.array([0]))).to_pylist() == [[]]


def test_a_merge_queues_each_pair_once():
    index = subword.PairIndex([([1, 2, 3 + at], 1) for at in range(50)] + [([1, 2, 1, 2, 9], 7)] * 40)
    waiting = len(index.heap)
    index.merge(1, 2, 100)
    assert len(index.heap) - waiting <= 53
    assert index.top() == (-281, 100, 9)
