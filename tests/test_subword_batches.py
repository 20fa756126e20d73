"""Many words at once are cut as one word by itself."""

import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folianta.functions import text
from folianta.operators import positions, records, segment, subword
from folianta.plans import corpus_queries


def drawn(seed, count=300):
    pick = random.Random(seed)
    words = ["".join(pick.choices("aab\u00e9#\U0001f600", k=pick.randint(1, 12))) for _ in range(count)]
    return [*dict.fromkeys([*words, "a" * 300, "ab" * 90, "#" * 101, "##a", "z"])]


@pytest.mark.parametrize("seed", range(20))
def test_merged_words(seed):
    pick = random.Random(seed)
    words = [[pick.randrange(4) for _ in range(pick.choice([0, 1, 5, 9, 150]))] for _ in range(60)]
    merges, symbols = {}, list(range(4))
    for new in range(10, 22):
        merges.setdefault((pick.choice(symbols), pick.choice(symbols)), pick.choice([new, new, 2]))
        symbols.append(new)
    triples = [(*pair, new) for pair, new in merges.items()]
    ranks = {pair: at for at, pair in enumerate(merges)}
    expected = [segment.merge_pieces(word, ranks, merges.get) for word in words]
    flat = np.array([symbol for word in words for symbol in word], np.int32)
    symbols, sizes = subword.merge_words(flat, np.array([len(word) for word in words]), triples)
    assert sizes.tolist() == [len(word) for word in expected]
    assert symbols.tolist() == [symbol for word in expected for symbol in word]


@pytest.mark.parametrize("seed", range(10))
@pytest.mark.parametrize("kind", ["bpe", "wordpiece", "wordpiece-any", "unigram"])
def test_words_are_coded_as_they_are_cut(seed, kind):
    pick = random.Random(seed)
    words = drawn(seed)
    parts = sorted({w[a : a + k] for w in words[:60] for a in range(len(w)) for k in (1, 2, 3) if w[a : a + k]})
    parts = [part for part in parts if pick.random() < 0.7]
    if kind == "bpe":
        merges = [(p[:at], p[at:]) for p in parts if len(p) > 1 for at in range(1, len(p))]
        pick.shuffle(merges)
        model = subword.SubwordModel("bpe", ["[UNK]", *parts], merges + merges[:3])
    elif kind == "unigram":
        scores = {part: pick.choice([-1.0, -2.0, -2.5, -4.0]) for part in parts}
        model = subword.SubwordModel("unigram", ["[UNK]", *parts], scores=scores)
    else:
        tokens = list(dict.fromkeys(["[UNK]", *parts, *["##" + part for part in parts if pick.random() < 0.8], "##"]))
        model = subword.SubwordModel("wordpiece", tokens, prefix="##")
        if kind == "wordpiece-any":
            model.longest_word = None
    ids, cut = {token: at for at, token in enumerate(model.tokens)}, model._cutter()
    coded = [np.frombuffer(code, np.int32).tolist() for code in model._coder()(words)]
    assert coded == [[ids[piece] for piece in cut(word)] for word in words]
    assert model._coder()([]) == []


def test_null_and_empty_texts_have_no_pieces(spark):
    model = subword.SubwordModel("bpe", ["[UNK]", "a", "b", "ab"], [("a", "b")])
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "ab a z"), (4, None)], "i int, text string").coalesce(1)
    coded = rows.select("i", model.encode(spark, F.col("text")).alias("c")).orderBy("i").collect()
    assert [row["c"]["tokens"] for row in coded] == [[], [], ["ab", "a", "[UNK]"], []]
    assert [row["c"]["ids"] for row in coded] == [[], [], [3, 1, 0], []]


@pytest.mark.parametrize("whole", [True, False])
def test_places_of_pieces(whole):
    words, pieces = drawn(3), ["a", "ab", "aab", "\U0001f600", "\u00e9a", "##a"]
    sizes, starts, ends, found, counts = subword.PieceTree.of(pieces).places(words, 3, whole)
    expected = [
        [(s, e, pieces.index(w[s:e])) for s in range(len(w)) for e in range(s + 1, min(s + 3, len(w)) + 1)
         if w[s:e] in pieces and (whole or e - s < len(w))]
        for w in words
    ]
    assert sizes.tolist() == [len(w) for w in words] and counts.tolist() == [len(row) for row in expected]
    assert [*zip(starts.tolist(), ends.tolist(), found.tolist())] == [edge for row in expected for edge in row]


def test_repeated_values_are_shuffled_once_and_without_repeats(spark, monkeypatch):
    monkeypatch.setattr(records, "HELD_ROWS", 50)
    pick = random.Random(5)
    rows = [(pick.choice([1, 2, None]), pick.choice(["a", "b", None]), at % 97, pick.choice("pqrstu")) for at in range(2_000)]
    frame = spark.createDataFrame([*rows, (3, "a", 0, None), (3, "a", 1, "x")], "k int, name string, pos int, value string")
    found = records.group_values(frame, ["k", "name"])
    expected = {}
    for k, name, pos, value in [*rows, (3, "a", 0, None), (3, "a", 1, "x")]:
        group = expected.setdefault((k, name), {})
        group[value] = min(pos, group.get(value, pos))
    expected = {key: sorted(group, key=lambda v: (group[v], v or "")) for key, group in expected.items()}
    assert {(r["k"], r["name"]): r["values"] for r in found.collect()} == expected
    plan = records.group_values(frame, ["k", "name"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    nested = frame.withColumn("value", F.array("value"))
    assert {(r["k"], r["name"]): [v[0] for v in r["values"]] for r in records.group_values(nested, ["k", "name"]).collect()} == expected


def test_cells_are_cleaned_once(spark):
    spaces = "\u00a0 \t\n"
    rows = [(f"{spaces}", f" x{spaces}y|| a  b ||{spaces}|| |c|||"), (None, None), ("", f"{spaces}\n a \u2003\n b"), (" z\n", "\u0085q\r\n")]
    frame = spark.createDataFrame(rows, "`t[es]` string, `t[en]` string")
    found = frame.select(
        text.best_by_language(["t[es]", "t[en]"]).alias("best"), text.split_list(F.col("`t[en]`")).alias("parts"),
        text.first_line(F.col("`t[en]`")).alias("line"),
    ).collect()
    assert [r["best"] for r in found] == ["x y|| a b || || |c|||", "", "a b", "z"]
    assert [r["parts"] for r in found] == [["x y", "a b", "|c", "|"], [], ["a b"], ["q"]]
    assert [r["line"] for r in found] == ["x", None, "a", "q"]


def test_texts_are_cut_once_for_occurrence_pairs(spark):
    docs = spark.createDataFrame([(1, "the a the"), (2, "the b"), (3, None), (4, "other")], "doc_id int, text string")
    pairs = positions.occurrence_pairs(docs, "the")
    assert "regexp_extract_all" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(row)[1:] for row in pairs.collect()) == [(1, 0, 1, 2), (1, 0, 2, 0)]


def test_landed_responses_share_files(spark, sf_dir):
    path = corpus_queries._prefixed_landing(spark, sf_dir)
    assert {folder.name for folder in pathlib.Path(path).glob("page=*")} == {"page=0", "page=1", "page=2"}


def test_merging_looks_up_changed_pairs_only(monkeypatch):
    looked_up, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda keys, found: looked_up.append(len(found)) or search(keys, found))
    merges = [(100, 0, 101), *[(at, 0, at + 1) for at in range(101, 160)]]
    symbols, sizes = subword.merge_words(np.array([100] + [0] * 59), np.array([60]), merges)
    assert symbols.tolist() == [159] and sizes.tolist() == [1]
    assert sum(looked_up) < 60 + 2 * 60


def test_remembered_words_are_the_first_of_the_last_batch():
    known = subword._remembered({"a": b"0", "z": b"1"}, ["a", "b"], [b"0", b"2"], 3)
    assert known == {"a": b"0", "z": b"1", "b": b"2"}
    assert subword._remembered(known, ["b", "c", "a"], [b"2", b"3", b"0"], 2) == {"b": b"2", "c": b"3"}
    assert subword._remembered({}, [], [], 0) == {}


def test_large_batches_are_encoded_in_parts(spark):
    assert subword.ENCODED_ROWS < 2_500
    model = subword.SubwordModel("wordpiece", ["[UNK]", "a", "##a", "b"], prefix="##")
    text = F.when(F.col("id") % 7 == 3, F.lit(None)).when(F.col("id") % 5 == 0, "").when(F.col("id") % 2 == 0, "aa b").otherwise("b x a")
    rows = spark.range(0, 2_500, 1, 1).select("id", text.alias("text"))
    found = rows.select("id", "text", model.encode(spark, F.col("text")).alias("c")).collect()
    known = {None: [], "": [], "aa b": [1, 2, 3], "b x a": [3, 0, 1]}
    assert len(found) == 2_500 and all(row["c"]["ids"] == known[row["text"]] for row in found)
    assert all([model.tokens[at] for at in row["c"]["ids"]] == row["c"]["tokens"] for row in found)
