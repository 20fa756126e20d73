"""Edges of single operators: exact boundaries and values followed by more."""

import numpy as np

from folianta.llm import language, license_scan, mixing, tool_calls

from .tables import assert_same, documents, write_all


def test_rest_that_ends_with_a_document(spark, folder):
    import pyarrow as pa

    texts = [f"d{i} " + "word " * 9 for i in range(21)]
    write_all(folder, documents(texts, source=pa.array(["a"] * 10 + ["b"] * 11)))
    assert_same(spark, folder, mixing.op5_mixing, mixing.ORACLE)
    taken = {}
    for row in mixing.op5_mixing(spark, folder).collect():
        taken[row["target"]] = taken.get(row["target"], 0) + row["taken"]
    assert taken == {150.0: 150, 60.0: 60}


def test_arguments_followed_by_more(spark):
    good = '{"address":"x"}'
    rest = ["", " \n", " and more", good, "," + good, "]", "}", '],[1', '},{"v":1', ',"v":1', " null", '{"v":2']
    calls = spark.createDataFrame(
        [(1, f"c{i}", i, "open", good + more, []) for i, more in enumerate(rest)],
        "conv_id bigint, call_id string, turn int, tool string, arguments string, depends_on array<string>",
    )
    results = spark.createDataFrame([], "conv_id bigint, call_id string, turn int, content string")
    found = {r["turn"]: r for r in tool_calls.link_calls(calls, results).collect()}
    assert [found[i]["errors"] for i in range(len(rest))] == [[], []] + [["json"]] * (len(rest) - 2)
    assert all(('"arguments":null' in r["json"]) == (turn > 1) for turn, r in found.items())


def test_every_language_is_sampled_and_copies_count_once(spark, monkeypatch):
    texts = [(f"{lang} text {i % 20} of its own", lang) for lang in ("en", "es") for i in range(3_000)]
    docs = spark.createDataFrame(texts, "text string, lang string")
    seen = []
    monkeypatch.setattr(language, "follow_the_leader", lambda rows, labels, classes: seen.append(labels) or np.zeros((language.BINS + 1, classes)))
    monkeypatch.setattr(language, "temperature_of", lambda scores, labels: seen.append(labels) or 1.0)
    assert language.fit(docs, rows_per_language=12).languages == ["en", "es"]
    assert np.bincount(np.concatenate(seen)).tolist() == [12, 12] and set(seen[0]) == {0, 1}
    seen.clear()
    language.fit(docs, rows_per_language=600)
    assert np.bincount(np.concatenate(seen)).tolist() == [20, 20]
    seen.clear()
    language.fit(docs.distinct().where("text LIKE '% 3 %'"), rows_per_language=600)
    assert np.bincount(seen[0]).tolist() == [1, 1] and len(seen[1]) == 0


def test_branching_chains_cycles_and_repeats(spark, monkeypatch):
    """Levels are longest ways; conversations of chains alone do not wait for others."""
    rounds = []
    keep = tool_calls.materialize
    monkeypatch.setattr(tool_calls, "materialize", lambda df, name: rounds.append(name) or keep(df, name))
    good = '{"address":"x"}'
    needs = {
        1: {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(120)},
        2: {"a": [], "b": ["a"], "c": ["a", "b"], "d": ["c", "a", "a"], "e": []},
        3: {"x": ["y"], "y": ["x"], "z": ["x", "w"], "w": []},
        4: {"p": ["p"], "q": ["gone"], "r": ["q"]},
    }
    rows = [(c, k, at, "open", good, n) for c, calls in needs.items() for at, (k, n) in enumerate(calls.items())]
    rows += [(2, "a", 50, "open", good, []), (2, None, 51, "open", good, []), (5, "s", 0, "unheard", good, None), (None, "n", 0, "open", '{"more":1}', [])]
    calls = spark.createDataFrame(
        rows, "conv_id bigint, call_id string, turn int, tool string, arguments string, depends_on array<string>"
    ).selectExpr("*", "'x' AS key", "'y' AS level", "'z' AS need", "'w' AS of", "'v' AS open")
    answers = [(1, "c0", 3, "late"), (1, "c0", 1, "early"), (2, "a", 9, None), (9, "c0", 0, "other")]
    results = spark.createDataFrame(answers, "conv_id bigint, call_id string, turn int, content string")
    found = {(r["conv_id"], r["call_id"], r["turn"]): r for r in tool_calls.link_calls(calls, results).collect()}
    assert len(found) == len(rows)
    levels = {k[:2]: r["level"] for k, r in found.items() if k[2] < 50 or k[0] == 1}
    assert all(levels[1, f"c{i}"] == i for i in range(120))
    assert [levels[2, k] for k in "abcde"] == [0, 1, 2, 3, 0]
    assert [levels[3, k] for k in "xyzw"] == [None, None, None, 0] and [levels[4, k] for k in "pqr"] == [None, 0, 1]
    errors = {k: r["errors"] for k, r in found.items()}
    assert all("cycle" in errors[3, k, at] for at, k in enumerate("xyz")) and "cycle" in errors[4, "p", 0]
    assert errors[4, "q", 1] == ["depends:gone"] and "repeated" in errors[2, "a", 50] and "id" in errors[2, None, 51]
    assert errors[5, "s", 0] == ["tool:unheard"] and errors[None, "n", 0] == ["missing:address"]
    assert [found[1, "c0", 0]["linked"], found[2, "a", 0]["linked"], found[1, "c1", 1]["linked"]] == [True, True, False]
    assert '"early"' in found[1, "c0", 0]["json"]
    assert rounds.count("call-ways") <= 10 and rounds.count("call-waiting") <= 8


def test_no_calls(spark):
    calls = spark.createDataFrame([], "conv_id bigint, call_id string, turn int, tool string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([], "conv_id bigint, call_id string, turn int, content string")
    assert tool_calls.link_calls(calls, results).collect() == []


def test_wrapped_notices(spark, folder):
    label, notice = license_scan.TEMPLATES[0]
    words = notice.split(" ")
    third = len(words) // 3
    wrapped = "\n".join(" ".join(words[i : i + third + 1]) for i in range(0, len(words), third + 1))
    torn = wrapped.replace("\n", "\n \t\n")
    texts = [notice, f"before it\n\n{wrapped}\n\nafter it", wrapped.replace("\n", " \r\n"), torn, f"x\n\n\n{wrapped}\nmore words"]
    write_all(folder, documents(texts))
    assert_same(spark, folder, license_scan.op3_license_scan, license_scan.ORACLE)
    scores = [r["score"] for r in license_scan.op3_license_scan(spark, folder).orderBy("doc_id").collect()]
    assert [s >= license_scan.CONTAINMENT for s in scores] == [True, True, True, False, True]
