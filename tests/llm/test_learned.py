"""Operators that SQL cannot express, against brute force, round trips and held-out rows."""

import base64
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from folianta.llm import language, line_dedup, multi_index, neardup, token_shards
from folianta.llm.graph import components
from folianta.llm.words import split_words

from .tables import TEXTS, documents, with_extras, write_all


def read(spark, folder, name="documents"):
    return spark.read.parquet(f"{folder}/{name}.parquet")


# language identification


def test_language_of_held_out_documents(spark, sf_dir):
    found = language.op1_language_id(spark, sf_dir).join(read(spark, sf_dir).select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_awkward_rows(spark, folder):
    write_all(folder, with_extras(documents()))
    rows = {r["doc_id"]: r for r in language.op1_language_id(spark, folder).collect()}
    assert len(rows) == len(TEXTS)
    for number, text in enumerate(TEXTS):
        lettered = any(c.isalpha() for c in text or "")
        assert rows[number]["lang_pred"] in ({"en", "es"} if lettered else {"und"})
    assert rows[4]["lang_pred"] == rows[5]["lang_pred"] and rows[0]["score"] == 0


def test_language_without_anything_to_learn(spark, folder):
    docs = documents(lang=pa.nulls(len(TEXTS), pa.string()))
    write_all(folder, docs)
    assert {r["lang_pred"] for r in language.op1_language_id(spark, folder).collect()} == {"und"}
    write_all(folder, documents([]))
    assert language.op1_language_id(spark, folder).collect() == []


def test_temperature_softens_overconfidence():
    scores = np.array([[9.0, 0.0]] * 10)
    assert language.temperature_of(scores, np.array([0] * 7 + [1] * 3)) > 5
    assert language.temperature_of(scores, np.zeros(0, int)) == 1.0


# near duplicates


def near_texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(300)]
    texts = []
    for _ in range(60):
        copy = list(base)
        copy[rnd.randrange(300)] = word()
        copy[rnd.randrange(300)] = word()
        texts.append(" ".join(copy))
    shared = [word() for _ in range(60)]
    texts += [" ".join([*shared, *(word() for _ in range(150))]) for _ in range(40)]
    texts += [texts[0], texts[0].upper(), *TEXTS]
    return texts


def test_near_duplicates_equal_brute_force(spark, folder):
    texts = near_texts()
    write_all(folder, with_extras(documents(texts)))
    found = {r["doc_id"]: r for r in neardup.op10_near_duplicates(spark, folder).collect()}
    assert len(found) == len(texts)
    sets = list(neardup.shingle_sets(split_words(pa.array(texts, pa.string()))))
    counts = np.zeros(neardup.FREQUENCY_BINS, dtype=int)
    for shingles, _ in sets:
        np.add.at(counts, neardup._bins(shingles), 1)
    rare = np.log((1 + len(texts)) / (1 + counts)) / np.log(1 + len(texts))
    weight = (1 + neardup.IDF_SHARE * rare).astype(np.float32)
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(texts)):
        for b in range(a):
            if texts[a] is not None and texts[b] is not None:
                if neardup.weighted_jaccard(sets[a], sets[b], weight) >= neardup.SIMILARITY:
                    root[max(find(a), find(b))] = min(find(a), find(b))
    assert {i: r["class_id"] for i, r in found.items()} == {i: find(i) for i in range(len(texts))}
    assert {i for i, r in found.items() if r["kept"]} == {find(i) for i in range(len(texts))}


def test_near_duplicates_among_texts_of_one_template(spark, folder):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    head, tail = ([word() for _ in range(133)] for _ in range(2))
    texts = []
    for _ in range(100):
        body = [*head, *(word() for _ in range(34)), *tail]
        texts.append(" ".join(body))
        for at in rnd.sample(range(5, 125, 6), 5):
            body[at] = word()
        texts.append(" ".join(body))
    write_all(folder, documents(texts))
    found = {r["doc_id"]: r["class_id"] for r in neardup.op10_near_duplicates(spark, folder).collect()}
    assert found == {i: i - i % 2 for i in range(len(texts))}


def test_small_bands_are_compared_pair_by_pair(spark):
    rows = [(key, row, 1.0, 1, 3) for key in range(40) for row in range(3 * key, 3 * key + 3)]
    members = spark.createDataFrame(rows, "key bigint, _row bigint, total double, fame bigint, met bigint")
    pairs = {tuple(r) for r in neardup._candidates(members).collect()}
    assert pairs == {(a, b) for key in range(40) for a, b in [(3 * key, 3 * key + 1), (3 * key, 3 * key + 2), (3 * key + 1, 3 * key + 2)]}


def test_samples_agree_as_often_as_texts_are_similar():
    rnd = np.random.default_rng(0)
    shingles = rnd.integers(0, 2**63, 400).astype(np.uint64)
    agree, weights = [], rnd.uniform(0.5, 3, 400).astype(np.float32)
    for i in range(40):
        mine, theirs = np.sort(rnd.choice(400, 300, replace=False)), np.sort(rnd.choice(400, 300, replace=False))
        shared = weights[np.intersect1d(mine, theirs)].sum() / weights[np.union1d(mine, theirs)].sum()
        same = neardup.samples(shingles[mine], weights[mine]) == neardup.samples(shingles[theirs], weights[theirs])
        agree.append(same.mean() - shared)
    assert abs(np.mean(agree)) < 0.04


def test_near_duplicates_of_empty_table(spark, folder):
    write_all(folder, documents([]))
    assert neardup.op10_near_duplicates(spark, folder).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (201, 200), (200, 201)]
    found = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


# lines


def test_crowded_lines_equal_brute_force(spark, folder):
    rnd = random.Random(3)
    tail = "of the same long table of contents"
    lines = {f"row {rnd.randrange(1000):05d} {tail}" for _ in range(150)}
    lines |= {f"{tail} {rnd.choice('abcdef')}{rnd.choice('abcdefgh')}" for _ in range(60)}
    lines |= {"".join(rnd.choice("ab") for _ in range(rnd.randint(10, 14))) for _ in range(120)}
    lines |= {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(120)}
    lines = sorted(lines)
    write_all(folder, documents(["\n".join(lines[i::7]) for i in range(7)]))
    place = {line: (i % 7, i // 7) for i, line in enumerate(lines)}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return len(b) - len(a) <= 1 and (a[start + 1 :] == b[start + 1 :] if len(a) == len(b) else a[start:] == b[start + 1 :])

    long_ = [line for line in lines if len(line) > 1]
    # a line of one character is only itself
    links = {line: {x for x in long_ if x != line and near(x, line)} if line in set(long_) else set() for line in lines}
    found = {(r["doc_id"], r["line_no"]): r for r in line_dedup.op7_line_dedup(spark, folder).collect()}
    assert set(found) == set(place.values())
    for line in lines:
        seen, todo = {line}, [line]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        row = found[place[line]]
        assert row["n_links"] == len(links[line])
        assert (row["class_doc_id"], row["class_line_no"]) == min(place[x] for x in seen)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y)))
        row = nxt
    return row[-1]


@pytest.mark.parametrize("threshold", [1, 3])
def test_banded_distance(spark, threshold):
    rnd = random.Random(threshold)
    rows = []
    while len(rows) < 200:
        a = "".join(rnd.choice("abé") for _ in range(rnd.randint(1, 12)))
        b = "".join(c if rnd.random() < 0.8 else rnd.choice(["", "é", "ab"]) for c in a)
        a, b = sorted((a, b), key=len)
        if a and len(b) - len(a) <= threshold:
            rows.append((a, b))
    table = spark.createDataFrame(rows, "one string, two string")
    for a, b, d in table.select("one", "two", line_dedup.banded_distance("one", "two", threshold)).collect():
        assert min(d, threshold + 1) == min(edits(a, b), threshold + 1), (a, b)


# vectors


def test_nearest_against_brute_force(spark, sf_dir):
    found = multi_index.nearest(read(spark, sf_dir, "embeddings"), visited=0.5).collect()
    table = pq.read_table(f"{sf_dir}/embeddings.parquet").to_pydict()
    ids, rows = np.array(table["vec_id"]), np.array(table["embedding"], dtype=float)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    hits = 0
    queries = ids[ids % 50 == 0]
    for query in queries:
        scores = rows @ rows[ids == query][0]
        scores[ids == query] = -2
        mine = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert np.allclose([r["score"] for r in mine], [scores[ids == r["vec_id"]][0] for r in mine], atol=1e-12)
        hits += len({r["vec_id"] for r in mine} & set(ids[np.lexsort((ids, -scores))[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(queries)


def test_awkward_vectors(spark, folder):
    rows = [
        (0, [1.0, 0.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0, 0.0]), (2, None), (3, []), (4, [0.0] * 4),
        (5, [1.0, None, 0.0, 0.0]), (6, [float("nan"), 1.0, 0.0, 0.0]), (7, [float("inf"), 1.0, 0.0, 0.0]),
        (8, [1.0, 1.0]), (None, [1.0, 0.0, 0.0, 0.0]), (100, [0.0, 1.0, 0.0, 1e-300]), (101, [1e300, 1e300, 0.0, 0.0]),
        *((200 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(20)),
    ]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS bucket", "2 AS cell").write.parquet(
        f"{folder}/embeddings.parquet"
    )
    found = {}
    for r in multi_index.op6_nearest_neighbours(spark, folder).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    same = [1, 200, 201, 202, 203]
    assert sorted(found[0]) == [(i + 1, v, 1.0) for i, v in enumerate(same)]
    assert sorted(found[200]) == [(i + 1, v, 1.0) for i, v in enumerate([0, 1, 201, 202, 203])]
    assert sorted(found[100])[0] == (1, 101, round(0.5**0.5, 9)) and set(found) == {0, 100, 200}


def test_no_vectors(spark, folder):
    spark.createDataFrame([], "vec_id bigint, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    assert multi_index.op6_nearest_neighbours(spark, folder).collect() == []


# token shards


def test_shards_hold_every_text_once(spark, folder, monkeypatch):
    import tiktoken

    texts = [*TEXTS, " lead", "two  spaces \n and\ttabs ", "trail ", "a  b", "x" * 5_000]
    write_all(folder, with_extras(documents(texts)))
    monkeypatch.setattr(token_shards, "SHARD", 16)
    shards = spark.createDataFrame(token_shards.op8_token_shards(spark, folder).collect())
    counts = [r["sequences"] for r in shards.orderBy("shard").collect()]
    assert set(counts[:-1]) <= {16} and all(len(r["data"]) == r["stride"] * r["sequences"] for r in shards.collect())
    total = sum(counts)
    rows = sorted(token_shards.read_sequences(shards, 0, total).collect())
    assert [r["slot"] for r in rows] == list(range(total))
    with open(token_shards.VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("test", pat_str=token_shards.PIECES, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for text in texts:
        ids = [*encoding.encode_ordinary(text), token_shards.END] if text else []
        expected += [ids[at : at + token_shards.LENGTH] for at in range(0, len(ids), token_shards.LENGTH)]
    slots = token_shards.permuted(np.arange(total), total)
    assert [rows[slot]["tokens"] for slot in slots] == expected
    part = sorted(token_shards.read_sequences(shards, 14, 5).collect())
    assert part == rows[14:19]


@pytest.mark.parametrize("count", [1, 2, 3, 17, 1000, 65_537])
def test_slots_are_a_permutation(count):
    slots = token_shards.permuted(np.arange(count), count)
    assert sorted(slots.tolist()) == list(range(count))
    assert count < 100 or (slots != token_shards.permuted(np.arange(count), count, key=1)).any()


def test_no_shards(spark, folder):
    write_all(folder, documents([]))
    assert token_shards.op8_token_shards(spark, folder).collect() == []


def test_repeated_queries_are_rows_of_their_own(spark, folder):
    """Equal ids with equal, parallel and other vectors: against all pairs of rows."""
    pick = np.random.default_rng(5)
    rows = [(i, pick.normal(size=8)) for i in range(120)]
    rows += [rows[50], rows[50], (50, pick.normal(size=8)), (50, rows[50][1] * 2), (100, rows[50][1]), rows[0]]
    rows += [(i, rows[100][1]) for i in range(90, 104)] + [(7, rows[100][1])] * 3
    listed = [(i, [float(x) for x in v]) for i, v in rows]
    spark.createDataFrame(listed, "vec_id bigint, embedding array<double>").write.parquet(f"{folder}/embeddings.parquet")
    unit = np.array([v / np.linalg.norm(v) for _, v in listed])
    expected = []
    for q, (query, _) in enumerate(listed):
        if query % 50 == 0:
            near = sorted((-round(float(unit[q] @ unit[c]), 9), i) for c, (i, _) in enumerate(listed) if c != q)[:5]
            expected += [(query, rank, i, -s) for rank, (s, i) in enumerate(near, 1)]
    found = multi_index.nearest(read(spark, folder, "embeddings"), visited=1.0).collect()
    rounded = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in found]
    assert sorted(rounded) == sorted((a, b, c, d + 0.0) for a, b, c, d in expected)
    assert sum(r[0] == 50 for r in rounded) == 25
