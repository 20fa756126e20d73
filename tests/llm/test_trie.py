"""Prefix tries against brute force over random parts, and against SQL on awkward rows."""

import hashlib
import random
from collections import defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from folianta.llm import prefix_trie

from .tables import assert_same, conversations

QUERY, SQL = prefix_trie.op11_prefix_trie, prefix_trie.ORACLE


def digest(members):
    return hashlib.sha256(",".join(map(str, sorted(members))).encode()).hexdigest()


def brute_force(convs):
    nodes = defaultdict(list)
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            nodes[tuple(turns[:depth])].append(conv)
    children = defaultdict(list)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)
    rows = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        rows.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(children[node]),
            sum(not children[n] for n in below), sum((len(nodes[n]) - 1) * n[-1][1] for n in below if n),
            digest([m for m in members if len(convs[m]) == len(node)]),
        ))
    return sorted(map(str, rows))


def drawn(seed):
    pick = random.Random(seed)
    turns = [(hashlib.md5(bytes([i])).digest(), 7 * i % 5) for i in range(pick.randint(1, 3))]
    longest = pick.choice([1, 3, 6, 9])
    return {c: [pick.choice(turns) for _ in range(pick.randint(0, longest))] for c in range(pick.randint(1, 25))}


@pytest.mark.parametrize("seed", range(60))
def test_forests_of_parts_merge_to_the_trie(seed):
    convs, pick = drawn(seed), random.Random(seed)
    found = {}
    for conv, turns in convs.items():
        found.setdefault(b"".join(d for d, _ in turns), ([s for _, s in turns], []))[1].append(conv)
    keys = sorted(found)
    cuts = sorted(pick.sample(range(1, len(keys)), min(len(keys) - 1, 3)))
    parts = [keys[a:b] for a, b in zip([0, *cuts], [*cuts, len(keys)])]
    rows, merged = [], {}
    for i, part in enumerate(parts):
        left = prefix_trie.common(parts[i - 1][-1], part[0]) if i else -1
        right = prefix_trie.common(part[-1], parts[i + 1][0]) if i + 1 < len(parts) else -1
        members = [found[k][1] for k in part]
        for row in prefix_trie.forest(
            part, [found[k][0] for k in part], [len(m) for m in members], [min(m) for m in members],
            [digest(m) for m in members], left, right,
        ):
            if row[8] is None:
                rows.append(list(row))
                continue
            other = merged.setdefault(row[8], [row[0], row[1], None, 0, 0, 0, 0, None, row[8], row[9]])
            other[0], other[7] = min(other[0], row[0]), other[7] or row[7]
            for at in (3, 4, 5, 6):
                other[at] += row[at]
    rows += merged.values()
    for row in rows:
        row[2] = merged[row[9]][0] if row[9] else row[2]
    assert sorted(str((*r[:7], r[7] or prefix_trie.NOTHING)) for r in rows) == brute_force(convs)


def write(folder, rows):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = list(zip(*rows)) if rows else [[]] * 4
    table = pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "turn", "role", "text"])
    for name in ("key", "part", "n", "turns", "base", "h", "node", "digest"):
        table = table.append_column(name, pa.array(["extra"] * len(rows), pa.string()))
    pq.write_table(table, f"{folder}/conversations.parquet")


def test_awkward_rows(spark, folder):
    rows = [tuple(r.values()) for r in conversations().to_pylist()]
    rows += [(c, t, "user", f"turn {t * (c % 3 > 0)}") for c in range(100, 160) for t in range(c % 8)]
    rows += [(200, t, "user", "same") for t in range(6)] + [(c, 0, "user", "x") for c in range(201, 260)]
    rows += [(300, None, None, None), (300, None, "", ""), (300, 2, "a", "b"), (300, 2, "a", "b"), (300, 2, "ab", "")]
    rows += [(None, 0, "user", "lost"), (-7, 0, "u", "neg"), (-100, 1, "u", "neg"), (411, 0, "u", "a\U0001f600b" * 50_000)]
    rows += [(c, t, "user", "copy") for c in range(500, 2_800, 100) for t in range(3)]
    write(folder, rows)
    assert assert_same(spark, folder, QUERY, SQL, ["conversations"])


def test_empty_and_turnless(spark, folder):
    write(folder, [])
    assert QUERY(spark, folder).collect() == []
    write(folder, [(None, 0, "user", "x")])
    assert QUERY(spark, folder).collect() == []
    write(folder, [(c, 0, "user", "x") for c in range(1, 60)])  # heads are cut, no base is there
    assert assert_same(spark, folder, QUERY, SQL, ["conversations"]) == 2


@pytest.mark.parametrize("seed", [3, 8, 11, 12])
def test_small_parts_in_spark(spark, seed):
    convs = drawn(seed) | {c + 100: t for c, t in drawn(seed + 50).items()}
    rows = [(c, t) for c, t in convs.items()]
    sequences = spark.createDataFrame(rows, f"conv_id bigint, turns {prefix_trie.TURNS}")
    found = prefix_trie.prefix_trie(prefix_trie.distinct_sequences(sequences), part=2).collect()
    rows = [tuple(r[:-1]) + (r["ends"] or prefix_trie.NOTHING,) for r in found]
    assert sorted(map(str, rows)) == brute_force(convs)


def test_digest_of_many_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    turn = (b"0" * 16, 3)
    ids = list(range(-5, 400))
    sequences = spark.createDataFrame([(c, [turn]) for c in ids], f"conv_id bigint, turns {prefix_trie.TURNS}")
    row = prefix_trie.distinct_sequences(sequences).first()
    assert (row["n"], row["least"], row["ends"]) == (405, -5, digest(ids))


def test_a_deep_conversation(spark):
    turns = [(hashlib.md5(str(i).encode()).digest(), 1) for i in range(3_000)]
    rows = [(c, turns[: 3_000 - c]) for c in range(5)]
    sequences = spark.createDataFrame(rows, f"conv_id bigint, turns {prefix_trie.TURNS}")
    found = prefix_trie.prefix_trie(prefix_trie.distinct_sequences(sequences), part=1).collect()
    assert len(found) == 3_001 and max(r["n_convs"] for r in found) == 5
    assert next(r["saved_tokens"] for r in found if r["depth"] == 0) == 4 * 3_000 - 10
