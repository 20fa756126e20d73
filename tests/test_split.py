import math
import random
from collections import Counter

import pytest

from folianta.operators import split


def corpus(spark, sizes):
    rows = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(
        [(at, c) for at, (_, c) in enumerate(rows)], "doc_id bigint, type string"
    ).repartition(5)


def largest_remainder(sizes, target):
    total = sum(sizes.values())
    exact = {c: n * target / total for c, n in sizes.items()}
    quota = {c: math.floor(x) for c, x in exact.items()}
    order = sorted(sizes, key=lambda c: (quota[c] - exact[c], c))
    for c in order[: target - sum(quota.values())]:
        quota[c] += 1
    return quota


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize(
    "sizes", [{"a": 50, "b": 30, "c": 21}, {"a": 1000, "b": 11, "c": 10}, {"a": 7, "b": 7, "c": 7}]
)
def test_three_way_sizes_are_exact(spark, sizes, seed):
    df = corpus(spark, sizes)
    parted = split.three_way_split(df, "doc_id", seed=seed)
    got = Counter((r["type"], r["split"]) for r in parted.collect())
    total = sum(sizes.values())
    train = largest_remainder(sizes, total - math.ceil(0.3 * total))
    held = {c: sizes[c] - train[c] for c in sizes if sizes[c] - train[c] >= 2}
    val = largest_remainder(held, sum(held.values()) - math.ceil(0.5 * sum(held.values())))
    expected = Counter()
    for c in sizes:
        expected[(c, "train")] = train[c]
        if c in held:
            expected[(c, "val")] = val[c]
            expected[(c, "test")] = held[c] - val[c]
    assert got == +expected


def test_null_classes_are_refused(spark):
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else "a") for i in range(100)], "k bigint, type string")
    with pytest.raises(ValueError, match="null"):
        split.stratified_split(rows, "k")


def test_published_sizes():
    total = 19974
    held = math.ceil(0.30 * total)
    assert (total - held, held - math.ceil(held / 2), math.ceil(held / 2)) == (13981, 2996, 2997)


def test_split_depends_on_seed_and_not_on_partitions(spark):
    df = corpus(spark, {"a": 80, "b": 40})

    def sides(frame, seed):
        return {r["doc_id"]: r["split"] for r in split.stratified_split(frame, "doc_id", seed=seed).collect()}

    assert sides(df, 1) == sides(df.coalesce(1), 1) == sides(df.repartition(8), 1)
    assert sides(df, 1) != sides(df, 2)


def test_matches_brute_force_order(spark):
    import hashlib

    df = corpus(spark, {"a": 60, "b": 45})
    rows = df.collect()
    train = largest_remainder({"a": 60, "b": 45}, 105 - math.ceil(0.3 * 105))
    expected = set()
    for c in ("a", "b"):
        keys = [r["doc_id"] for r in rows if r["type"] == c]
        keys.sort(key=lambda k: (hashlib.md5(f"{k}:s".encode()).hexdigest(), k))
        expected |= set(keys[: train[c]])
    got = split.stratified_split(df, "doc_id", seed="s").filter("split = 'train'").collect()
    assert {r["doc_id"] for r in got} == expected


def test_rare_classes(spark):
    df = corpus(spark, {"a": 30, "b": 9, "c": 10})
    kept = {r["type"] for r in split.drop_rare_classes(df).collect()}
    assert kept == {"a", "c"}
    parted = split.three_way_split(df, "doc_id", min_rows=10)
    assert {r["type"] for r in parted.collect()} == {"a", "c"}


def test_impossible_splits_fail(spark):
    with pytest.raises(Exception, match="single row"):
        split.stratified_split(corpus(spark, {"a": 20, "b": 1}), "doc_id").collect()
    with pytest.raises(Exception, match="fewer rows than there are classes"):
        split.stratified_split(corpus(spark, {c: 2 for c in "abcdef"}), "doc_id", held_out_share=0.1).collect()


def test_integrity(spark):
    df = corpus(spark, {"a": 50, "b": 50})
    parted = split.three_way_split(df, "doc_id")
    facts = {r["measure"]: r["value"] for r in split.split_integrity(df, parted, "doc_id").collect()}
    assert facts == {
        "rows_train": 70, "rows_val": 15, "rows_test": 15, "in_two_parts": 0, "lost": 0, "invented": 0,
    }


def test_unbounded_class_tables_take_the_shuffle_path(spark, monkeypatch):
    monkeypatch.setattr(split, "bounded_table", lambda df, *_: df)
    df = corpus(spark, {"a": 50, "b": 30})
    whole = {r["doc_id"]: r["split"] for r in split.three_way_split(df, "doc_id").collect()}
    monkeypatch.undo()
    assert whole == {r["doc_id"]: r["split"] for r in split.three_way_split(df, "doc_id").collect()}
