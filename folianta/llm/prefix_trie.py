"""Trie of conversation prefixes from sorted neighbours.

A conversation is a sequence of turn digests, packed into one binary key. Keys are sorted; equal
ones are one row with a count. The common prefix of two neighbours is an edge, and edges are taken
in descending depth by a union-find: components are intervals of the sorted keys, and every merge
at a depth makes (or widens) the branching node of that depth. Between two branching nodes lies a
chain of nodes with the same members, which are listed without further search.

Scale: keys are sorted by range into parts of about ``PART`` keys and each part builds its own
forest. Only nodes on the path to the first or the last key of a part, down to the common prefix
with the neighbouring part, may go on there; these are contracted to sums keyed by a digest of
their prefix and merged by one aggregate. All values of a node (members, children, leaves, saved
tokens) are sums over an interval of keys, so part sums are enough. A prefix that a third of all
conversations share costs one row per part and depth. Texts are hashed where they are read and
never shuffled; a conversation is one row of 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianta.llm.tables import small
from folianta.storage import materialize

DIGEST = 16  # bytes of a turn's digest
PART = 20_000
BASE_EVERY = 100
HEAD_SIZES = 6
CHUNK_IDS = 2_000
NOTHING = hashlib.sha256(b"").hexdigest()
TURNS = "array<struct<digest:binary,size:int>>"
NODES = (
    "conv_id bigint, depth int, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint,"
    " saved_tokens bigint, ends string, node string, parent string"
)


def original_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turns``: digests and code points of each conversation's turns, in order."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    whole = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)
    one = F.struct(
        F.col(turn).isNotNull().alias("dated"),
        F.coalesce(F.col(turn).cast("bigint"), F.lit(0)).alias("turn"),
        F.unhex(F.substring(whole, 1, 2 * DIGEST)).alias("digest"),
        F.length(said).alias("size"),
    )
    ordered = F.array_sort(F.collect_list("one"))
    return (
        turns.select(F.col(conv_id).cast("bigint").alias("conv_id"), one.alias("one"))
        .where("conv_id IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.transform(ordered, lambda x: F.struct(x["digest"], x["size"])).cast(TURNS).alias("turns"))
    )


def with_shared_heads(conversations: DataFrame, every: int = BASE_EVERY, sizes: int = HEAD_SIZES) -> DataFrame:
    """Conversations whose first turns are those of the conversation their hundred begins with.

    The first ``crc32(conv_id) % sizes`` turns are replaced by as many of the conversation
    ``conv_id - conv_id % every``, or by none where there is no such conversation.
    """
    bases = conversations.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, sizes - 1).alias("head")
    )
    size = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % sizes).cast("int")
    rows = conversations.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", size)
    none = F.array().cast(TURNS)
    return rows.join(bases, "base", "left").select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
            F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))),
        ).alias("turns"),
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of equal conversations, joined by commas; rows come sorted by key and id."""
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        out, begin = [], 0
        for at in range(1, len(ids) + 1):
            if at == len(ids) or keys[at] != keys[begin] or at - begin == CHUNK_IDS:
                out.append((keys[begin], ids[begin], ",".join(map(str, ids[begin:at]))))
                begin = at
        columns = list(zip(*out)) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
            ["key", "first", "listed"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each key's chunks, which come one after another in order."""
    names = ["key", "ends"]
    key, state = None, None
    for batch in batches:
        done = []
        for now, listed in zip(batch.column("key").to_pylist(), batch.column("listed").to_pylist()):
            if state is not None and now == key:
                state.update(b",")
            else:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = now, hashlib.sha256()
            state.update(listed.encode())
        columns = list(zip(*done)) if done else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names)


def distinct_sequences(conversations: DataFrame) -> DataFrame:
    """``key, sizes, n, least, ends``: each distinct conversation, its members and their digest.

    A digest is one pass over its ids in order whatever the plan; ids are sorted by range and
    joined to chunks first, so that the pass over a much copied conversation reads few rows.
    """
    packed = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    rows = materialize(
        conversations.select("conv_id", packed.alias("key"), F.col("turns")["size"].alias("sizes")), "sequences"
    )
    found = materialize(
        rows.groupBy("key").agg(
            F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("least")
        ),
        "distinct-sequences",
    )
    repeated = found.where("n > 1").select(F.col("key").alias("key"))
    ends = (
        rows.select("key", "conv_id")
        .join(repeated, "key", "left_semi")
        .repartitionByRange("key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_chunks, "key binary, first bigint, listed string")
        .repartition("key")
        .sortWithinPartitions("key", "first")
        .mapInArrow(_digests, "key binary, ends string")
    )
    single = F.sha2(F.col("least").cast("string"), 256)
    return found.join(ends, "key", "left").withColumn("ends", F.coalesce("ends", single))


def common(a: bytes, b: bytes) -> int:
    """Number of first turns that two keys share."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // DIGEST
    low, high = 0, size // DIGEST
    while low + 1 < high:  # the first `low` turns agree, the first `high` do not
        middle = (low + high) // 2
        if a[: middle * DIGEST] == b[: middle * DIGEST]:
            low = middle
        else:
            high = middle
    return low


def _prefix_names(key: bytes, depth: int) -> list[str]:
    """Digest of each prefix of ``key`` from the root to ``depth`` turns."""
    state, names = hashlib.sha256(), []
    for at in range(depth + 1):
        names.append(state.hexdigest())
        state.update(key[at * DIGEST : (at + 1) * DIGEST])
    return names


class _Forest:
    """Union-find over the sorted keys of one part; a component is an interval of keys."""

    def __init__(self, keys: list[bytes], sizes: list[list[int]], counts: list[int], least: list[int], left: int, right: int):
        self.keys, self.left, self.right = keys, left, right
        self.sums = [np.concatenate([[0], np.cumsum(np.asarray(s, dtype=np.int64))]) for s in sizes]
        lengths = [len(s) for s in sizes]
        self.shared = [left] + [common(a, b) for a, b in zip(keys, keys[1:])]
        after = self.shared[1:] + [right]
        totals = [int(s[-1]) for s in self.sums]
        self.root = list(range(len(keys)))
        self.first, self.last = list(self.root), list(self.root)
        self.top = lengths
        self.n, self.least = list(counts), list(least)
        self.children = [0] * len(keys)
        self.leaves = [int(a < b) for a, b in zip(after, lengths)]
        self.weighted = [c * t for c, t in zip(counts, totals)]
        # what the nodes weigh that a key does not share with the one before it
        self.own = [t - int(s[max(d, 0)]) for t, s, d in zip(totals, self.sums, self.shared)]
        self.fresh = [0] * len(keys)  # summed over a component's keys but the first
        self.below: list[list[int]] = [[] for _ in keys]
        self.chains: list[tuple] = []
        self.parents: list[int] = []

    def find(self, at: int) -> int:
        while self.root[at] != at:
            self.root[at] = self.root[self.root[at]]
            at = self.root[at]
        return at

    def close(self, at: int, depth: int) -> None:
        """List the nodes of a component below ``depth``; it hangs on a node of that depth next."""
        number = len(self.chains)
        self.chains.append(
            (self.first[at], self.last[at], depth + 1, self.top[at], self.n[at], self.least[at],
             self.children[at], self.leaves[at], self.weighted[at], self.fresh[at])
        )
        self.parents.append(-1)
        for chain in self.below[at]:
            self.parents[chain] = number
        self.below[at], self.children[at], self.top[at] = [number], 1, depth

    def grow(self) -> None:
        edges = np.asarray(self.shared[1:], dtype=np.int64)
        for edge in np.argsort(-edges, kind="stable"):
            depth = int(edges[edge])
            a, b = self.find(int(edge)), self.find(int(edge) + 1)
            for side in (a, b):
                if self.top[side] > depth:
                    self.close(side, depth)
            if len(self.below[a]) < len(self.below[b]):
                self.below[a], self.below[b] = self.below[b], self.below[a]
            self.below[a] += self.below[b]
            self.root[b], self.last[a], self.below[b] = a, self.last[b], []
            for values in (self.n, self.children, self.leaves, self.weighted):
                values[a] += values[b]
            self.fresh[a] += self.fresh[b] + self.own[self.first[b]]
            self.least[a] = min(self.least[a], self.least[b])
        self.close(self.find(0), -1)


def forest(keys: list[bytes], sizes: list[list[int]], counts: list[int], least: list[int], ends: list[str], left: int, right: int) -> list[tuple]:
    """Nodes of one part as rows of ``NODES``.

    ``left`` and ``right`` are the first turns shared with the neighbouring parts (-1: there is
    no such part). A node that may go on there carries the digest of its prefix as ``node`` and
    only this part's share of each value; a node under such a one has its digest as ``parent``.
    """
    tree = _Forest(keys, sizes, counts, least, left, right)
    tree.grow()
    edge_names = _prefix_names(keys[0], max(left, 0)), _prefix_names(keys[-1], max(right, 0))
    end = len(keys) - 1

    def name(first: int, last: int, depth: int) -> str | None:
        if first == 0 and depth <= left:
            return edge_names[0][depth]
        return edge_names[1][depth] if last == end and depth <= right else None

    rows = []
    for (first, last, low, high, n, smallest, children, leaves, weighted, fresh), up in zip(tree.chains, tree.parents):
        sums = tree.sums[first]
        for depth in range(high, low - 1, -1):
            above = (first, last, smallest) if depth > low else None
            if above is None and up >= 0:
                above = tree.chains[up][0], tree.chains[up][1], tree.chains[up][5]
            node = name(first, last, depth)
            parent = name(above[0], above[1], depth - 1) if above else None
            before = int(sums[depth - 1]) if depth else 0
            elsewhere = first == 0 and depth <= left  # the node begins in an earlier part
            own = tree.own[0] if elsewhere else int(sums[-1]) - before
            below = (children if depth == high else 1) - (elsewhere and depth < left)
            final = ends[first] if depth == len(sums) - 1 and not elsewhere else None
            rows.append(
                (smallest, depth, above[2] if above and parent is None else None, n, below, leaves,
                 weighted - n * before - fresh - own, final, node, parent)
            )
    return rows


def _grow(table: pa.Table) -> pa.Table:
    table = table.take(pc.sort_indices(table, [("key", "ascending")]))
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    columns = [table.column(c).to_pylist() for c in ("key", "sizes", "n", "least", "ends")]
    rows = forest(*columns, left, right)
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, *[pa.string()] * 3]
    names = [part.split(" ")[0] for part in NODES.split(", ")]
    return pa.table([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)


def _parts(sequences: DataFrame, part: int) -> DataFrame:
    """``sequences`` in sorted parts, each with the turns it shares with its neighbours."""
    spark = sequences.sparkSession
    rows = materialize(sequences, "numbered-sequences")
    wanted = max(1, -(-rows.count() // part))
    placed = materialize(
        rows.repartitionByRange(wanted, "key").withColumn("part", F.spark_partition_id()), "sorted-sequences"
    )
    edges = materialize(placed.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")), "part-edges")
    used = sorted(row["part"] for row in edges.select("part").collect())  # one number a part
    beside = spark.createDataFrame(list(zip(used, used[1:])), "a int, b int")
    shared = F.udf(lambda a, b: common(bytes(a), bytes(b)), "int")
    met = (
        beside.join(edges.select(F.col("part").alias("a"), "high"), "a")
        .join(edges.select(F.col("part").alias("b"), "low"), "b")
        .select("a", "b", shared("high", "low").alias("shared"))
        .collect()
    )
    left, right = {r["b"]: r["shared"] for r in met}, {r["a"]: r["shared"] for r in met}
    bounds = spark.createDataFrame(
        [(p, left.get(p, -1), right.get(p, -1)) for p in used], "part int, left int, right int"
    )
    return placed.join(F.broadcast(bounds), "part")  # three integers a part


def prefix_trie(sequences: DataFrame, part: int = PART) -> DataFrame:
    """All nodes of the trie over ``sequences`` (as from :func:`distinct_sequences`)."""
    found = materialize(_parts(sequences, part).groupBy("part").applyInArrow(_grow, NODES), "part-forests")
    merged = materialize(
        found.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"), F.max("ends").alias("ends"), F.max("parent").alias("parent"),
        ),
        "merged-nodes",
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("_above"))
    rest = found.where("node IS NULL").drop("node").unionByName(
        merged.withColumn("parent_conv_id", F.lit(None).cast("bigint")).drop("node")
    )
    return (
        rest.join(small(above, 112), "parent", "left")
        .withColumn("parent_conv_id", F.coalesce("_above", "parent_conv_id"))
        .select(*columns)
    )


def conversation_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    rebuild=with_shared_heads,
    part: int = PART,
) -> DataFrame:
    """One row per distinct prefix of (role, text) turns.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the prefix one turn shorter
    (null at the root), ``ends`` the digest of the members that end there. ``rebuild`` maps the
    ordered turns first. Turns are ordered by ``turn``, null first, equal ones by digest; null
    roles and texts are empty; rows without a conversation id are left out; repeated rows are
    turns of their own. A turn of any length is one digest. Other columns are ignored, and an
    empty table gives no rows, not even a root.
    """
    turns = original_turns(conversations, conv_id, turn, role, text)
    return prefix_trie(distinct_sequences(rebuild(turns)), part)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    nodes = conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return nodes.select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )


ORACLE = f"""
WITH crc AS MATERIALIZED (
    SELECT list(list_reduce(range(0, 8),
                lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t
    FROM range(0, 256) AS bytes(b)),
turns AS (
    SELECT conv_id, list({{'d': d, 'n': n}} ORDER BY turn NULLS FIRST, d) AS turns FROM (
        SELECT conv_id, turn, length(coalesce(text, '')) AS n,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS d
        FROM conversations WHERE conv_id IS NOT NULL)
    GROUP BY conv_id),
heads AS (
    SELECT conv_id, turns,
           xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)),
               lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)]), 4294967295), 4294967295) % {HEAD_SIZES} AS h
    FROM turns, crc),
rebuilt AS MATERIALIZED (
    SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
    FROM heads a LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % {BASE_EVERY}),
members AS MATERIALIZED (
    SELECT conv_id, d, len(turns) AS size, CASE WHEN d > 0 THEN turns[d].n ELSE 0 END AS n,
           array_to_string(list_transform(turns[1:d], lambda x: x.d), '') AS p,
           array_to_string(list_transform(turns[1:d - 1], lambda x: x.d), '') AS up
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS MATERIALIZED (
    SELECT d AS depth, p, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * any_value(n) AS saved, max(size) = d AS leaf,
           sha256(coalesce(string_agg(CASE WHEN size = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends
    FROM members GROUP BY d, p),
sums AS (
    SELECT p, sum(saved) AS saved, sum(leaf::INT) AS leaves FROM (
        SELECT saved, leaf, p[1 : 32 * unnest(range(0, depth + 1))] AS p FROM nodes) GROUP BY p)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs,
       (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.up = n.p) AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s ON s.p = n.p LEFT JOIN nodes u ON n.depth > 0 AND u.depth = n.depth - 1 AND u.p = n.up
"""

QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLES = {"op11_prefix_trie": ORACLE}
