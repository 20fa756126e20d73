"""Near-duplicate lines by a segment-partition edit join.

Lines within ``THRESHOLD`` = 1 edit of each other are linked. A line is split into two segments
(threshold plus one); of two linked lines the shorter one has a segment that stands unchanged
in the other, the first at its start or the second at its end. So every line is entered under
its two segments with its length, and looks them up in lines of its own length and of one
character less. Lines under one key that share a segment are verified with a banded bit-parallel
edit distance. Lines of one character are compared as a whole only: each of them is one edit from
every other one, and from all lines of two characters that hold it.

A segment that many lines share (a common beginning, a counter at the end) is not compared
pair by pair: of the part of the lines that is not known to agree, one half must agree again, so
the lines are dealt out by halves of the rest, again and again, until at most ``TOGETHER`` meet or
one character is left. Lines that still meet differ in that one place.

Scale: DataFrame functions only. The texts are read to enter keys, and once more for the lines
that share a key with another; no line is shuffled before that. Links come from groups of
bounded size, copies of a line are one row, and components are formed over links alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta.llm.graph import components
from folianta.llm.tables import numbered, small
from folianta.storage import materialize

THRESHOLD = 1
LEAST = 2
TOGETHER = 16


def _exploded(docs: DataFrame, doc_id: str) -> DataFrame:
    """``doc_id, line_no, line`` of every line that is not empty, and two hashes of it."""
    return (
        docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
        .where("line <> ''")
        .withColumns({"one": F.xxhash64("line"), "two": F.xxhash64(F.lit(1), "line")})
    )


def _segment(side: str, size: Column, start: Column, length: Column) -> Column:
    return F.xxhash64(F.lit(side), size, F.substring("line", start + 1, length))


def banded_distance(one: str, two: str, threshold: int = THRESHOLD) -> Column:
    """Edit distance of columns ``one`` and ``two``, the latter at most ``threshold`` longer.

    Exact up to ``threshold``, larger than it otherwise. A column of the distance table is two
    words of ``2 * threshold + 1`` bits, the differences between neighbours on the band around
    the diagonal; bit ``b`` of column ``j`` is row ``j - threshold + b``.
    """
    k = threshold
    full, top = (1 << (2 * k + 1)) - 1, 1 << (2 * k)
    texts = f"named_struct('r', split({one}, ''), 's', split({two}, ''))"
    # which characters of the band equal the j-th one of the longer text
    same = " + ".join(
        f"if(j + {d} >= 1 AND get(p.r, j + {d - 1}) = get(p.s, j - 1), {1 << (d + k)}, 0)"
        for d in range(-k, k + 1)
    )
    facts = f"named_struct('m', size(p.r), 'equal', transform(sequence(1, size(p.s)), j -> {same}))"
    # each character takes two steps: first the zero differences along the diagonal, then the rest
    up, down = f"(shiftright(t.up, 1) | {top})", "shiftright(t.down, 1)"
    zero = f"((((x & {up}) + {up}) ^ {up} | x | {down}) & {full})"
    first = f"named_struct('up', t.up, 'down', t.down, 'zero', {zero}, 'at', t.at + 1, 'sum', t.sum)"
    plus, minus = f"(({down} | ~(t.zero | {up})) & {full})", f"({up} & t.zero)"
    plus_above, minus_above = f"((shiftleft({plus}, 1) | 1) & {full})", f"(shiftleft({minus}, 1) & {full})"
    last_row = f"({k} + q.m - t.at)"
    moved = (
        f"if(t.at <= q.m, 1 - (shiftright(t.zero, {k}) & 1), "
        f"(shiftright({plus}, {last_row}) & 1) - (shiftright({minus}, {last_row}) & 1))"
    )
    second = (
        f"named_struct('up', ({minus_above} | ~(t.zero | {plus_above})) & {full}, "
        f"'down', t.zero & {plus_above}, 'zero', 0, 'at', t.at, 'sum', t.sum + {moved})"
    )
    start = f"named_struct('up', {((1 << k) - 1) << (k + 1)}, 'down', 0, 'zero', 0, 'at', 0, 'sum', 0)"
    step = f"transform(transform(array(u), t -> {first}), t -> {second})[0]"
    fold = f"aggregate(q.equal, {start}, (u, x) -> {step}, u -> u.sum)"
    return F.expr(f"transform(transform(array({texts}), p -> {facts}), q -> {fold})[0]")


def _entries(lines: DataFrame) -> DataFrame:
    """Keys of both segments of each line, as the shorter (or equal) and as the longer one.

    ``low, high`` bound what the key leaves open; ``longer`` is 1 for the longer line's entry.
    """
    n = F.col("size")
    entries = []
    for longer in (0, THRESHOLD):
        size = n - longer
        half = (size / 2).cast("int")
        fits = size >= LEAST
        for side, key, low, high in (
            ("L", F.col(f"left{longer}"), half, n),
            ("R", F.col(f"right{longer}"), F.lit(0), half + longer),
        ):
            entries.append(
                F.when(
                    fits,
                    F.struct(
                        key.alias("key"),
                        F.lit(longer).alias("longer"),
                        low.cast("int").alias("low"),
                        high.cast("int").alias("high"),
                    ),
                )
            )
    return lines.select("_line", F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").select("_line", "e.*")


def _halves(rows: DataFrame) -> DataFrame:
    """Rows of crowded groups under keys that also hold one half of what was left open."""
    open_ = F.col("high") - F.col("low") - F.col("longer")
    half = (open_ / 2).cast("int")
    rest = open_ - half
    halves = F.array(
        F.struct(
            F.xxhash64("key", F.lit("L"), F.substring("line", F.col("low") + 1, half)).alias("key"),
            (F.col("low") + half).alias("low"),
            F.col("high").alias("high"),
        ),
        F.struct(
            F.xxhash64("key", F.lit("R"), F.substring("line", F.col("high") - rest + 1, rest)).alias("key"),
            F.col("low").alias("low"),
            (F.col("high") - rest).alias("high"),
        ),
    )
    return rows.select("_line", "longer", F.explode(halves).alias("h")).select(
        "h.key", "_line", "longer", "h.low", "h.high"
    )


def line_classes(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per distinct line: where it first stands, copies, links and its class.

    Columns ``doc_id, line_no`` (from 0; of the smallest document id), ``n_copies``, ``n_links``
    (other distinct lines within one edit), ``class_doc_id, class_line_no`` (first place of any
    line of the class). Empty lines and null texts have none. An empty table gives no rows;
    other columns are ignored.
    """
    exploded = _exploded(docs, doc_id)
    n = F.char_length("line")
    half, shorter = (n / 2).cast("int"), ((n - 1) / 2).cast("int")
    keys = {
        "left0": _segment("L", n, F.lit(0), half),
        "right0": _segment("R", n, half, n - half),
        "left1": _segment("L", n - 1, F.lit(0), shorter),
        "right1": _segment("R", n - 1, shorter + 1, n - 1 - shorter),
    }
    written = materialize(
        exploded.select("one", "two", n.alias("size"), F.struct("doc_id", "line_no").alias("place"), *[v.alias(k) for k, v in keys.items()])
        .groupBy("one", "two")
        .agg(
            F.count("*").alias("n_copies"),
            F.min("place").alias("place"),
            *[F.max(c).alias(c) for c in ("size", *keys)],  # equal in all copies
        ),
        "distinct-lines",
    )
    lines = numbered(written, *written.columns, row="_line")
    rows = materialize(_entries(lines), "line-entries")
    pairs, texts = None, None
    while True:
        groups = rows.groupBy("key").agg(
            F.count("*").alias("met"), F.min("longer").alias("least"), F.max(F.col("high") - F.col("low") - F.col("longer")).alias("open")
        )
        groups = groups.where("met > 1 AND least = 0").select("key", ((F.col("met") > TOGETHER) & (F.col("open") > 1)).alias("crowded"))
        active = materialize(rows.join(groups, "key"), "line-groups")
        few = active.where("NOT crowded").select("key", "_line", "longer")
        met = (
            few.where("longer = 0")
            .select("key", F.col("_line").alias("a"))
            .join(few.select("key", F.col("_line").alias("b"), "longer"), "key")
            .where("(longer = 0 AND a < b) OR longer = 1")
            .select("a", "b", "longer")
        )
        pairs = met if pairs is None else pairs.unionAll(met)
        if texts is None:
            wanted = materialize(
                active.select("_line").distinct().join(lines.select("_line", "one", "two"), "_line"), "line-ids"
            )
            texts = materialize(
                exploded.join(small(wanted, 48), ["one", "two"]).groupBy("_line").agg(F.min("line").alias("line")),
                "line-texts",
            )
        crowded = active.where("crowded")
        if crowded.isEmpty():
            break
        rows = materialize(_halves(crowded.join(texts, "_line")), "line-halves")
    pairs = materialize(pairs.distinct(), "line-pairs")
    links = materialize(
        pairs.join(texts.select(F.col("_line").alias("a"), F.col("line").alias("mine")), "a")
        .join(texts.select(F.col("_line").alias("b"), F.col("line").alias("theirs")), "b")
        .where(banded_distance("mine", "theirs") <= THRESHOLD)
        .select("a", "b"),
        "line-links",
    )
    ends = links.select(F.col("a").alias("_line")).unionAll(links.select("b"))
    counts = ends.groupBy("_line").agg(F.count("*").alias("n_links"))
    roots = components(links).withColumnRenamed("node", "_line")
    placed = roots.join(lines.select("_line", "place"), "_line")
    firsts = placed.groupBy("root").agg(F.min("place").alias("class_place"))
    linked = roots.join(firsts, "root").join(counts, "_line").select("_line", "class_place", "n_links")
    return lines.join(linked, "_line", "left").select(
        "place.doc_id",
        "place.line_no",
        "n_copies",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce(F.col("class_place"), F.col("place"))["doc_id"].alias("class_doc_id"),
        F.coalesce(F.col("class_place"), F.col("place"))["line_no"].alias("class_line_no"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of all lines of all documents."""
    return line_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
WITH RECURSIVE lines AS (
    SELECT line, count(*) AS n_copies, min({'d': doc_id, 'n': line_no}) AS place, len(line) AS size
    FROM (SELECT doc_id, i - 1 AS line_no, string_split(text, chr(10))[i] AS line
          FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents))
    WHERE line <> '' GROUP BY line
), met AS (
    SELECT a.line AS a, b.line AS b, a.size AS size, b.size - a.size AS more
    FROM lines a JOIN lines b ON a.size = b.size AND left(a.line, a.size // 2) = left(b.line, a.size // 2) AND a.line < b.line
    WHERE a.size >= 2
    UNION SELECT a.line, b.line, a.size, b.size - a.size
    FROM lines a JOIN lines b ON a.size = b.size AND right(a.line, a.size - a.size // 2) = right(b.line, a.size - a.size // 2) AND a.line < b.line
    WHERE a.size >= 2
    UNION SELECT a.line, b.line, a.size, b.size - a.size
    FROM lines a JOIN lines b ON a.size = b.size - 1 AND left(a.line, a.size // 2) = left(b.line, a.size // 2)
    WHERE a.size >= 2
    UNION SELECT a.line, b.line, a.size, b.size - a.size
    FROM lines a JOIN lines b ON a.size = b.size - 1 AND right(a.line, a.size - a.size // 2) = right(b.line, a.size - a.size // 2)
    WHERE a.size >= 2
), links AS (
    SELECT a, b FROM met
    WHERE len(list_filter(range(0, size + 1), lambda i: left(a, i) = left(b, i)
              AND right(a, greatest(size - i - 1 + more, 0)) = right(b, greatest(size - i - 1 + more, 0)))) > 0
), sides AS (
    SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT x AS line, x AS other FROM sides
    UNION SELECT r.line, s.y FROM reached r JOIN sides s ON r.other = s.x
), firsts AS (
    SELECT r.line, min(l.place) AS class_place FROM reached r JOIN lines l ON r.other = l.line GROUP BY r.line
), counts AS (
    SELECT x AS line, count(*) AS n_links FROM sides GROUP BY x
)
SELECT place.d AS doc_id, place.n AS line_no, n_copies, coalesce(n_links, 0) AS n_links,
       coalesce(class_place, place).d AS class_doc_id, coalesce(class_place, place).n AS class_line_no
FROM lines LEFT JOIN firsts USING (line) LEFT JOIN counts USING (line)
"""

QUERIES = {"op7_line_dedup": op7_line_dedup}
ORACLES = {"op7_line_dedup": ORACLE}
