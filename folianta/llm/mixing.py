"""Mixing sources to target weights by capped water-filling.

Every source gets the share of all words that its weight asks for, but no more than
``max_epochs`` times its own words; what a clamped source leaves goes to the others by weight,
until none is above its cap. A source's documents are then taken as many whole times as fit,
and the rest of its target is filled with one more copy of the documents that come first in a
seeded order. The order is that of a keyed hash of id and text, so a rerun takes the same ones
and the words taken miss the target by less than one document.

Scale: filling works on one row per source, in rounds of one small aggregate each. The cut in
the seeded order is found from a histogram of hash prefixes and the rows of the one prefix that
holds it, so a source with a third of all rows is neither sorted nor gathered. What remains is
a comparison with a threshold on each row where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianta.llm.tables import small
from folianta.operators.positions import number_rows
from folianta.storage import materialize

WEIGHTS = [5, 2, 1]
MAX_EPOCHS = 3
SEED = 17
WORDS = r"[^\x20\x09-\x0D]+"
PREFIX_BITS = 12
HASH_BITS = 60


def place(key: Column, text: Column, seed: int) -> Column:
    """A row's place in the seeded order: 60 bits of a hash of its id and text."""
    digest = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.coalesce(key.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def sized(docs: DataFrame, doc_id: str, source: str, seed: int) -> DataFrame:
    """``docs`` with ``_size`` (words of the text, null: 0), ``_source`` and ``_place``."""
    return docs.withColumns(
        {
            "_size": F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint"),
            "_source": F.col(source),
            "_place": place(F.col(doc_id), F.col("text"), seed),
        }
    )


def fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """``sources`` (columns ``_source, weight, source_size``) with ``target``.

    Each round shares what clamped sources leave; shares only grow, so a source clamped once
    stays so and the rounds end, in practice after a few.
    """
    cap = max_epochs * F.col("source_size")
    wide = "decimal(20,0)"
    left, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, left, weights, clamped = left or 0, left or 0, weights or 0, 0
    while True:
        above = F.lit(left).cast(wide) * F.col("weight").cast(wide) > cap.cast(wide) * F.lit(weights).cast(wide)
        count, held, free = sources.agg(
            F.coalesce(F.count_if(above), F.lit(0)),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if count == clamped:
            break
        left, weights, clamped = total - held, free, count
    share = (F.lit(left).cast("bigint") * F.col("weight")).cast("double") / F.lit(float(weights or 1))
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(share))


def plan_mix(
    rows: DataFrame, weights: list[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Per source: ``source_size, target, whole`` copies of each document, and ``last``.

    ``rows`` is a written table of ``_source, _size, _place``. Documents whose place is at most
    ``last`` are taken once more.
    """
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    ranked = number_rows(sizes, ["_source"], "_at")
    weight = F.element_at(
        F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("_at") % len(weights) + 1).cast("int")
    )
    targets = fill(
        materialize(ranked.select("_source", "source_size", weight.alias("weight")), "mix-sources"),
        max_epochs,
    )
    whole = F.when(
        F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))
    ).otherwise(0)
    targets = materialize(
        targets.withColumn("whole", whole.cast("bigint")).withColumn(
            "rest", F.col("target") - (F.col("whole") * F.col("source_size")).cast("double")
        ),
        "mix-targets",
    )
    prefix = F.shiftright("_place", HASH_BITS - PREFIX_BITS)
    upto = Window.partitionBy("_source").orderBy("prefix")
    histogram = (
        rows.groupBy("_source", prefix.alias("prefix"))
        .agg(F.sum("_size").alias("words"))
        .withColumn("upto", F.sum("words").over(upto))
    )
    facts = small(targets.select(F.col("_source").alias("of"), "rest"), 64)
    cuts = (
        histogram.join(facts, F.col("_source").eqNullSafe(F.col("of")))
        .where((F.col("rest") > 0) & (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")))
        .select("of", "prefix", (F.col("upto") - F.col("words")).alias("before"), "rest")
    )
    cuts = materialize(cuts, "mix-cuts")
    at_cut = rows.select("_source", "_size", "_place", prefix.alias("at")).join(
        small(cuts, 64), F.col("_source").eqNullSafe(F.col("of")) & (F.col("at") == F.col("prefix"))
    )
    ordered = Window.partitionBy("of").orderBy("_place")
    edge = (
        at_cut.groupBy("of", "_place", "before", "rest")
        .agg(F.sum("_size").alias("words"))
        .withColumn("upto", F.col("before") + F.sum("words").over(ordered))
        .where(2 * F.col("upto") - F.col("words") <= 2 * F.col("rest"))
        .groupBy("of")
        .agg(F.max("_place").alias("edge"))
    )
    ends = cuts.select(
        F.col("of").alias("cut_of"), (F.shiftleft("prefix", HASH_BITS - PREFIX_BITS) - 1).alias("start")
    ).join(edge, F.col("cut_of").eqNullSafe(F.col("of")), "left")
    ends = ends.select("cut_of", F.coalesce("edge", "start").alias("last"))
    without = F.when(F.col("rest") > 0, F.lit((1 << HASH_BITS) - 1)).otherwise(F.lit(-1))
    return materialize(
        targets.join(ends, F.col("_source").eqNullSafe(F.col("cut_of")), "left").select(
            F.col("_source").alias("of"),
            "source_size",
            "target",
            "whole",
            F.coalesce("last", without).cast("bigint").alias("last"),
        ),
        "mix-plan",
    )


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with ``_source, _place``) and, per row, its source's plan and ``copies``."""
    return rows.join(small(plan, 128), F.col("_source").eqNullSafe(F.col("of"))).withColumn(
        "copies", F.col("whole") + (F.col("_place") <= F.col("last")).cast("bigint")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: list[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, source_size, target, size, copies``, one row per row of ``docs``.

    Null texts and texts of white space have size 0 and add no words; a null source is a source
    of its own, ranked last; rows that agree in id and text are taken together. An empty table
    gives no rows; other columns are ignored.
    """
    rows = materialize(
        sized(docs, doc_id, source, seed).select(F.col(doc_id).alias("_id"), "_source", "_size", "_place"),
        "mix-rows",
    )
    return with_copies(rows, plan_mix(rows, weights, max_epochs)).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        "copies",
    )


def repeat_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: list[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix` takes it, same columns."""
    rows = sized(docs.select(F.struct(*docs.columns).alias("_doc"), doc_id, source, "text"), doc_id, source, seed)
    rows = rows.select("_doc", "_source", "_size", "_place")
    plan = plan_mix(
        materialize(rows.select("_source", "_size", "_place"), "mix-rows"), weights, max_epochs
    )
    taken = with_copies(rows, plan).where("copies > 0")
    return taken.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words taken of each."""
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


# The clamped sources are those first in order of size over weight: the fewest for which the
# share of the rest lies under the cap of the next one.
FILL_SQL = r"""
sized AS (
    SELECT doc_id, text, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS place
    FROM documents
), sources AS (
    SELECT source, source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
), steps AS (
    SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS BIGINT) AS remaining,
           CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weights
    FROM sources
    WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT arg_min(remaining, source_size / weight) AS remaining, arg_min(weights, source_size / weight) AS weights,
           min(source_size / weight) AS first_free
    FROM steps WHERE remaining * weight <= 3 * source_size * weights
), targets AS (
    SELECT source, source_size,
           CASE WHEN level.remaining * weight > 3 * source_size * level.weights THEN CAST(3 * source_size AS DOUBLE)
                ELSE CAST(level.remaining * weight AS DOUBLE) / level.weights END AS target
    FROM sources, level
), parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS whole
    FROM targets
), ordered AS (
    SELECT d.doc_id, d.text, d.source, d.size, p.source_size, p.target, p.whole,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place) AS upto,
           sum(d.size) OVER (PARTITION BY d.source, d.place) AS words,
           p.target - CAST(p.whole * p.source_size AS DOUBLE) AS rest
    FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
), mixed AS (
    SELECT *, whole + CASE WHEN 2 * upto - words <= 2 * rest AND rest > 0 THEN 1 ELSE 0 END AS copies FROM ordered
)
"""
ORACLE = f"""
WITH {FILL_SQL}
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken FROM mixed
"""

QUERIES = {"op5_mixing": op5_mixing}
ORACLES = {"op5_mixing": ORACLE}
