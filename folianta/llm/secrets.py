"""Secret scan with an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger holds a row for
each scan of a blob: the versions of the rules that were applied and what they found. Only blobs
with a rule version that the ledger lacks for them are scanned, each once however many paths
and versions carry it, and only for the rules it lacks; findings are then joined back to all
paths. A changed pattern is a new version and is scanned for again, the rest is not.

Scale: DataFrame functions only. A first read addresses the texts and leaves narrow rows; a
second one joins the texts with the rows to scan, by row, so that texts move once at most and
evenly, however many copies one has. Copies are counted before they are shuffled.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianta.llm.tables import numbered
from folianta.storage import materialize, shared_dir


@dataclass(frozen=True)
class Rule:
    """Non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters.

    ``hint``: a fixed text that every match holds, to skip most texts without the pattern.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hint: str | None = None

    @property
    def version(self) -> str:
        facts = f"{self.pattern}\n{self.group}\n{self.least}"
        return f"{self.kind}@{hashlib.sha256(facts.encode()).hexdigest()[:12]}"


# A run of hex digits is matched as a whole, so its least length may stand in the pattern; the
# same holds for access keys, whose match goes on to the end of the run.
BASE = [
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}", hint="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
OWN = [
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]+ ){0,4}PRIVATE KEY-----", hint="-----BEGIN "),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint="eyJ"),
    Rule("hosting", r"gh[oprsu]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Rule("bearer", r"[Bb]earer\x20+[A-Za-z0-9._~+/-]{20,}=*", hint="earer"),
]
RULES = BASE + OWN
FINDINGS = "array<struct<start:int,place:int,kind:string,end:int,rule:string>>"


def _matches(rule: Rule, place: int) -> Column:
    """Lengths of the texts before, in and of interest in each match; null without a match."""
    lengths = lambda pieces: F.transform(pieces, F.char_length)
    pattern = F.lit(rule.pattern)
    has = F.col("text").rlike(rule.pattern)
    if rule.hint:
        has = F.col("text").contains(rule.hint) & has
    found = F.struct(
        F.lit(place).alias("place"),
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.version).alias("rule"),
        F.lit(rule.least).alias("least"),
        F.arrays_zip(
            lengths(F.split("text", rule.pattern, -1)).alias("gap"),
            lengths(F.regexp_extract_all("text", pattern, F.lit(0))).alias("whole"),
            lengths(F.regexp_extract_all("text", pattern, F.lit(rule.group))).alias("part"),
        ).alias("matches"),
    )
    return F.when(F.array_contains("missing", rule.version) & has, found)


def find_spans(blobs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``blob, findings`` of blobs (``blob, text, missing``) in which a missing rule finds some.

    A match starts after all earlier matches and the texts between them; positions are code
    points, the end is exclusive.
    """
    found = F.array(*[_matches(rule, place) for place, rule in enumerate(rules)])
    rows = (
        blobs.select("blob", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f"))
        .select("blob", "f.place", "f.kind", "f.rule", "f.least", F.posexplode("f.matches").alias("n", "m"))
        .where("m.whole IS NOT NULL")
    )
    upto = Window.partitionBy("blob", "place").orderBy("n")
    return (
        rows.withColumn("end", F.sum(F.col("m.gap") + F.col("m.whole")).over(upto).cast("int"))
        .where("m.part >= least")
        .select("blob", F.struct(F.expr("end - m.whole AS start"), "place", "kind", "end", "rule").alias("f"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list("f")).alias("findings"))
    )


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; none before the first scan."""
    schema = f"blob binary, rules array<string>, findings {FINDINGS}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def scan_versions(
    versions: DataFrame, keys: list[str], ledger: str, rules: list[Rule] = RULES
) -> DataFrame:
    """``keys`` of every row of ``versions`` (with a ``text``) and its ``findings`` in order.

    Scans what the ledger at path ``ledger`` lacks and appends it there. Null texts count as
    empty; rows that repeat a key are versions of their own; an empty table gives no rows and
    leaves the ledger as it was; other columns are ignored. ``versions`` must be a plain scan of
    files, as its rows are known by their place there.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    source = numbered(versions, *keys, text.alias("text"), F.unhex(F.sha2(text, 256)).alias("blob"))
    addressed = materialize(source.drop("text"), "blob-versions")
    wanted = F.array(*[F.lit(rule.version) for rule in rules])
    seen = _ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
    pending = materialize(
        addressed.groupBy("blob")
        .agg(F.min("_row").alias("_row"))
        .join(seen, "blob", "left")
        .select("blob", "_row", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("missing"))
        .where("size(missing) > 0"),
        "pending-blobs",
    )
    chosen = source.select("_row", "text").join(pending, "_row")
    found = materialize(find_spans(chosen, rules), "new-findings")
    pending.join(found, "blob", "left").select(
        "blob", F.col("missing").alias("rules"), F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings")
    ).write.mode("append").parquet(ledger)
    known = (
        _ledger(spark, ledger)
        .where("size(findings) > 0")
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("findings")).alias("findings"))
    )
    current = F.filter("findings", lambda f: F.array_contains(wanted, f["rule"]))
    return addressed.join(known, "blob", "left").select(
        *keys, F.coalesce(F.array_sort(current), F.array().cast(FINDINGS)).alias("findings")
    )


def _spans(findings: Column) -> Column:
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))),
        ",",
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, scanned into a new ledger."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan_versions(docs, ["doc_id"], shared_dir(spark, "secret-ledger"))
    base = [rule.kind for rule in BASE]
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(_spans(F.filter("findings", lambda f: f["kind"].isin(base))), 256).alias("base_sha256"),
        _spans(F.col("findings")).alias("spans"),
    )


def _rule_sql(place: int, rule: Rule) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least,
           string_split_regex(t, {pattern}) AS gaps, regexp_extract_all(t, {pattern}) AS wholes,
           regexp_extract_all(t, {pattern}, {rule.group}) AS parts FROM texts"""


ORACLE = f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t FROM documents
), scans AS (
    {" UNION ALL ".join(_rule_sql(place, rule) for place, rule in enumerate(RULES))}
), matches AS (
    SELECT doc_id, place, kind, least, i, len(gaps[i]) AS gap, len(wholes[i]) AS whole, len(parts[i]) AS part
    FROM (SELECT *, unnest(range(1, len(wholes) + 1)) AS i FROM scans)
), spans AS (
    SELECT doc_id, place, kind, least, whole, part,
           CAST(sum(gap + whole) OVER (PARTITION BY doc_id, place ORDER BY i) AS BIGINT) AS stop
    FROM matches
), lists AS (
    SELECT doc_id,
           count(*) FILTER (kind = 'assign') AS n_assign,
           count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || (stop - whole) || ':' || stop, ',' ORDER BY stop - whole, place) FILTER (place < 3) AS base,
           string_agg(kind || ':' || (stop - whole) || ':' || stop, ',' ORDER BY stop - whole, place) AS every
    FROM spans WHERE part >= least GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM texts LEFT JOIN lists USING (doc_id)
"""

QUERIES = {"op4_secret_scan": op4_secret_scan}
ORACLES = {"op4_secret_scan": ORACLE}
