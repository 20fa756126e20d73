"""Harvest responses landed as XML files: records, response audit, metadata formats."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folianta.fixed_values import DUBLIN_CORE_FIELDS, NAMESPACES
from folianta.functions.text import scalar_or_list
from folianta.storage import bounded_table, materialize

ACTIVE = "active"
DELETED = "deleted"

DC_STRUCT = T.StructType(
    [T.StructField(f"dc:{name}", T.ArrayType(T.StringType())) for name in DUBLIN_CORE_FIELDS]
)
RECORD_SCHEMA = T.StructType(
    [
        T.StructField(
            "header",
            T.StructType(
                [
                    T.StructField("_status", T.StringType()),
                    T.StructField("identifier", T.StringType()),
                    T.StructField("datestamp", T.StringType()),
                    T.StructField("setSpec", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("metadata", T.StructType([T.StructField("oai_dc:dc", DC_STRUCT)])),
    ]
)
DAMAGED = "_damaged"
XML_OPTIONS = {
    "rowTag": "record",
    "ignoreSurroundingSpaces": "false",
    "attributePrefix": "_",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": DAMAGED,
}
RECORD_END = "</record>"
RECORD_START = r"(?=<record[\s>/])"
PREFIXED_RECORD = r"<[\w.-]+:record[\s>/][^<]*"
OAI, OAI_DC, DC = (NAMESPACES[name] for name in ("oai", "oai_dc", "dc"))
HEADER_FIELDS = ["identifier", "datestamp", "setSpec"]
DECLARATION = r"""xmlns(?::([\w.-]+))?\s*=\s*["']([^"']*)["']"""


def shape_records(raw: DataFrame) -> DataFrame:
    """Raw record elements as ``(identifier, status, datestamp, sets, dc)``.

    Every Dublin Core field is an array of its distinct non-empty values in document order;
    ``dc`` is null where a record carries no metadata. A stamp that is no time gives a null
    ``datestamp``; ``stamp`` keeps its text.
    """
    metadata = F.col("metadata")["oai_dc:dc"]

    def values(name: str) -> Column:
        found = F.filter(metadata[f"dc:{name}"], lambda v: v.isNotNull() & (v != ""))
        return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))

    fields = F.struct(*[values(name).alias(name) for name in DUBLIN_CORE_FIELDS])
    return raw.select(
        F.coalesce(F.col("header.identifier"), F.lit("")).alias("identifier"),
        F.coalesce(F.col("header._status"), F.lit(ACTIVE)).alias("status"),
        F.try_to_timestamp("header.datestamp").alias("datestamp"),
        F.col("header.datestamp").alias("stamp"),
        F.coalesce("header.setSpec", F.array().cast("array<string>")).alias("sets"),
        F.when(metadata.isNotNull(), fields).alias("dc"),
    )


def _elements(lines: DataFrame) -> DataFrame:
    """``(element, record)`` of every record element that begins in a piece of text.

    ``lines`` end where a record does. An element is parsed by itself: of
    several that begin in one piece only the last was closed, so the others are damaged, and no
    element takes its neighbours with it. ``record`` has the text of a damaged one in DAMAGED.
    """
    # what stands before the first element is never one, so it must not be nothing
    found = F.split(F.concat(F.lit(" "), "value"), RECORD_START)
    found = F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0)))
    rest = [name for name in lines.columns if name != "value"]
    each = lines.select(*rest, F.size(found).alias("n"), F.posexplode(found).alias("at", "element"))
    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField(DAMAGED, T.StringType())])
    closed = F.when(F.col("at") == F.col("n") - 1, F.concat("element", F.lit(RECORD_END)))
    parsed = F.from_xml(F.coalesce(closed, F.lit("<record>")), schema, XML_OPTIONS)
    return each.select(*rest, "element", parsed.alias("record"))


def _whole(elements: DataFrame) -> DataFrame:
    good = elements.filter(F.col(f"record.{DAMAGED}").isNull() & F.col("record.header").isNotNull())
    return shape_records(good.select("record.header", "record.metadata"))


def read_records(spark: SparkSession, path: str | Sequence[str], by_namespace: bool = False) -> DataFrame:
    """One row per well-formed ``record`` element with a header below ``path``.

    Names are taken as they are written: ``record``, ``oai_dc:dc``, ``dc:title``. With
    ``by_namespace`` they are taken by the namespace that their prefix stands for in the response,
    whatever the prefix, at the cost of reading the files once more for their declarations and
    once for each prefix in use. What is left out is what :func:`damaged_records` gives.
    """
    if by_namespace:
        return _whole(_canonical_elements(spark, path))
    return _whole(_elements(spark.read.text(path, lineSep=RECORD_END)))


def damaged_records(spark: SparkSession, path: str | Sequence[str], by_namespace: bool = False) -> DataFrame:
    """``(file, element)``: record elements that :func:`read_records` does not read.

    They are not well-formed or lack a header. Unless names are taken by namespace, elements
    whose tag has a prefix are among them.
    """
    if by_namespace:
        parts = _canonical_elements(spark, path)
    else:
        lines = spark.read.text(path, lineSep=RECORD_END).select("value", F.col("_metadata.file_path").alias("file"))
        parts = _elements(lines)
    bad = parts.filter(F.col(f"record.{DAMAGED}").isNotNull() | F.col("record.header").isNull())
    bad = bad.select("file", "element")
    if by_namespace:
        return bad
    prefixed = F.explode(F.regexp_extract_all("value", F.lit(PREFIXED_RECORD), F.lit(0)))
    return bad.unionAll(lines.select("file", prefixed.alias("element")))


def declared_prefixes(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file, prefix, uri)``: namespaces declared in each file; a default has an empty prefix.

    Files are read tag by tag, so that one of any size is read by many tasks.
    """
    tags = spark.read.text(path, lineSep=">").select("value", F.col("_metadata.file_path").alias("file"))
    found = [F.regexp_extract_all("value", F.lit(DECLARATION), F.lit(at)) for at in (1, 2)]
    pairs = F.arrays_zip(*[values.alias(name) for values, name in zip(found, ("prefix", "uri"))])
    return tags.filter(F.contains("value", F.lit("xmlns"))).select("file", F.inline(pairs)).distinct()


def canonical_record(element: str, outside: Mapping[str, str]) -> str | None:
    """A record element with the names of ``RECORD_SCHEMA``; None if it is not well-formed.

    ``outside`` has the namespaces in force around it, by prefix. An element of that name in
    another namespace gives an empty text. Fields keep their order and the first of two headers
    or metadata elements counts.
    """
    scope = "".join(f" xmlns{':' * bool(p)}{p}={quoteattr(uri)}" for p, uri in outside.items() if p != "xml")
    try:
        record = ElementTree.fromstring(f"<scope{scope}>{element}</scope>")[0]
    except (ElementTree.ParseError, IndexError):
        return None
    oai = {"record": "", f"{{{OAI}}}record": f"{{{OAI}}}"}.get(record.tag)
    if oai is None:
        return ""
    header, dc = record.find(f"{oai}header"), record.find(f".//{{{OAI_DC}}}dc")

    def listed(parent: ElementTree.Element, space: str, names: Sequence[str], written: str) -> str:
        return "".join(
            f"<{written}{name}>{escape(found.text or '')}</{written}{name}>"
            for name in names
            for found in parent.findall(f"{space}{name}")
        )

    parts = []
    if header is not None:
        status = header.get("status")
        mark = f" status={quoteattr(status)}" if status is not None else ""
        parts.append(f"<header{mark}>{listed(header, oai, HEADER_FIELDS, '')}</header>")
    if dc is not None:
        fields = listed(dc, f"{{{DC}}}", DUBLIN_CORE_FIELDS, "dc:")
        parts.append(f"<metadata><oai_dc:dc>{fields}</oai_dc:dc></metadata>")
    return f"<record>{''.join(parts)}</record>"


def _canonical_elements(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file, element, record)`` of record elements of any prefix, read by namespace.

    Files are cut at the end tags of one prefix after the other. A file's declarations hold for
    all its elements, unless one declares a prefix again for itself.
    """
    known = materialize(declared_prefixes(spark, path), "declared-prefixes")
    records = known.filter((F.col("uri") == OAI) & (F.col("prefix") != ""))
    prefixes = [row[0] for row in records.select("prefix").distinct().orderBy("prefix").collect()]
    pair = F.struct("prefix", "uri")
    scopes = bounded_table(
        known.groupBy("file", "prefix").agg(F.min("uri").alias("uri")).groupBy("file").agg(F.collect_list(pair).alias("scope"))
    )
    canonical = F.pandas_udf(_canonical, "string")
    found = None
    for prefix in ("", *prefixes):
        name = f"{prefix}:record" if prefix else "record"
        lines = spark.read.text(path, lineSep=f"</{name}>").select("value", F.col("_metadata.file_path").alias("file"))
        if prefix:
            lines = lines.join(bounded_table(records.filter(F.col("prefix") == prefix).select("file").distinct()), "file", "left_semi")
        pieces = F.split(F.concat(F.lit(" "), "value"), rf"(?=<{re.escape(name)}[\s>/])")
        pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
        each = lines.join(scopes, "file", "left").select("file", "scope", F.size(pieces).alias("n"), F.posexplode(pieces).alias("at", "element"))
        closed = F.when(F.col("at") == F.col("n") - 1, F.concat("element", F.lit(f"</{name}>")))
        part = each.select("file", "element", canonical(closed, F.transform("scope", lambda s: F.concat_ws(" ", s["prefix"], s["uri"]))).alias("text"))
        found = part if found is None else found.unionAll(part)
    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField(DAMAGED, T.StringType())])
    parsed = F.from_xml(F.coalesce("text", F.lit("<record>")), schema, XML_OPTIONS)
    return found.filter(~F.coalesce(F.col("text") == "", F.lit(False))).select("file", "element", parsed.alias("record"))


def _canonical(elements: pd.Series, scopes: pd.Series) -> pd.Series:
    def named(scope) -> dict[str, str]:
        return dict(name.split(" ", 1) for name in scope) if scope is not None else {}

    return pd.Series(
        [None if element is None else canonical_record(element, named(scope)) for element, scope in zip(elements, scopes)],
        dtype=object,
    )


def stream_records(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The rows of :func:`read_records` as a stream over files that keep arriving."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return _whole(_elements(reader.text(path, lineSep=RECORD_END)))


def flat_records(records: DataFrame) -> DataFrame:
    """The export form: one JSON scalar or list per field.

    ``dc.identifier`` shares its name with the header identifier and replaces it wherever a
    record has metadata, with ``""`` if the metadata names none.
    """
    def field(name: str) -> Column:
        return F.when(F.col("dc").isNotNull(), scalar_or_list(F.col(f"dc.{name}")))

    header = F.to_json(F.array("identifier"))
    header = F.substring(header, F.lit(2), F.length(header) - 2)
    columns = [F.coalesce(field("identifier"), header).alias("identifier"), F.col("status")]
    columns += [field(name).alias(name) for name in DUBLIN_CORE_FIELDS if name != "identifier"]
    return records.select(*columns)


def read_responses(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Response bodies as ``(body)``: one per file, or one per line if written that way."""
    return spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "body")


def _anywhere(tag: str) -> str:
    return f"//*[local-name()='{tag}']"


def _wrapped(body: str) -> Column:
    """The body without its declaration inside one root element, which makes it a document."""
    bare = F.regexp_replace(F.col(body), r"^\s*<\?xml[^>]*\?>", "")
    return F.concat(F.lit("<body>"), bare, F.lit("</body>"))


def _readable(body: str) -> Column:
    """Whether the body is well-formed."""
    schema, options = f"{DAMAGED} string, text string", XML_OPTIONS | {"rowTag": "body"}
    parsed = F.from_xml(_wrapped(body), schema, options)
    return F.coalesce(F.col(body) != "", F.lit(False)) & parsed[DAMAGED].isNull()


def audit_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """Adds record count, error code and text, resumption token and the resulting state.

    ``state`` is ``broken`` for an error response and for one that is empty, not well-formed or
    without an element (error code ``unreadable``), ``more`` if a token follows and ``complete``
    otherwise.
    """
    error, token = _anywhere("error"), _anywhere("resumptionToken")

    def asked(function, path: str) -> Column:
        return F.when(F.col("_readable"), function(_wrapped(body), F.lit(path)))

    unreadable = ~F.col("_readable")
    return (
        responses.withColumn("_readable", _readable(body))
        .withColumn("_readable", F.coalesce(asked(F.xpath_boolean, "/body/*"), F.lit(False)))
        .withColumn("records", asked(F.xpath_int, f"count({_anywhere('record')})").cast("long"))
        .withColumn("_error", F.coalesce(asked(F.xpath_boolean, error), F.lit(False)))
        .withColumn(
            "error_code",
            F.when(unreadable, F.lit("unreadable")).when(F.col("_error"), asked(F.xpath_string, f"{error}/@code")),
        )
        .withColumn("error_text", F.when(F.col("_error"), asked(F.xpath_string, error)))
        .withColumn("token", F.nullif(asked(F.xpath_string, token), F.lit("")))
        .withColumn(
            "state",
            F.when(unreadable | F.col("_error"), "broken")
            .when(F.col("token").isNotNull(), "more")
            .otherwise("complete"),
        )
        .drop("_readable", "_error")
    )


def metadata_formats(responses: DataFrame, body: str = "body") -> DataFrame:
    """``(prefix)``: every metadata prefix that any response offers, per response."""
    found = F.xpath(_wrapped(body), F.lit(f"{_anywhere('metadataPrefix')}/text()"))
    found = F.when(_readable(body), found)
    rest = [name for name in responses.columns if name != body]
    return responses.select(*rest, F.explode(found).alias("prefix"))
