"""Inputs of the registered queries, derived by Spark from the given tables.

The tables are not bibliographic, so records, pages, responses and runs are rendered from
them. Expressions that Spark and the checking SQL share are kept as SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.functions import text as tx
from folianta.storage import shared_dir, spread

WS = fixed.WHITESPACE
MINORITY_SOURCES = "".join(
    f" WHEN 'src{10 + at}' THEN '{name}'" for at, name in enumerate(fixed.MINORITY_CLASSES)
)
TYPE_SQL = (
    "CASE source WHEN 'src0' THEN 'Artículo' WHEN 'src1' THEN 'Artículo'"
    " WHEN 'src2' THEN 'Artículo' WHEN 'src3' THEN 'Artículo'"
    " WHEN 'src4' THEN 'Objeto de conferencia' WHEN 'src5' THEN 'Objeto de conferencia'"
    " WHEN 'src6' THEN 'Tesis' WHEN 'src7' THEN ' Tesis ' WHEN 'src8' THEN 'Libro'"
    " WHEN 'src9' THEN 'Objeto de aprendizaje'"
    f"{MINORITY_SOURCES} WHEN 'src18' THEN 'Otro' WHEN 'src19' THEN '' ELSE source END"
)
ANSWER_SQL = (
    "CASE WHEN contains(text, 'ment') THEN concat(type, chr(10), 'fin')"
    " WHEN contains(text, 'tion') THEN concat('La categoria es ', lower(type), '<|eot_id|>')"
    " WHEN contains(text, 'sch') THEN 'Tesis' ELSE 'nosotros no sabemos' END"
)
SUBJECT_WORDS = "^(This|With|From|Der|Die|Que|Los|Les|Des|Ción)"  # common in all languages at any size
WORD = r"\p{L}+"
NAME = r"\p{Lu}\p{L}*"  # capitalised words stand for subjects and other listed values


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def words(pattern: str = NAME) -> Column:
    """All words of the text that match ``pattern``, in text order."""
    return F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0))


def records(docs: DataFrame) -> DataFrame:
    """Converted records: title, abstract, type and subjects."""
    return docs.select(
        "doc_id",
        tx.first_line(F.col("text")).alias("title"),
        F.col("text").alias("abstract"),
        F.expr(TYPE_SQL).alias("type"),
        words().alias("subjects"),
    )


def answers(docs: DataFrame) -> DataFrame:
    """Predictions made by an ordered keyword rule."""
    typed = docs.withColumn("type", F.expr(TYPE_SQL))
    return typed.select("doc_id", "type", F.expr(ANSWER_SQL).alias("generated_text"))


def wide_export(docs: DataFrame) -> DataFrame:
    """A row per document with one column per field and language."""
    title = tx.first_line(F.col("text"))
    text, lang = F.col("text"), F.col("lang")
    listed = F.array_join(words(), "||")
    spaced = F.concat(F.lit("|| "), F.array_join(F.reverse(words()), " || "), F.lit(" ||  "))
    columns = {
        "dc.title[en]": F.when(lang.isin("en", "de"), title),
        "dc.title[es]": F.when((F.col("n_chars") > 1000), title),
        "dc.title[]": F.when(lang.isin("fr", "de", "es"), F.concat(F.lit(" "), title)),
        "dc.description.abstract[en]": F.when(lang == "en", text),
        "dc.description.abstract[es]": F.when(lang == "es", text),
        "dc.description.abstract[zz]": F.when(lang == "de", text),
        "unrelated": F.col("source"),
        "dc.subject[es]": F.when(lang != "fr", listed),
        "dc.subject.ford[en]": F.when(lang != "de", spaced),
        "dc.subject.materias[es]": F.when(F.col("n_chars") < 2000, lang),
        "dc.type[es]": F.when(lang != "en", F.expr(TYPE_SQL)).otherwise(F.lit("NA")),
        "dc.subtype[es]": F.expr(TYPE_SQL),
    }
    return docs.select(*[value.alias(name) for name, value in columns.items()])


def xml_escape(value: Column) -> Column:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(plain), F.lit(escaped))
    return value


def element(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def record_rows(docs: DataFrame) -> DataFrame:
    """Harvest records; short German documents are deleted ones without metadata."""
    deleted = (F.col("lang") == "de") & (F.col("n_chars") < 800)
    none = F.array().cast("array<string>")

    def printable(value: Column) -> Column:
        return tx.collapse_spaces(tx.drop_controls(value))  # XML 1.0 has no control characters

    filled = {
        "title": F.array(printable(tx.first_line(F.col("text")))),
        "subject": words(),
        "description": F.array(printable(F.col("text"))),
        "publisher": F.array(F.lit("")),
        "identifier": F.array(F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))),
    }
    dc = F.struct(
        *[filled.get(name, none).alias(f"dc:{name}") for name in fixed.DUBLIN_CORE_FIELDS]
    )
    return docs.select(
        F.struct(
            F.when(deleted, "deleted").alias("_status"),
            F.concat(F.lit("oai:doc:"), F.col("doc_id").cast("string")).alias("identifier"),
            F.lit("2024-01-01T00:00:00Z").alias("datestamp"),
            F.array("lang").alias("setSpec"),
        ).alias("header"),
        F.when(~deleted, F.struct(dc.alias("oai_dc:dc"))).alias("metadata"),
    )


def version_rows(events: DataFrame) -> DataFrame:
    """Every event as a version of its user's record; an error is a deletion."""
    return events.select(
        F.struct(
            F.when(F.col("event_type") == "error", "deleted").alias("_status"),
            F.col("user_id").cast("string").alias("identifier"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("datestamp"),
        ).alias("header")
    )


def land_records(rows: DataFrame, path: str) -> None:
    """Add record files, each a well-formed document of its own, to ``path``."""
    root = (
        'ListRecords xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/"'
        ' xmlns:dc="http://purl.org/dc/elements/1.1/"'
    )
    writer = rows.write.format("xml").option("rootTag", root).option("rowTag", "record")
    # prefixed names such as dc:title are not plain XML names
    writer = writer.option("attributePrefix", "_").option("validateName", "false")
    writer.mode("append").save(path)


ENVELOPE = '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/">{}</OAI-PMH>'


def responses(docs: DataFrame, page_rows: int = 100) -> DataFrame:
    """Response bodies of ``page_rows`` records, plus an error response per language."""
    opening, closing = ENVELOPE.split("{}")
    page = F.floor(F.col("doc_id") / page_rows)
    record = element("record", element("header", element("setSpec", F.col("lang"))))
    pages = (
        docs.select(page.alias("page"), record.alias("record"), "doc_id")
        .groupBy("page")
        .agg(F.array_sort(F.collect_list(F.struct("doc_id", "record"))).alias("records"))
    )
    body = F.concat(
        F.lit(opening + "<ListRecords>"),
        F.array_join(F.transform("records", lambda r: r["record"]), ""),
        F.when(
            F.size("records") == page_rows,
            F.concat(
                F.lit("<resumptionToken>page-"),
                (F.col("page") + 1).cast("string"),
                F.lit("</resumptionToken>"),
            ),
        ).otherwise(F.lit("<resumptionToken/>")),
        F.lit("</ListRecords>" + closing),
    )
    errors = docs.select("lang").distinct()
    error = F.concat(
        F.lit(opening + '<error code="noRecordsMatch">nothing in '),
        F.col("lang"),
        F.lit("</error>" + closing),
    )
    return pages.select(body.alias("value")).unionAll(errors.select(error.alias("value")))


def harvests(docs: DataFrame, page_rows: int = 3) -> DataFrame:
    """Landed pages of one harvest per source as ``(harvest, asked, body)``.

    Page 2 of src1 is an error and page 1 of src2 no XML; page 2 of src3 and the first of src5 are
    missing; the last page of src4 leads back to page 1.
    """
    opening, closing = ENVELOPE.split("{}")
    in_source = Window.partitionBy("source").orderBy("doc_id")
    record = element("record", element("header", element("identifier", F.col("doc_id").cast("string"))))
    placed = docs.select("source", record.alias("record"), (F.row_number().over(in_source) - 1).alias("at"))
    pages = placed.groupBy("source", F.floor(F.col("at") / page_rows).alias("p")).agg(
        F.array_join(F.collect_list("record"), "").alias("records")
    )
    last = F.col("p") == F.max("p").over(Window.partitionBy("source"))
    follows = F.when(~last, F.col("p") + 1).when(F.col("source") == "src4", 1)
    token = F.coalesce(
        element("resumptionToken", F.concat("source", F.lit("-"), follows.cast("string"))), F.lit("<resumptionToken/>")
    )
    listed = F.concat(F.lit(opening + "<ListRecords>"), "records", token, F.lit("</ListRecords>" + closing))
    body = (
        F.when(F.expr("source = 'src1' AND p = 2"), F.lit(f'{opening}<error code="badResumptionToken">gone</error>{closing}'))
        .when(F.expr("source = 'src2' AND p = 1"), F.lit("service unavailable"))
        .otherwise(listed)
    )
    asked = F.when(F.col("p") > 0, F.concat("source", F.lit("-"), F.col("p").cast("string")))
    made = pages.select(F.col("source").alias("harvest"), asked.alias("asked"), body.alias("body"))
    return made.filter("NOT (harvest = 'src3' AND asked <=> 'src3-2' OR harvest = 'src5' AND asked IS NULL)")


def land(df: DataFrame, name: str) -> str:
    """Write one-column text rows to a fresh shared folder."""
    path = shared_dir(df.sparkSession, name)
    df.write.text(path)
    return path


def html_pages(docs: DataFrame) -> DataFrame:
    """Item pages with meta tags in both attribute orders, repeats and blanks."""
    title = xml_escape(tx.clean_text(tx.first_line(F.col("text"))))
    subject = F.transform(
        words(),
        lambda w: F.concat(F.lit("<META content='"), w, F.lit("' name=\"DCTERMS.subject\">")),
    )
    html = F.concat(
        F.lit('<html><head><meta charset="utf-8"><meta name="DC.title" content="'),
        title,
        F.lit('">'),
        F.array_join(subject, "\n"),
        F.lit('<meta name="DC.language" content=" '),
        F.col("lang"),
        F.lit(' "/><meta name="viewport" content="x"><meta name="DC.rights" content="  ">'),
        F.lit("</head><body><p>no end tags<br></body>"),
    )
    return docs.select("doc_id", html.alias("html"))


# configurations of runs read off the line items; valid in both engines
CONFIG_SQL = {
    "method": (
        "CASE l_linenumber WHEN 1 THEN 'lora' WHEN 2 THEN 'dora' WHEN 3 THEN 'qlora'"
        " WHEN 4 THEN 'qdora' WHEN 5 THEN 'galore' WHEN 6 THEN 'galore_rsvd' ELSE 'fft' END"
    ),
    "lora_r": (
        "CASE WHEN l_quantity <= 10 THEN 8 WHEN l_quantity <= 20 THEN 16"
        " WHEN l_quantity <= 30 THEN 32 WHEN l_quantity <= 40 THEN 64 ELSE 128 END"
    ),
    "galore_rank": "128",
    "update_proj_gap": "CASE WHEN l_discount < 0.05 THEN 200 ELSE 500 END",
    "target_modules": "CASE l_linestatus WHEN 'O' THEN 'all' ELSE 'attn' END",
    "seed": "CASE WHEN l_tax < 0.03 THEN 42 WHEN l_tax < 0.06 THEN 3688191069 ELSE 7 END",
}


def line_configs(lines: DataFrame) -> DataFrame:
    """Line items with the run configuration each stands for."""
    types = {"lora_r": "int", "galore_rank": "int", "update_proj_gap": "int", "seed": "bigint"}
    columns = [
        F.expr(sql).cast(types.get(name, "string")).alias(name)
        for name, sql in CONFIG_SQL.items()
    ]
    return lines.select(*lines.columns, *columns)
