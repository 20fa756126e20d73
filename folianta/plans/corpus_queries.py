"""Registered queries over corpus preparation, splits, scans and sinks."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.functions import text as tx
from folianta.operators import corpus, records, split
from folianta.plans import checks as ck
from folianta.plans import derived as dv
from folianta.sources import html, jsonl, record_xml, wide_csv
from folianta.storage import materialize, shared_dir

MARK = " ¦ "
SEED = "folio"
CORPUS_SCHEMA = "doc_id bigint, type string"


def _typed(spark, sf_dir):
    """Keys and classes of all documents: what the splits are drawn from."""
    label = tx.collapse_classes(
        tx.normalize_nfc(F.expr(dv.TYPE_SQL)), fixed.MINORITY_CLASSES, fixed.COLLAPSED_CLASS
    )
    return dv.table(spark, sf_dir, "documents").select(
        "doc_id", tx.default_label(label, fixed.UNKNOWN_CLASS).alias("type")
    )


def _frequent(spark, sf_dir):
    return split.drop_rare_classes(_typed(spark, sf_dir))


def _parted(spark, sf_dir):
    return split.three_way_split(
        _typed(spark, sf_dir), "doc_id", min_rows=fixed.MIN_CLASS_ROWS, seed=SEED
    )


def _prepared(spark, sf_dir, observation=None):
    return corpus.prepare_corpus(
        dv.records(dv.documents(spark, sf_dir)),
        "doc_id",
        pattern=dv.SUBJECT_WORDS,
        seed=SEED,
        observation=observation,
    )


def prepare_corpus(spark, sf_dir):
    return (
        _prepared(spark, sf_dir)
        .groupBy("split", "type")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.length("title")).alias("title_chars"),
            F.sum(F.length("abstract")).alias("abstract_chars"),
            F.min("doc_id").alias("first_doc"),
        )
    )


def prep_counters(spark, sf_dir):
    observation = Observation("preparation")
    parted = _prepared(spark, sf_dir, observation)
    counts = parted.groupBy(F.concat(F.lit("split_"), F.col("split")).alias("counter")).agg(
        F.count("*").alias("value")
    )
    seen = spark.createDataFrame(list(observation.get.items()), "counter string, value bigint")
    return counts.unionByName(seen)


def filter_by_subject(spark, sf_dir):
    found = corpus.filter_by_subject(
        dv.records(dv.documents(spark, sf_dir)), pattern=dv.SUBJECT_WORDS
    )
    return found.select("doc_id", "type")


def corpus_records(spark, sf_dir):
    return corpus.corpus_records(dv.records(dv.documents(spark, sf_dir)), keep=["doc_id"])


def stratified_split(spark, sf_dir):
    return split.stratified_split(_typed(spark, sf_dir), "doc_id", seed=SEED)


def split_integrity(spark, sf_dir):
    parted = materialize(_parted(spark, sf_dir), "parted")
    return split.split_integrity(_frequent(spark, sf_dir), parted, "doc_id")


def split_shares(spark, sf_dir):
    return _parted(spark, sf_dir).groupBy("type", "split").agg(F.count("*").alias("n"))


def load_splits(spark, sf_dir):
    path = shared_dir(spark, "splits")
    jsonl.write_splits(_parted(spark, sf_dir), path)
    parts = {name: f"{path}/split={name}" for name in ("train", "val", "test")}
    return jsonl.load_splits(spark, parts, CORPUS_SCHEMA)


def roundtrip_jsonl(spark, sf_dir):
    docs = dv.table(spark, sf_dir, "documents")
    path = shared_dir(spark, "jsonl")
    jsonl.write_jsonl(docs, path, skip_empty=True)
    return jsonl.read_jsonl(spark, path, docs.schema)


def _wide_csv(spark, sf_dir):
    path = shared_dir(spark, "wide-csv")
    wide_csv.write_wide_csv(dv.wide_export(dv.documents(spark, sf_dir)), path)
    return wide_csv.read_wide_csv(spark, path)


def scan_wide_csv(spark, sf_dir):
    wide = _wide_csv(spark, sf_dir)
    names = ["dc.title[en]", "dc.title[]", "dc.subject[es]", "dc.type[es]", "dc.subtype[es]"]
    cells = [F.col(f"`{name}`").alias(name) for name in names]
    return wide.select(
        *cells, tx.clean_text(F.col("`dc.description.abstract[en]`")).alias("abstract")
    )


def convert_wide_records(spark, sf_dir):
    done = wide_csv.convert_records(_wide_csv(spark, sf_dir))
    return done.withColumn("subjects", F.array_join("subjects", MARK))


def conversion_counters(spark, sf_dir):
    """Rows read and rows with a title, counted while records are converted."""
    observation = Observation("conversion")
    done = wide_csv.convert_records(dv.wide_export(dv.documents(spark, sf_dir)), observation=observation)
    kept = done.agg(F.count("*").alias("value")).select(F.lit("written").alias("counter"), "value")
    kept = materialize(kept, "conversion-count")
    return kept.unionByName(spark.createDataFrame(list(observation.get.items()), "counter string, value bigint"))


def select_by_pattern(spark, sf_dir):
    wide = dv.wide_export(dv.documents(spark, sf_dir))
    return wide_csv.select_like(wide, ["type[", "materias["])


def _landed_records(spark, sf_dir):
    path = shared_dir(spark, "records")
    dv.land_records(dv.record_rows(dv.documents(spark, sf_dir)), path)
    return path


def scan_records_xml(spark, sf_dir):
    found = record_xml.read_records(spark, _landed_records(spark, sf_dir))
    return found.select(
        "identifier",
        "status",
        F.date_format("datestamp", "yyyy-MM-dd").alias("day"),
        F.array_join("sets", MARK).alias("sets"),
        F.array_join("dc.title", MARK).alias("title"),
        F.array_join("dc.subject", MARK).alias("subjects"),
        F.array_join("dc.description", MARK).alias("description"),
        F.size("dc.publisher").cast("bigint").alias("n_publishers"),
    )


def _damaged_landing(spark, sf_dir):
    """Responses of 20 records in which every 50th document's record is broken."""
    docs = dv.table(spark, sf_dir, "documents")
    name = F.concat(F.lit("oai:doc:"), F.col("doc_id").cast("string"))
    stamp = F.when(F.col("doc_id") % 7 == 0, "some day").otherwise("2024-01-01T00:00:00Z")
    header = F.concat(dv.element("identifier", name), dv.element("datestamp", stamp))
    whole = dv.element("record", dv.element("header", header))
    record = (
        F.when(F.col("doc_id") % 150 == 0, F.concat(F.lit("<record><header>"), header, F.lit("</record>")))
        .when(F.col("doc_id") % 150 == 50, F.concat(F.lit("<record>"), dv.element("header", header)))
        .when(F.col("doc_id") % 150 == 100, dv.element("record", F.lit("no header")))
        .otherwise(whole)
    )
    opening, closing = dv.ENVELOPE.split("{}")
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("doc_id", record.alias("r")))), lambda x: x["r"]), ""
    )
    pages = docs.groupBy(F.floor(F.col("doc_id") / 20).alias("page")).agg(body.alias("body"))
    return dv.land(pages.select(F.concat(F.lit(opening), "body", F.lit(closing)).alias("value")), "damaged")


def scan_damaged_records(spark, sf_dir):
    path = _damaged_landing(spark, sf_dir)
    good = record_xml.read_records(spark, path).select(
        F.lit("good").alias("kind"), "identifier", "stamp", F.col("datestamp").isNull().alias("undated")
    )
    named = F.regexp_extract("element", "<identifier>(.*?)</identifier>", 1)
    bad = record_xml.damaged_records(spark, path).select(
        F.lit("damaged").alias("kind"), named.alias("identifier"), F.lit(None).cast("string").alias("stamp"), F.lit(None).cast("boolean").alias("undated")
    )
    return good.unionByName(bad)


def _prefixed_landing(spark, sf_dir):
    """A response per 25 documents; its prefixes, declared at the root, depend on its number.

    Responses with the same declarations share files, so that their number follows the tasks.
    """
    docs = dv.table(spark, sf_dir, "documents")
    page = F.floor(F.col("doc_id") / 25)
    p, q, d = (  # of records, of the metadata and of its fields
        F.element_at(F.array(*[F.lit(x) for x in names]), (page % 3 + 1).cast("int"))
        for names in (("", "oai:", "r-1:"), ("oai_dc:", "m:", "oai_dc:"), ("dc:", "d.c:", "f:"))
    )

    def tag(prefix, name, value):
        return F.concat(F.lit("<"), prefix, F.lit(f"{name}>"), value, F.lit("</"), prefix, F.lit(f"{name}>"))

    def space(prefix, uri):
        name = F.when(prefix == "", "xmlns").otherwise(F.concat(F.lit("xmlns:"), F.rtrim(prefix, F.lit(":"))))
        return F.concat(F.lit(" "), name, F.lit(f'="{uri}"'))

    title = dv.xml_escape(tx.collapse_spaces(tx.drop_controls(tx.first_line(F.col("text")))))
    name = F.concat(F.lit("oai:doc:"), F.col("doc_id").cast("string"))
    fields = tag(q, "dc", F.concat(tag(d, "title", title), tag(F.lit("x:"), "title", F.lit("foreign"))))
    whole = tag(p, "record", F.concat(tag(p, "header", tag(p, "identifier", name)), tag(p, "metadata", fields)))
    record = (
        F.when(F.col("doc_id") % 50 == 7, F.regexp_replace(whole, "(</[^>]*)identifier>", "$1name>"))
        .when(F.col("doc_id") % 50 == 13, tag(p, "record", tag(F.lit("x:"), "header", name)))
        .when(F.col("doc_id") % 50 == 21, tag(F.lit("x:"), "record", name))
        .otherwise(whole)
    )
    spaces = F.concat(space(p, fixed.NAMESPACES["oai"]), space(q, fixed.NAMESPACES["oai_dc"]), space(d, fixed.NAMESPACES["dc"]), F.lit(' xmlns:x="urn:other"'))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", record.alias("r")))), lambda x: x["r"]), "")
    pages = docs.withColumn("spaces", spaces).groupBy(page.alias("page"), "spaces").agg(listed.alias("records"))
    body = F.concat(F.lit("<answer"), "spaces", F.lit("><ListRecords>"), "records", F.lit("</ListRecords></answer>"))
    path = shared_dir(spark, "prefixed")
    pages.select(body.alias("value"), (F.col("page") % 3).alias("page")).write.partitionBy("page").text(path)
    return path


def scan_prefixed_records(spark, sf_dir):
    path = f"{_prefixed_landing(spark, sf_dir)}/page=*"
    good = record_xml.read_records(spark, path, by_namespace=True).select(
        F.lit("good").alias("kind"), "identifier", F.array_join("dc.title", MARK).alias("title")
    )
    bad = record_xml.damaged_records(spark, path, by_namespace=True)
    named = F.regexp_extract("element", "oai:doc:[0-9]+", 0)
    return good.unionByName(bad.select(F.lit("damaged").alias("kind"), named.alias("identifier"), F.lit(None).cast("string").alias("title")))


def audit_damaged_responses(spark, sf_dir):
    docs = dv.table(spark, sf_dir, "documents")
    opening, closing = dv.ENVELOPE.split("{}")
    body = (
        F.when(F.col("doc_id") % 5 == 0, F.lit(f"{opening}<ListRecords><record></ListRecords>{closing}"))
        .when(F.col("doc_id") % 5 == 1, F.lit(""))
        .when(F.col("doc_id") % 5 == 2, F.lit("service unavailable"))
        .when(F.col("doc_id") % 5 == 3, F.lit(f'<?xml version="1.0"?>{opening}<ListRecords><record/><record/></ListRecords>{closing}'))
    )
    return record_xml.audit_responses(docs.select("doc_id", body.alias("body"))).drop("body")


def scan_mixed_csv(spark, sf_dir):
    """Files with the same columns in another order, and one column less."""
    docs = dv.table(spark, sf_dir, "documents")
    path = shared_dir(spark, "mixed-csv")
    title = F.regexp_replace(tx.first_line(F.col("text")), r"\s+", " ").alias("dc.title[en]")
    kind, subject = F.expr(dv.TYPE_SQL).alias("dc.type[en]"), F.col("lang").alias("dc.subject[en]")
    for at, columns in enumerate(([title, kind, subject], [kind, subject, title], [subject, title])):
        wide_csv.write_wide_csv(docs.filter(F.col("doc_id") % 3 == at).select(*columns), f"{path}/part={at}")
    names = ["dc.title[en]", "dc.type[en]", "dc.subject[en]"]
    return wide_csv.read_wide_csv(spark, f"{path}/part=*").select(*[F.col(f"`{n}`").alias(n) for n in names])


def resolved_links(spark, sf_dir):
    """Links of pages that write them relative, escaped and in comments."""
    pages = dv.table(spark, sf_dir, "pages")
    number = F.col("page_id").cast("string")
    page = F.concat(
        F.lit("<!-- <a href='/item/hidden'>x</a> --><a href='/item/"), number, F.lit("?a=1&amp;b=2'>1</a><a href=\"/item/"), number,
        F.lit("?a=1&b=2\">2</a><a href=item/next>3</a><a href='//other.example/item/4'>4</a>"
              "<a href='https://third.example/item/5'>5</a><a href='?item=6'>6</a>"
              "<script>if (a < b) w(\"<a href='/item/script'>x</a>\"); // <!-- </script><a href='../x/./item/7/'>7</a>"
              "<style><a href='/item/style'></style><textarea><a href='/item/area'></textarea>"),
    )
    page = F.concat(F.when(F.col("page_id") % 2 == 0, "<base target=x><base href='/root/a/../b/c'>").otherwise(""), page)
    own = F.concat(F.lit("https://site.example/list/"), number, F.lit("/page.html?q=/x/"))
    made = pages.select("page_id", own.alias("address"), page.alias("html"))
    return html.page_links(made, "page_id", needle="item", deny=[], base="address")


def flat_records(spark, sf_dir):
    found = record_xml.read_records(spark, _landed_records(spark, sf_dir))
    return record_xml.flat_records(found).select(
        "identifier", "status", "subject", "publisher", "rights"
    )


def audit_responses(spark, sf_dir):
    path = dv.land(dv.responses(dv.table(spark, sf_dir, "documents")), "responses")
    bodies = record_xml.read_responses(spark, path, whole_files=False)
    return record_xml.audit_responses(bodies).drop("body")


def list_metadata_formats(spark, sf_dir):
    opening, closing = dv.ENVELOPE.split("{}")
    prefixes = F.transform(
        F.array_sort(F.collect_set("lang")),
        lambda p: F.concat(
            F.lit("<metadataFormat><metadataPrefix>"), p, F.lit("</metadataPrefix></metadataFormat>")
        ),
    )
    body = F.concat(F.lit(opening), F.array_join(prefixes, ""), F.lit(closing))
    offers = dv.table(spark, sf_dir, "documents").groupBy("source").agg(body.alias("body"))
    return record_xml.metadata_formats(offers)


def html_meta(spark, sf_dir):
    pages = dv.html_pages(dv.documents(spark, sf_dir))
    found = html.meta_values(pages, "doc_id")
    return found.withColumn("values", F.array_join("values", MARK))


def extract_links(spark, sf_dir):
    pages = dv.table(spark, sf_dir, "pages")
    return html.page_links(pages, needle="/", deny=["the", "que", "#"])


def new_links(spark, sf_dir):
    pages = dv.table(spark, sf_dir, "pages")
    visited = html.page_links(pages.filter(F.col("url").startswith("https")), needle="/", deny=[])
    return records.unseen(html.page_links(pages, needle="/", deny=[]), visited)


def group_values(spark, sf_dir):
    positioned = dv.documents(spark, sf_dir).select(
        "doc_id", F.posexplode(dv.words(dv.WORD)).alias("pos", "value")
    )
    named = positioned.withColumn("name", F.lower(F.substring("value", 1, 1)))
    found = records.group_values(named, ["doc_id", "name"])
    return found.withColumn("values", F.array_join("values", MARK))


QUERIES = {
    "prepare_corpus": prepare_corpus,
    "prep_counters": prep_counters,
    "filter_by_subject": filter_by_subject,
    "corpus_records": corpus_records,
    "class_frequency": lambda spark, sf_dir: split.class_frequency(_typed(spark, sf_dir)),
    "drop_rare_classes": lambda spark, sf_dir: split.drop_rare_classes(
        dv.records(dv.table(spark, sf_dir, "documents")).select("doc_id", "type"), min_rows=60
    ),
    "stratified_split": stratified_split,
    "three_way_split": _parted,
    "split_integrity": split_integrity,
    "split_shares": split_shares,
    "load_splits": load_splits,
    "roundtrip_jsonl": roundtrip_jsonl,
    "scan_wide_csv": scan_wide_csv,
    "convert_wide_records": convert_wide_records,
    "conversion_counters": conversion_counters,
    "select_by_pattern": select_by_pattern,
    "scan_records_xml": scan_records_xml,
    "scan_damaged_records": scan_damaged_records,
    "scan_prefixed_records": scan_prefixed_records,
    "audit_damaged_responses": audit_damaged_responses,
    "scan_mixed_csv": scan_mixed_csv,
    "resolved_links": resolved_links,
    "flat_records": flat_records,
    "audit_responses": audit_responses,
    "list_metadata_formats": list_metadata_formats,
    "html_meta": html_meta,
    "extract_links": extract_links,
    "new_links": new_links,
    "group_values": group_values,
}

_MATCHES = (
    f"len(list_filter({ck.words()}, lambda w: regexp_matches(w, '{dv.SUBJECT_WORDS}', 'i'))) > 0"
)
_KEYED = f"SELECT doc_id, type FROM ({ck.typed_documents()})"
_CHOSEN = f"SELECT doc_id, type FROM ({ck.typed_documents()}) WHERE {_MATCHES}"
_TITLE = ck.nfc(ck.first_line("text"))
_DELETED = "(lang = 'de' AND n_chars < 800)"


def _xml_text(value: str) -> str:
    return ck.collapse(f"regexp_replace({value}, '{fixed.CONTROL_CHARS}', '', 'g')")


def _first_seen(values: str) -> str:
    return f"list_filter({values}, lambda x, i: list_position({values}, x) = i)"


_LINKS = """
    SELECT page_id, url, unnest(list_transform(
        regexp_extract_all(html, '(?is)<a\\b(?:"[^"]*"|''[^'']*''|[^''">])*>'),
        lambda t: concat(regexp_extract(t, {a}, 1), regexp_extract(t, {a}, 2), regexp_extract(t, {a}, 3)))) AS href
    FROM pages""".format(
    a="'(?is)[\\s\"'']href\\s*=\\s*(?:\"([^\"]*)\"|''([^'']*)''|([^\\s\"''>]+))'"
)
_WIDE_TITLE = ck.first_line("text")
_NA = "', '".join(fixed.MISSING_CELLS)


def _cell(value: str) -> str:
    return f"CASE WHEN {value} NOT IN ('{_NA}') THEN {value} END"


_SUBJECTS_MERGED = _first_seen(
    "list_concat(list_concat(CASE WHEN lang <> 'fr' THEN w10 ELSE [] END,"
    " CASE WHEN lang <> 'de' THEN w6 ELSE [] END), CASE WHEN n_chars < 2000 THEN [lang] ELSE [] END)"
)
_SPLIT = f"WITH {ck.split_ctes(_KEYED, SEED)}"

ORACLES = {
    "prepare_corpus": f"""
        WITH {ck.split_ctes(_CHOSEN, SEED)}
        SELECT split, type, count(*) AS n, sum(length({_TITLE}))::BIGINT AS title_chars,
               sum(length({ck.nfc('text')}))::BIGINT AS abstract_chars, min(doc_id) AS first_doc
        FROM parted JOIN (SELECT doc_id, text FROM documents) USING (doc_id) GROUP BY ALL""",
    "prep_counters": f"""
        WITH {ck.split_ctes(_CHOSEN, SEED)}
        SELECT concat('split_', split) AS counter, count(*) AS value FROM parted GROUP BY ALL
        UNION ALL SELECT 'evaluated', count(*) FROM documents
        UNION ALL SELECT 'selected', count(*) FROM rows_in""",
    "filter_by_subject": f"SELECT doc_id, {dv.TYPE_SQL} AS type FROM documents WHERE {_MATCHES}",
    "corpus_records": f"""
        SELECT doc_id, {_TITLE} AS title, {ck.nfc('text')} AS abstract,
               {ck.collapse_type(dv.TYPE_SQL)} AS type FROM documents""",
    "class_frequency": f"SELECT type, count(*) AS n FROM ({_KEYED}) GROUP BY type",
    "drop_rare_classes": f"""
        SELECT doc_id, type FROM (SELECT doc_id, {dv.TYPE_SQL} AS type FROM documents)
        QUALIFY count(*) OVER (PARTITION BY type) >= 60""",
    "stratified_split": f"""
        WITH rows_in AS ({_KEYED}),
        c AS (SELECT type, count(*) AS n, (sum(count(*)) OVER ())::BIGINT AS total FROM rows_in GROUP BY type),
        t AS (SELECT *, total - ceil(0.30::DOUBLE * total)::BIGINT AS target FROM c),
        e AS (SELECT *, n::DOUBLE * target / total AS exact FROM t),
        q AS (SELECT type, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, type)
                     <= target - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM e)
        SELECT doc_id, type, CASE WHEN row_number() OVER (
                   PARTITION BY type ORDER BY md5(concat(doc_id, ':{SEED}')), doc_id) <= quota
               THEN 'train' ELSE 'held_out' END AS split
        FROM rows_in JOIN q USING (type)""",
    "three_way_split": f"{_SPLIT} SELECT doc_id, type, split FROM parted",
    "split_integrity": f"""{_SPLIT}
        SELECT concat('rows_', split) AS measure, count(*) AS value FROM parted GROUP BY ALL
        UNION ALL SELECT 'in_two_parts', count(*) FROM (
            SELECT doc_id FROM parted GROUP BY doc_id HAVING count(DISTINCT split) > 1)
        UNION ALL SELECT 'lost', count(*) FROM (
            SELECT doc_id FROM rows_in JOIN frequent USING (type) EXCEPT SELECT doc_id FROM parted)
        UNION ALL SELECT 'invented', count(*) FROM (
            SELECT doc_id FROM parted EXCEPT SELECT doc_id FROM rows_in)""",
    "split_shares": f"{_SPLIT} SELECT type, split, count(*) AS n FROM parted GROUP BY ALL",
    "load_splits": f"{_SPLIT} SELECT doc_id, type, split FROM parted",
    "roundtrip_jsonl": "SELECT * FROM documents",
    "scan_wide_csv": f"""
        SELECT {_cell("CASE WHEN lang IN ('en', 'de') THEN t END")} AS "dc.title[en]",
               {_cell("CASE WHEN lang IN ('fr', 'de', 'es') THEN concat(' ', t) END")} AS "dc.title[]",
               {_cell("CASE WHEN lang <> 'fr' THEN s END")} AS "dc.subject[es]",
               {_cell("CASE WHEN lang <> 'en' THEN k ELSE 'NA' END")} AS "dc.type[es]",
               {_cell("k")} AS "dc.subtype[es]",
               CASE WHEN lang = 'en' THEN {ck.clean(_cell('text'))} ELSE '' END AS abstract
        FROM (SELECT *, {_WIDE_TITLE} AS t, array_to_string({ck.words()}, '||') AS s,
                     {dv.TYPE_SQL} AS k FROM documents)""",
    "convert_wide_records": f"""
        SELECT * FROM (
        SELECT CASE WHEN n_chars > 1000 AND t <> '' THEN t
                    WHEN lang IN ('en', 'de') AND t <> '' THEN t
                    WHEN lang IN ('fr', 'de', 'es') THEN t ELSE '' END AS title,
               CASE WHEN lang IN ('en', 'es', 'de') THEN {ck.clean('text')} ELSE '' END AS abstract,
               {ck.clean('k')} AS type,
               array_to_string({_SUBJECTS_MERGED}, '{MARK}') AS subjects
        FROM (SELECT *, {ck.clean(_WIDE_TITLE)} AS t, {ck.words()} AS w10, list_reverse({ck.words()}) AS w6,
                     {dv.TYPE_SQL} AS k FROM documents))
        WHERE title <> ''""",
    "conversion_counters": f"""
        WITH titled AS (SELECT n_chars > 1000 AND t <> '' OR lang IN ('en', 'de', 'fr', 'es') AND t <> '' AS valid
                        FROM (SELECT *, {ck.clean(_WIDE_TITLE)} AS t FROM documents))
        SELECT 'read' AS counter, count(*) AS value FROM titled
        UNION ALL SELECT unnest(['valid', 'written']), count(*) FILTER (valid) FROM titled""",
    "select_by_pattern": f"""
        SELECT CASE WHEN n_chars < 2000 THEN lang END AS "dc.subject.materias[es]",
               CASE WHEN lang <> 'en' THEN {dv.TYPE_SQL} ELSE 'NA' END AS "dc.type[es]",
               {dv.TYPE_SQL} AS "dc.subtype[es]" FROM documents""",
    "scan_records_xml": f"""
        SELECT concat('oai:doc:', doc_id) AS identifier,
               CASE WHEN {_DELETED} THEN 'deleted' ELSE 'active' END AS status,
               '2024-01-01' AS day, lang AS sets,
               CASE WHEN NOT {_DELETED} THEN {_xml_text(ck.first_line('text'))} END AS title,
               CASE WHEN NOT {_DELETED} THEN array_to_string({_first_seen(ck.words())}, '{MARK}') END AS subjects,
               CASE WHEN NOT {_DELETED} THEN {_xml_text('text')} END AS description,
               CASE WHEN NOT {_DELETED} THEN 0 END AS n_publishers
        FROM documents""",
    "scan_damaged_records": """
        SELECT CASE WHEN doc_id % 50 = 0 THEN 'damaged' ELSE 'good' END AS kind,
               CASE WHEN doc_id % 150 = 100 THEN '' ELSE concat('oai:doc:', doc_id) END AS identifier,
               CASE WHEN doc_id % 50 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'some day' ELSE '2024-01-01T00:00:00Z' END AS stamp,
               CASE WHEN doc_id % 50 > 0 THEN doc_id % 7 = 0 END AS undated
        FROM documents""",
    "scan_prefixed_records": f"""
        SELECT CASE WHEN doc_id % 50 IN (7, 13) THEN 'damaged' ELSE 'good' END AS kind,
               concat('oai:doc:', doc_id) AS identifier,
               CASE WHEN doc_id % 50 NOT IN (7, 13) THEN {_xml_text(ck.first_line('text'))} END AS title
        FROM documents WHERE doc_id % 50 <> 21""",
    "audit_damaged_responses": """
        SELECT doc_id, CASE WHEN doc_id % 5 = 3 THEN 2 END AS records,
               CASE WHEN doc_id % 5 <> 3 THEN 'unreadable' END AS error_code, NULL::VARCHAR AS error_text,
               NULL::VARCHAR AS token, CASE WHEN doc_id % 5 = 3 THEN 'complete' ELSE 'broken' END AS state
        FROM documents""",
    "scan_mixed_csv": f"""
        SELECT {_cell(f"nullif(regexp_replace({_WIDE_TITLE}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), '')")} AS "dc.title[en]",
               CASE WHEN doc_id % 3 < 2 THEN nullif({dv.TYPE_SQL}, '') END AS "dc.type[en]", lang AS "dc.subject[en]"
        FROM documents""",
    "resolved_links": """
        SELECT page_id, unnest([concat('https://site.example/item/', page_id, '?a=1&b=2'),
            concat(folder, 'item/next'), 'https://other.example/item/4', 'https://third.example/item/5',
            concat(page, '?item=6'), concat(above, 'x/item/7/')]) AS href
        FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://site.example/root/b/c'
                     ELSE concat('https://site.example/list/', page_id, '/page.html') END AS page,
                     regexp_replace(page, '[^/]*$', '') AS folder, regexp_replace(page, '[^/]*/[^/]*$', '') AS above
              FROM pages)""",
    "flat_records": f"""
        SELECT CASE WHEN {_DELETED} THEN to_json(concat('oai:doc:', doc_id))
                    ELSE to_json(concat('doc/', doc_id)) END::VARCHAR AS identifier,
               CASE WHEN {_DELETED} THEN 'deleted' ELSE 'active' END AS status,
               CASE WHEN NOT {_DELETED} THEN CASE len(s) WHEN 0 THEN '""' WHEN 1 THEN to_json(s[1])::VARCHAR
                    ELSE to_json(s)::VARCHAR END END AS subject,
               CASE WHEN NOT {_DELETED} THEN '""' END AS publisher,
               CASE WHEN NOT {_DELETED} THEN '""' END AS rights
        FROM (SELECT *, {_first_seen(ck.words())} AS s FROM documents)""",
    "audit_responses": """
        SELECT n AS records, NULL::VARCHAR AS error_code, NULL::VARCHAR AS error_text,
               CASE WHEN n = 100 THEN concat('page-', page + 1) END AS token,
               CASE WHEN n = 100 THEN 'more' ELSE 'complete' END AS state
        FROM (SELECT doc_id // 100 AS page, count(*) AS n FROM documents GROUP BY page)
        UNION ALL
        SELECT DISTINCT 0, 'noRecordsMatch', concat('nothing in ', lang), NULL, 'broken' FROM documents""",
    "list_metadata_formats": "SELECT DISTINCT source, lang AS prefix FROM documents",
    "html_meta": f"""
        SELECT doc_id, 'title' AS name, t AS "values" FROM
            (SELECT doc_id, {ck.clean(ck.first_line('text'))} AS t FROM documents) WHERE t <> ''
        UNION ALL SELECT doc_id, 'language', lang FROM documents
        UNION ALL SELECT doc_id, 'subject', array_to_string({_first_seen('w')}, '{MARK}')
            FROM (SELECT doc_id, {ck.words()} AS w FROM documents) WHERE len(w) > 0""",
    "extract_links": f"""
        SELECT DISTINCT href FROM ({_LINKS})
        WHERE contains(href, '/') AND NOT contains(href, 'the') AND NOT contains(href, 'que')
          AND NOT contains(href, '#')""",
    "new_links": f"""
        WITH l AS ({_LINKS})
        SELECT DISTINCT href FROM l WHERE contains(href, '/') AND href NOT IN (
            SELECT href FROM l WHERE starts_with(url, 'https') AND contains(href, '/'))""",
    "group_values": f"""
        WITH w AS (SELECT doc_id, unnest({ck.words(dv.WORD)}) AS value,
                          unnest(range(1, len({ck.words(dv.WORD)}) + 1)) AS pos FROM documents),
        f AS (SELECT doc_id, lower(left(value, 1)) AS name, value, min(pos) AS pos FROM w GROUP BY ALL)
        SELECT doc_id, name, string_agg(value, '{MARK}' ORDER BY pos) AS "values" FROM f GROUP BY ALL""",
}
