"""Registered queries over text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.functions import prompts
from folianta.functions import text as tx
from folianta.operators import positions, records
from folianta.operators.runs import run_timestamp
from folianta.plans import checks as ck
from folianta.plans import derived as dv

MARK = " ¦ "  # joins array values, so that both engines return plain text
RULE_CLASSES = ["cion", "ment", "sch", "tion"]


def _documents(select):
    return lambda spark, sf_dir: dv.documents(spark, sf_dir).select(*select())


def _cell():
    joined = F.replace(F.col("text"), F.lit(". "), F.lit(" || "))
    return F.concat(F.lit("||"), joined, F.lit("||\t||"))


def _scalar_or_list():
    picked = F.filter(dv.words(dv.WORD), lambda w: w.startswith("th"))
    return ["doc_id", tx.scalar_or_list(F.array_distinct(picked)).alias("field")]


def _merge_subjects():
    merged = tx.merge_lists(dv.words(), F.array("lang", "source"), dv.words(dv.WORD))
    return ["doc_id", F.array_join(merged, MARK).alias("subjects")]


def best_by_language(spark, sf_dir):
    wide = dv.wide_export(dv.documents(spark, sf_dir))
    titles = [name for name in wide.columns if "dc.title[" in name]
    abstracts = [name for name in wide.columns if "abstract[" in name]
    return wide.select(
        F.col("unrelated").alias("source"),
        tx.best_by_language(titles).alias("title"),
        tx.best_by_language(abstracts).alias("abstract"),
    )


def render_prompt(spark, sf_dir):
    return dv.records(dv.documents(spark, sf_dir)).select(
        "doc_id",
        prompts.render_prompt(F.col("title"), F.col("abstract")).alias("prompt"),
        prompts.render_prompt(F.col("title"), F.lit(None).cast("string"), F.col("type")).alias(
            "example"
        ),
    )


def render_chat(spark, sf_dir):
    return prompts.render_chat(dv.table(spark, sf_dir, "conversations"))


def truncate_pad(spark, sf_dir):
    docs = dv.documents(spark, sf_dir).select(
        "doc_id", tx.pre_tokenize(F.col("text")).alias("tokens")
    )
    # only ids are ordered; the token arrays join their batch afterwards
    batches = positions.assign_batches(docs.select("doc_id"), "doc_id", fixed.INFERENCE_BATCH)
    padded = prompts.truncate_pad(
        docs.join(batches.select("doc_id", "batch"), "doc_id"), "tokens", "batch", limit=64
    )
    return padded.select(
        "doc_id", "batch",
        F.array_join("tokens", " ").alias("tokens"),
        F.array_join(F.transform("attention_mask", lambda m: m.cast("string")), "").alias("mask"),
    )


def search_url(spark, sf_dir):
    orders = dv.table(spark, sf_dir, "orders")
    year = F.date_format("o_orderdate", "yyyy")
    return orders.select(
        "o_orderkey",
        *[
            records.search_url(
                "https://repository.example/discover",
                F.col("o_custkey"),
                F.col("o_orderpriority"),
                [
                    ("type", F.col("o_orderstatus")),
                    ("dateIssued", F.concat(F.lit("["), year, F.lit(" TO "), year, F.lit("]"))),
                ],
                double_encode_spaces=quirk,
            ).alias(name)
            for name, quirk in (("url", False), ("quirk_url", True))
        ],
    )


QUERIES = {
    "clean_text": _documents(lambda: ["doc_id", tx.clean_text(F.col("text")).alias("clean")]),
    "split_list": _documents(
        lambda: [
            "doc_id",
            F.size(tx.split_list(_cell())).cast("bigint").alias("n"),
            F.array_join(tx.split_list(_cell()), MARK).alias("parts"),
        ]
    ),
    "best_by_language": best_by_language,
    "normalize_nfc": _documents(
        lambda: ["doc_id", tx.normalize_nfc(tx.decompose(F.col("text"))).alias("text")]
    ),
    "fold_text": _documents(lambda: ["doc_id", tx.fold_text(F.col("text")).alias("folded")]),
    "normalize_label": _documents(
        lambda: [
            "doc_id",
            tx.normalize_label(F.expr(dv.TYPE_SQL)).alias("label"),
            tx.normalize_label(F.col("text")).alias("text_label"),
        ]
    ),
    "extract_category": _documents(
        lambda: [
            "doc_id",
            tx.extract_category(F.concat(F.col("lang"), F.expr(dv.TYPE_SQL))).alias("category"),
            tx.extract_category(F.col("text"), RULE_CLASSES).alias("rule_category"),
        ]
    ),
    "render_prompt": render_prompt,
    "render_chat": render_chat,
    "scalar_or_list": _documents(_scalar_or_list),
    "first_line": _documents(lambda: ["doc_id", tx.first_line(F.col("text")).alias("line")]),
    "search_url": search_url,
    "pre_tokenize": _documents(
        lambda: ["doc_id", F.array_join(tx.pre_tokenize(F.col("text")), " ").alias("tokens")]
    ),
    "merge_subjects": _documents(_merge_subjects),
    "truncate_pad": truncate_pad,
    "run_timestamp": lambda spark, sf_dir: dv.table(spark, sf_dir, "events").select(
        "event_id", run_timestamp(F.col("ts")).alias("stamp")
    ),
    "default_label": _documents(
        lambda: [
            "doc_id",
            tx.default_label(F.expr(dv.TYPE_SQL), fixed.UNKNOWN_CLASS).alias("type"),
        ]
    ),
    "collapse_classes": _documents(
        lambda: [
            "doc_id",
            tx.collapse_classes(
                tx.normalize_nfc(F.expr(dv.TYPE_SQL)), fixed.MINORITY_CLASSES, fixed.COLLAPSED_CLASS
            ).alias("type"),
        ]
    ),
}

_TITLE = ck.first_line("text")
_URL = (
    "concat('https://repository.example/discover?rpp=100&page=', o_custkey, '&query=', {query},"
    " '&filtertype_0=type&filter_relational_operator_0=equals&filter_0=', o_orderstatus,"
    " '&filtertype_1=dateIssued&filter_relational_operator_1=equals&filter_1=',"
    " replace(url_encode(concat('[', year(o_orderdate), ' TO ', year(o_orderdate), ']')), '%20', '+'))"
)
_QUERY = "replace(url_encode(o_orderpriority), '%20', '+')"
_QUIRK = "url_encode(replace(o_orderpriority, ' ', '+'))"


def _header(role: str) -> str:
    return f"concat('{fixed.HEADER_START}', {role}, '{fixed.HEADER_END}', chr(10), chr(10))"


def _prompt(title: str, abstract: str) -> str:
    return (
        f"concat('{fixed.TEXT_START}', {_header(ck.quote('system'))},"
        f" {ck.quote(fixed.PROMPT_INSTRUCTIONS + fixed.TURN_END)}, {_header(ck.quote('user'))},"
        f" {ck.quote(fixed.PROMPT_REQUEST)}, '<titulo>', {title}, '</titulo>', chr(10),"
        f" '<resumen>', {abstract}, '</resumen>{fixed.TURN_END}',"
        f" {_header(ck.quote('assistant'))})"
    )


_CELL = "concat('||', replace(text, '. ', ' || '), '||', chr(9), '||')"
_PARTS = (
    f"list_filter(list_transform(string_split({_CELL}, '||'), lambda p: {ck.clean('p')}),"
    " lambda p: p <> '')"
)


def _distinct_in_order(values: str) -> str:
    return (
        f"list_filter({values}, lambda x, i: list_position({values}, x) = i)"
    )


ORACLES = {
    "clean_text": f"SELECT doc_id, {ck.clean('text')} AS clean FROM documents",
    "split_list": f"SELECT doc_id, len({_PARTS}) AS n, array_to_string({_PARTS}, '{MARK}') AS parts FROM documents",
    "best_by_language": f"""
        SELECT source,
               CASE WHEN n_chars > 1000 AND title <> '' THEN title
                    WHEN lang IN ('en', 'de') AND title <> '' THEN title
                    WHEN lang IN ('fr', 'de', 'es') THEN title ELSE '' END AS title,
               CASE WHEN lang IN ('en', 'es', 'de') THEN {ck.clean('text')} ELSE '' END AS abstract
        FROM (SELECT *, {ck.clean(_TITLE)} AS title FROM documents)""",
    "normalize_nfc": f"SELECT doc_id, {ck.nfc('text')} AS text FROM documents",
    "fold_text": "SELECT doc_id, lower(strip_accents(text)) AS folded FROM documents",
    "normalize_label": f"SELECT doc_id, {ck.label(dv.TYPE_SQL)} AS label, {ck.label('text')} AS text_label FROM documents",
    "extract_category": f"""
        SELECT doc_id, {ck.category(f'concat(lang, {dv.TYPE_SQL})')} AS category,
               {ck.category('text', RULE_CLASSES)} AS rule_category FROM documents""",
    "render_prompt": f"""
        SELECT doc_id, {_prompt('title', 'text')} AS prompt,
               concat({_prompt('title', "''")}, {dv.TYPE_SQL}, '{fixed.TURN_END}') AS example
        FROM (SELECT *, {_TITLE} AS title FROM documents)""",
    "render_chat": f"""
        SELECT conv_id, count(*) AS n_turns,
               string_agg(concat({_header('role')}, text, '{fixed.TURN_END}'), '' ORDER BY turn) AS chat
        FROM conversations GROUP BY ALL""",
    "scalar_or_list": f"""
        SELECT doc_id, CASE len(v) WHEN 0 THEN '""' WHEN 1 THEN to_json(v[1])::VARCHAR
                       ELSE to_json(v)::VARCHAR END AS field
        FROM (SELECT doc_id, {_distinct_in_order('w')} AS v
              FROM (SELECT doc_id, list_filter({ck.words(dv.WORD)}, lambda w: starts_with(w, 'th')) AS w
                    FROM documents))""",
    "first_line": f"SELECT doc_id, {_TITLE} AS line FROM documents",
    "search_url": f"""
        SELECT o_orderkey, {_URL.format(query=_QUERY)} AS url,
               {_URL.format(query=_QUIRK)} AS quirk_url FROM orders""",
    "pre_tokenize": f"SELECT doc_id, array_to_string({ck.tokens('text')}, ' ') AS tokens FROM documents",
    "merge_subjects": f"""
        SELECT doc_id, array_to_string({_distinct_in_order('w')}, '{MARK}') AS subjects
        FROM (SELECT doc_id, {ck.words()} || [lang, source] || {ck.words(dv.WORD)} AS w FROM documents)""",
    "truncate_pad": f"""
        WITH t AS (SELECT doc_id, {ck.tokens('text')} AS tokens,
                          (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch FROM documents),
        c AS (SELECT doc_id, batch, tokens[greatest(len(tokens) - 63, 1):] AS tokens FROM t),
        m AS (SELECT *, max(len(tokens)) OVER (PARTITION BY batch) AS longest FROM c)
        SELECT doc_id, batch,
               array_to_string(list_concat(list_transform(range(longest - len(tokens)), lambda i: '[PAD]'), tokens), ' ') AS tokens,
               repeat('0', longest - len(tokens)) || repeat('1', len(tokens)) AS mask
        FROM m""",
    "run_timestamp": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events",
    "default_label": f"SELECT doc_id, coalesce(nullif({dv.TYPE_SQL}, ''), '{fixed.UNKNOWN_CLASS}') AS type FROM documents",
    "collapse_classes": f"""
        SELECT doc_id, CASE WHEN t IN ({', '.join(map(ck.quote, fixed.MINORITY_CLASSES))})
                            THEN '{fixed.COLLAPSED_CLASS}' ELSE t END AS type
        FROM (SELECT doc_id, {ck.nfc(dv.TYPE_SQL)} AS t FROM documents)""",
}
