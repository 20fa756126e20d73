"""Fragments of the checking SQL that several queries share."""

from __future__ import annotations

from folianta import fixed_values as fixed
from folianta.plans import derived as dv

WS = fixed.WHITESPACE
WORDS = fixed.WORD_CHARS
TOKEN = f"[{WORDS}]+|[^{WORDS}{fixed.TOKEN_GAPS}]+"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def collapse(value: str) -> str:
    return f"trim(regexp_replace({value}, '[{WS}]+', ' ', 'g'))"


def clean(value: str) -> str:
    return collapse(f"coalesce({value}, '')")


def strip(value: str) -> str:
    return f"regexp_replace({value}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def first_line(value: str) -> str:
    return strip(f"split_part({strip(value)}, chr(10), 1)")


def nfc(value: str) -> str:
    return collapse(f"regexp_replace(nfc_normalize({value}), '{fixed.CONTROL_CHARS}', '', 'g')")


def label(value: str) -> str:
    return f"strip_accents(lower({strip(value)}))"


def tokens(value: str) -> str:
    return f"regexp_extract_all({value}, '{TOKEN}')"


def words(pattern: str = dv.NAME, value: str = "text") -> str:
    return f"regexp_extract_all({value}, '{pattern}')"


def category(value: str, classes: list[str] | None = None) -> str:
    cases = "".join(
        f" WHEN contains(v, {quote(name)}) THEN {quote(name)}"
        for name in classes or fixed.CLASS_DOMAIN
    )
    return f"(SELECT CASE{cases} ELSE '{fixed.UNCLASSIFIED}' END FROM (SELECT {label(value)} AS v))"


def collapse_type(value: str) -> str:
    listed = ", ".join(quote(name) for name in fixed.MINORITY_CLASSES)
    return (
        f"coalesce(nullif(CASE WHEN {nfc(value)} IN ({listed}) THEN '{fixed.COLLAPSED_CLASS}'"
        f" ELSE {nfc(value)} END, ''), '{fixed.UNKNOWN_CLASS}')"
    )


def typed_documents() -> str:
    return f"SELECT doc_id, text, n_chars, lang, {collapse_type(dv.TYPE_SQL)} AS type FROM documents"


def split_ctes(rows: str, seed: str) -> str:
    """CTEs ``parted(doc_id, type, split)`` of the exact three-way split of ``rows``."""
    def quota(counts: str, share: str) -> str:
        return f"""
            SELECT type, n, w + CASE WHEN row_number() OVER (ORDER BY e - w DESC, type) <= t - sum(w) OVER ()
                                     THEN 1 ELSE 0 END AS quota
            FROM (SELECT *, floor(e)::BIGINT AS w FROM (
                SELECT *, n::DOUBLE * t / total AS e FROM (
                    SELECT *, total - ceil({share} * total)::BIGINT AS t FROM (
                        SELECT type, n, (sum(n) OVER ())::BIGINT AS total FROM {counts}))))"""

    return f"""
    rows_in AS ({rows}),
    counts AS (SELECT type, count(*) AS n FROM rows_in GROUP BY type),
    frequent AS (SELECT * FROM counts WHERE n >= {fixed.MIN_CLASS_ROWS}),
    q1 AS ({quota('frequent', '0.30::DOUBLE')}),
    r1 AS (SELECT doc_id, type, quota, row_number() OVER (
               PARTITION BY type ORDER BY md5(concat(doc_id, ':{seed}')), doc_id) AS rn
           FROM rows_in JOIN q1 USING (type)),
    held AS (SELECT doc_id, type FROM r1 WHERE rn > quota),
    counts2 AS (SELECT type, count(*) AS n FROM held GROUP BY type
                HAVING count(*) >= {fixed.MIN_HELDOUT_ROWS}),
    q2 AS ({quota('counts2', '0.50::DOUBLE')}),
    r2 AS (SELECT doc_id, r1.type, q2.quota, row_number() OVER (PARTITION BY r1.type ORDER BY rn) AS rn
           FROM r1 JOIN q2 USING (type) WHERE rn > r1.quota),
    parted AS (
        SELECT doc_id, type, 'train' AS split FROM r1 WHERE rn <= quota
        UNION ALL
        SELECT doc_id, type, CASE WHEN rn <= quota THEN 'val' ELSE 'test' END FROM r2)"""


def judged() -> str:
    said = f"regexp_replace(generated_text, '{CONTROL}', '', 'g')"
    return f"""
    answers AS (SELECT doc_id, type, {dv.ANSWER_SQL} AS generated_text
                FROM (SELECT doc_id, text, {dv.TYPE_SQL} AS type FROM documents)),
    judged AS (SELECT doc_id, type, generated_text, {label('type')} AS ref,
                      {category(said)} AS pred,
                      {label(first_line(said))} = {label('type')} AS exact
               FROM answers)"""


CONTROL = "|".join(token.replace("|", r"\|") for token in fixed.CONTROL_TOKENS)

REPORT = """
    labels_seen AS (SELECT ref AS label FROM judged UNION SELECT pred FROM judged),
    report AS (
        SELECT label,
               count(*) FILTER (ref = label AND pred = label) AS hits,
               count(*) FILTER (ref = label) AS support,
               count(*) FILTER (pred = label) AS predicted,
               CASE WHEN count(*) FILTER (pred = label) > 0
                    THEN count(*) FILTER (ref = label AND pred = label)::DOUBLE
                         / count(*) FILTER (pred = label) ELSE 0.0 END AS precision,
               CASE WHEN count(*) FILTER (ref = label) > 0
                    THEN count(*) FILTER (ref = label AND pred = label)::DOUBLE
                         / count(*) FILTER (ref = label) ELSE 0.0 END AS recall,
               CASE WHEN count(*) FILTER (ref = label) + count(*) FILTER (pred = label) > 0
                    THEN 2.0 * count(*) FILTER (ref = label AND pred = label)
                         / (count(*) FILTER (ref = label) + count(*) FILTER (pred = label))
                    ELSE 0.0 END AS f1_score
        FROM labels_seen JOIN judged ON label = ref OR label = pred
        GROUP BY label)"""
