"""Registered queries over predictions and their scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.functions import prompts
from folianta.operators import classifier, evaluation, split
from folianta.plans import checks as ck
from folianta.plans import derived as dv
from folianta.storage import materialize

DIGITS = 6
SCORES = ["precision", "recall", "f1_score"]


def _rounded(df, names):
    return df.select(
        *[F.round(name, DIGITS).alias(name) if name in names else name for name in df.columns]
    )


def _judged(spark, sf_dir):
    return evaluation.judge(dv.answers(dv.documents(spark, sf_dir)))


def _cells(spark, sf_dir):
    # at most classes squared rows; two consumers would otherwise judge all answers twice
    return materialize(evaluation.confusion(_judged(spark, sf_dir)), "confusion")


def eval_join(spark, sf_dir):
    docs = dv.documents(spark, sf_dir)
    said = dv.answers(docs).select("doc_id", "generated_text")
    truth = docs.select("doc_id", F.expr(dv.TYPE_SQL).alias("type"))
    judged = evaluation.judge(evaluation.align(said, truth, "doc_id"))
    return judged.select("doc_id", "ref", "pred", "exact")


def eval_global(spark, sf_dir):
    scores = evaluation.global_scores(_cells(spark, sf_dir))
    return _rounded(scores, ["accuracy", "exact_match", "macro_f1"])


def exact_match_per_class(spark, sf_dir):
    cells = evaluation.confusion(_judged(spark, sf_dir))
    return _rounded(evaluation.exact_match_per_class(cells), ["exact_match"])


def class_report(spark, sf_dir):
    report = evaluation.domain_report(_cells(spark, sf_dir))
    return _rounded(report, [*SCORES, "exact_match"]).orderBy("class_order")


def label_report(spark, sf_dir):
    return _rounded(evaluation.class_report(evaluation.confusion(_judged(spark, sf_dir))), SCORES)


def macro_f1(spark, sf_dir):
    report = evaluation.class_report(evaluation.confusion(_judged(spark, sf_dir)))
    return report.agg(F.round(F.avg("f1_score"), DIGITS).alias("macro_f1"))


def report_averages(spark, sf_dir):
    return _rounded(evaluation.report_averages(_cells(spark, sf_dir)), SCORES)


def throughput(spark, sf_dir):
    samples = dv.table(spark, sf_dir, "events").select(
        "event_type",
        F.floor(F.col("event_id") / fixed.INFERENCE_BATCH).alias("batch"),
        F.get_json_object("props", "$.k").cast("bigint").alias("tokens"),
        F.col("value").alias("seconds"),
    )
    rates = evaluation.throughput(samples, "event_type", "batch", "tokens", "seconds")
    return rates.select(
        "event_type", "samples", "tokens",
        *[F.round(name, DIGITS).alias(name) for name in ("samples_per_second", "tokens_per_second")],
    )


def rule_predictor(texts: list[str]) -> list[str]:
    """Stands in for a model: an ordered keyword rule."""
    rules = [("sch", "Tesis"), ("tion", "Articulo"), ("eaux", "Libro")]
    return [next((name for key, name in rules if key in text), "Otro") for text in texts]


def batch_predict(spark, sf_dir):
    prompt = prompts.render_prompt(F.lit(""), F.col("text")).alias("prompt")
    asked = dv.documents(spark, sf_dir).select("doc_id", prompt)
    return evaluation.batch_predict(asked, "prompt", lambda: rule_predictor).drop("prompt")




def _labelled(spark, sf_dir):
    docs = dv.documents(spark, sf_dir)
    labels = dv.table(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id").select(
        "doc_id", "text", F.col("quality").cast("string").alias("type")
    )
    return split.stratified_split(materialize(rows, "labelled"), "doc_id", seed="quality")


def _classified(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    model = classifier.train_classifier(rows.filter("split = 'train'"))
    return classifier.classify(model, rows)


def train_classifier(spark, sf_dir):
    return _classified(spark, sf_dir).select(
        "doc_id", "split", "type", "generated_text", F.round("confidence", 4).alias("confidence")
    )


def evaluate_classifier(spark, sf_dir):
    held_out = _classified(spark, sf_dir).filter("split = 'held_out'")
    judged = evaluation.judge(held_out, classes=["0", "1"])
    cells = materialize(evaluation.confusion(judged), "confusion")
    return _rounded(evaluation.domain_report(cells, classes=["0", "1"]), [*SCORES, "exact_match"])


def classifier_facts(spark, sf_dir):
    """Rows of each side and class, and whether the classifier beats the larger class."""
    rows = _classified(spark, sf_dir)
    right = F.sum((F.col("type") == F.col("generated_text")).cast("bigint")).alias("right")
    sums = materialize(rows.groupBy("split", "type").agg(F.count("*").alias("n"), right), "classified")
    sides = sums.groupBy("split").agg((F.sum("right") >= F.max("n")).alias("beats_majority"))
    return sums.join(sides, "split").select("split", "type", "n", "beats_majority")


QUERIES = {
    "eval_join": eval_join,
    "eval_global": eval_global,
    "exact_match_per_class": exact_match_per_class,
    "class_report": class_report,
    "label_report": label_report,
    "macro_f1": macro_f1,
    "report_averages": report_averages,
    "throughput": throughput,
    "batch_predict": batch_predict,
    "classifier_facts": classifier_facts,
    "train_classifier": train_classifier,
    "evaluate_classifier": evaluate_classifier,
}

_JUDGED = f"WITH {ck.judged()}"
_REPORT = f"{_JUDGED}, {ck.REPORT}"
_DOMAIN = ", ".join(f"({at}, '{name}')" for at, name in enumerate(fixed.CLASS_DOMAIN))
_EXACT = f"""
    SELECT class_order, label,
           CASE WHEN count(ref) > 0 THEN (count(*) FILTER (exact))::DOUBLE / count(ref) ELSE 0.0 END AS exact_match,
           count(ref) AS support
    FROM (VALUES {_DOMAIN}) d(class_order, label) LEFT JOIN judged ON ref = label GROUP BY ALL"""
_ROUNDED = ", ".join(f"round({name}, {DIGITS}) AS {name}" for name in SCORES)

ORACLES = {
    "eval_join": f"{_JUDGED} SELECT doc_id, ref, pred, exact FROM judged",
    "eval_global": f"""{_REPORT}
        SELECT count(*) AS n, round(avg((ref = pred)::INT), {DIGITS}) AS accuracy,
               round(avg(exact::INT), {DIGITS}) AS exact_match,
               (SELECT round(avg(f1_score), {DIGITS}) FROM report) AS macro_f1 FROM judged""",
    "exact_match_per_class": f"""{_JUDGED}
        SELECT class_order, label, round(exact_match, {DIGITS}) AS exact_match, support FROM ({_EXACT})""",
    "class_report": f"""{_REPORT}
        SELECT class_order, label,
               array_to_string(list_transform(string_split(label, ' '),
                   lambda w: upper(left(w, 1)) || w[2:]), ' ') AS title,
               coalesce(round(precision, {DIGITS}), 0.0) AS precision,
               coalesce(round(recall, {DIGITS}), 0.0) AS recall,
               coalesce(round(f1_score, {DIGITS}), 0.0) AS f1_score,
               round(exact_match, {DIGITS}) AS exact_match, e.support AS support
        FROM ({_EXACT}) e LEFT JOIN report USING (label)""",
    "label_report": f"{_REPORT} SELECT label, {_ROUNDED}, support FROM report",
    "macro_f1": f"{_REPORT} SELECT round(avg(f1_score), {DIGITS}) AS macro_f1 FROM report",
    "report_averages": f"""{_REPORT}
        SELECT 'macro avg' AS average, {', '.join(f'round(avg({n}), {DIGITS}) AS {n}' for n in SCORES)},
               sum(support)::BIGINT AS support FROM report
        UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support), {DIGITS}), sum(support)::BIGINT FROM report
        UNION ALL SELECT 'weighted avg',
               {', '.join(f'round(sum({n} * support) / sum(support), {DIGITS})' for n in SCORES)},
               sum(support)::BIGINT FROM report""",
    "throughput": f"""
        SELECT event_type, sum(n)::BIGINT AS samples, sum(padded)::BIGINT AS tokens,
               round(sum(n) / sum(seconds), {DIGITS}) AS samples_per_second,
               round(sum(padded) / sum(seconds), {DIGITS}) AS tokens_per_second
        FROM (SELECT event_type, event_id // {fixed.INFERENCE_BATCH} AS batch, count(*) AS n,
                     max(json_extract(props, '$.k')::BIGINT) * count(*) AS padded, sum(value) AS seconds
              FROM events GROUP BY ALL) GROUP BY ALL""",
    "classifier_facts": """
        WITH c AS (SELECT quality AS type, count(*) AS n, (sum(count(*)) OVER ())::BIGINT AS total
                   FROM documents JOIN labels USING (doc_id) GROUP BY quality),
        t AS (SELECT *, total - ceil(0.30::DOUBLE * total)::BIGINT AS target FROM c),
        e AS (SELECT *, n::DOUBLE * target / total AS exact FROM t),
        q AS (SELECT type, n, floor(exact)::BIGINT + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, type)
                     <= target - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM e)
        SELECT 'train' AS split, type::VARCHAR AS type, quota AS n, true AS beats_majority FROM q WHERE quota > 0
        UNION ALL SELECT 'held_out', type::VARCHAR, n - quota, true FROM q WHERE n > quota""",
    "batch_predict": """
        SELECT doc_id, CASE WHEN contains(text, 'sch') THEN 'Tesis' WHEN contains(text, 'tion') THEN 'Articulo'
                            WHEN contains(text, 'eaux') THEN 'Libro' ELSE 'Otro' END AS generated_text
        FROM documents""",
}
