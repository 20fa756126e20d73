"""Registered queries over runs and their summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.operators import runs
from folianta.plans import derived as dv
from folianta.sources import run_logs
from folianta.storage import shared_dir

DIGITS = 6
KEYS = ["l_returnflag", "line_status"]
METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CONFIG = [*fixed.CONFIG_KEYS, "seed"]
SEEDS = [42, 3688191069, 7]


def _rounded(df):
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(
        *[F.round(name, DIGITS).alias(name) if name in doubles else name for name in df.columns]
    )


def _lines(spark, sf_dir):
    return dv.table(spark, sf_dir, "lineitem")


def _flagged(spark, sf_dir):
    return _lines(spark, sf_dir).withColumn(
        "line_status", F.nullif(F.col("l_linestatus"), F.lit("F"))
    )


def run_summary(spark, sf_dir):
    return _rounded(runs.ordered_summary(_flagged(spark, sf_dir), KEYS, METRICS))


def run_summary_by_class(spark, sf_dir):
    keys = [*KEYS, "l_linenumber"]
    return _rounded(runs.run_summary(_flagged(spark, sf_dir), keys, METRICS))


def run_summary_by_epoch(spark, sf_dir):
    events = dv.table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("epoch"),
        "user_id",
        F.when(F.col("event_type") == "click", F.col("value")).alias("loss"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("eval_loss"),
    )
    merged = runs.merge_epochs(events, ["epoch", "user_id"], ["loss", "eval_loss"])
    return _rounded(runs.run_summary(merged, ["epoch"], ["loss", "eval_loss"]))


def summary_csv_roundtrip(spark, sf_dir):
    summary = runs.run_summary(_flagged(spark, sf_dir), KEYS, METRICS)
    path = shared_dir(spark, "summary")
    run_logs.write_summary_csv(summary, path)
    return _rounded(run_logs.read_summary_csv(spark, path, summary.schema))


def final_losses(spark, sf_dir):
    history = dv.table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") == "signup", F.col("value")).alias("loss"),
        F.when(
            (F.col("event_type") == "error") & (F.col("value") > 60), F.col("value")
        ).alias("eval_loss"),
    )
    return runs.final_losses(history, "user_id", "event_id", ["loss", "eval_loss"])


def derived_ratios(spark, sf_dir):
    sums = _lines(spark, sf_dir).groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("trainable"),
        F.sum("l_quantity").alias("total"),
        F.sum("l_tax").alias("seconds"),
        F.sum((F.col("l_quantity") > 49).cast("bigint")).alias("calls"),
    )
    return sums.select(
        "l_suppkey",
        F.round(runs.share_percent(F.col("trainable"), F.col("total")), 4).alias("trainable_percent"),
        F.round(runs.milliseconds_per_call(F.col("seconds"), F.col("calls")), 2).alias("ms_per_call"),
    )


def _configs(spark, sf_dir):
    return runs.null_by_method(dv.line_configs(_lines(spark, sf_dir)))


def run_key(spark, sf_dir):
    counted = _configs(spark, sf_dir).groupBy(*CONFIG).agg(F.count("*").alias("n"))
    return counted.withColumn("run_key", runs.run_key())


def train_eval_join(spark, sf_dir):
    configs = _configs(spark, sf_dir)

    def phase(flag, metric):
        chosen = configs.filter(F.col("l_returnflag") == flag)
        return chosen.groupBy(*CONFIG).agg(F.round(F.avg("l_tax"), DIGITS).alias(metric))

    return runs.match_configs(phase("A", "train_tax"), phase("R", "eval_tax"), CONFIG, "inner")


def missing_runs(spark, sf_dir):
    done = _configs(spark, sf_dir).filter((F.col("l_quantity") >= 10) & (F.col("l_discount") < 0.05))
    return runs.missing_runs(runs.expected_runs(spark, SEEDS), done)


def _landed_metrics(spark, sf_dir):
    """One evaluated run per configuration, with two classes each."""
    tagged = dv.line_configs(_lines(spark, sf_dir)).withColumn(
        "class", F.when(F.col("l_tax") < 0.04, "articulo").otherwise("tesis")
    )
    nulled = runs.null_by_method(tagged)
    per_class = nulled.groupBy(*CONFIG, "class").agg(
        F.struct(
            F.avg("l_discount").alias("f1_score"),
            F.avg("l_tax").alias("exact_match"),
            F.max("l_discount").alias("precision"),
            F.max("l_tax").alias("recall"),
            F.count("*").cast("double").alias("support"),
        ).alias("scores")
    )
    nested = per_class.groupBy(*CONFIG).agg(
        F.map_from_entries(F.collect_list(F.struct("class", "scores"))).alias("per_class"),
        F.sum("scores.support").alias("n"),
    )
    whole = F.struct(*[F.col("n").alias(name) for name in fixed.EVAL_METRICS])
    document = nested.select(
        F.struct(F.lit("eval").alias("fase"), *CONFIG).alias("config"),
        F.struct(whole.alias("global"), F.col("per_class")).alias("metrics"),
    )
    path = shared_dir(spark, "run-metrics")
    document.write.json(path)
    return path


def scan_run_metrics(spark, sf_dir):
    evals = run_logs.read_eval_metrics(spark, _landed_metrics(spark, sf_dir), multi_line=False)
    return _rounded(run_logs.class_rows(evals))


def scan_loss_history(spark, sf_dir):
    """One history file per event type: a JSON array with a sparse entry per day."""
    days = dv.table(spark, sf_dir, "events").groupBy(
        "event_type", F.dayofmonth("ts").cast("double").alias("epoch")
    ).agg(
        F.max("event_id").alias("step"),
        F.max("value").alias("value"),
    )
    odd = F.col("epoch") % 2 == 1
    entry = F.struct(
        "epoch", "step",
        F.when(odd, F.col("value")).alias("loss"),
        F.when(~odd, F.col("value")).alias("eval_loss"),
    )
    arrays = days.groupBy("event_type").agg(
        F.to_json(F.array_sort(F.collect_list(entry))).alias("value")
    )
    path = shared_dir(spark, "loss-history")
    arrays.write.partitionBy("event_type").text(path)
    return run_logs.read_loss_history(spark, path).select(
        "event_type", "epoch", "step", "loss", "eval_loss"
    )


QUERIES = {
    "run_summary": run_summary,
    "run_summary_by_class": run_summary_by_class,
    "run_summary_by_epoch": run_summary_by_epoch,
    "summary_csv_roundtrip": summary_csv_roundtrip,
    "final_losses": final_losses,
    "derived_ratios": derived_ratios,
    "run_key": run_key,
    "train_eval_join": train_eval_join,
    "missing_runs": missing_runs,
    "scan_run_metrics": scan_run_metrics,
    "scan_loss_history": scan_loss_history,
}


def _summary(metrics, rows, keys):
    means = ", ".join(f"round(avg({m}), {DIGITS}) AS {m}_mean" for m in metrics)
    stds = ", ".join(f"round(stddev_samp({m}), {DIGITS}) AS {m}_std" for m in metrics)
    return f"SELECT {', '.join(keys)}, {means}, {stds} FROM ({rows}) GROUP BY {', '.join(keys)}"


_FLAGGED = "SELECT *, nullif(l_linestatus, 'F') AS line_status FROM lineitem"
_ADAPTERS = ", ".join(f"'{name}'" for name in fixed.ADAPTER_METHODS)
_PROJECTIONS = ", ".join(f"'{name}'" for name in fixed.PROJECTION_METHODS)
_C = dv.CONFIG_SQL
_CONFIGS = f"""
    SELECT * REPLACE (CASE WHEN method IN ({_ADAPTERS}) THEN lora_r END AS lora_r,
                      CASE WHEN method IN ({_PROJECTIONS}) THEN galore_rank END AS galore_rank,
                      CASE WHEN method IN ({_PROJECTIONS}) THEN update_proj_gap END AS update_proj_gap)
    FROM (SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in _C.items())} FROM lineitem)"""
_SAME = " AND ".join(f"a.{key} IS NOT DISTINCT FROM b.{key}" for key in CONFIG)
_CONFIG_LIST = ", ".join(CONFIG)
_LAST = "arg_max({0}, CASE WHEN {0} IS NOT NULL THEN event_id END)"

ORACLES = {
    "run_summary": _summary(METRICS, _FLAGGED, KEYS),
    "run_summary_by_class": _summary(METRICS, _FLAGGED, [*KEYS, "l_linenumber"]),
    "run_summary_by_epoch": _summary(
        ["loss", "eval_loss"],
        """SELECT strftime(ts, '%Y-%m-%d') AS epoch, user_id,
                  max(value) FILTER (event_type = 'click') AS loss,
                  max(value) FILTER (event_type = 'view') AS eval_loss FROM events GROUP BY ALL""",
        ["epoch"],
    ),
    "summary_csv_roundtrip": _summary(METRICS, _FLAGGED, KEYS),
    "final_losses": f"""
        SELECT user_id, coalesce(printf('%.4f', {_LAST.format('loss')}), 'N/A') AS final_loss,
               coalesce(printf('%.4f', {_LAST.format('eval_loss')}), 'N/A') AS final_eval_loss
        FROM (SELECT *, CASE WHEN event_type = 'signup' THEN value END AS loss,
                     CASE WHEN event_type = 'error' AND value > 60 THEN value END AS eval_loss
              FROM events) GROUP BY user_id""",
    "derived_ratios": """
        SELECT l_suppkey,
               round(100 * sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) / sum(l_quantity), 4)
                   AS trainable_percent,
               round(sum(l_tax) / greatest(count(*) FILTER (l_quantity > 49), 1) * 1000, 2) AS ms_per_call
        FROM lineitem GROUP BY l_suppkey""",
    "run_key": f"""
        SELECT {_CONFIG_LIST}, count(*) AS n,
               CASE WHEN method IN ({_ADAPTERS}) THEN concat(method, '_r', lora_r, '_', target_modules, '_s', seed)
                    WHEN method IN ({_PROJECTIONS})
                    THEN concat(method, '_r', galore_rank, '_gap', update_proj_gap, '_', target_modules, '_s', seed)
                    ELSE concat(method, '_s', seed) END AS run_key
        FROM ({_CONFIGS}) GROUP BY {_CONFIG_LIST}""",
    "train_eval_join": f"""
        WITH p AS (SELECT {_CONFIG_LIST}, l_returnflag, round(avg(l_tax), {DIGITS}) AS tax
                   FROM ({_CONFIGS}) GROUP BY ALL)
        SELECT {', '.join(f'a.{key} AS {key}' for key in CONFIG)}, a.tax AS train_tax, b.tax AS eval_tax
        FROM p a JOIN p b ON {_SAME} WHERE a.l_returnflag = 'A' AND b.l_returnflag = 'R'""",
    "missing_runs": f"""
        WITH ranks AS (SELECT unnest([8, 16, 32, 64, 128]) AS r),
        grid AS (SELECT 'fft' AS method, NULL::INT AS lora_r, NULL::INT AS galore_rank,
                        NULL::INT AS update_proj_gap, 'all' AS target_modules
                 UNION ALL SELECT m, r, NULL, NULL, 'attn' FROM ranks, (SELECT unnest(['lora', 'dora']) AS m)
                 UNION ALL SELECT m, r, NULL, NULL, 'all' FROM ranks, (SELECT unnest([{_ADAPTERS}]) AS m)
                 UNION ALL VALUES ('galore', NULL, 128, 500, 'all'), ('galore_rsvd', NULL, 128, 200, 'all'),
                                  ('galore_rsvd', NULL, 128, 500, 'all')),
        a AS (SELECT * FROM grid, (SELECT unnest([42, 3688191069, 7]) AS seed)),
        b AS (SELECT * FROM ({_CONFIGS}) WHERE l_quantity >= 10 AND l_discount < 0.05)
        SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE {_SAME})""",
    "scan_run_metrics": f"""
        SELECT 'eval' AS fase, {_CONFIG_LIST}, CASE WHEN l_tax < 0.04 THEN 'articulo' ELSE 'tesis' END AS class,
               round(avg(l_discount), {DIGITS}) AS f1_score, round(avg(l_tax), {DIGITS}) AS exact_match,
               round(max(l_discount), {DIGITS}) AS precision, round(max(l_tax), {DIGITS}) AS recall,
               count(*)::DOUBLE AS support
        FROM ({_CONFIGS}) GROUP BY ALL""",
    "scan_loss_history": """
        SELECT event_type, epoch, step, CASE WHEN epoch % 2 = 1 THEN v END AS loss,
               CASE WHEN epoch % 2 = 0 THEN v END AS eval_loss
        FROM (SELECT event_type, day(ts)::DOUBLE AS epoch, max(event_id) AS step, max(value) AS v
              FROM events GROUP BY ALL)""",
}
