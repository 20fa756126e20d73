import pytest

from folianta.operators import evaluation

ROWS = [  # label, generated text
    ("Tesis", "Tesis"), ("Tesis", "Una tesis\notra"), ("Artículo", "articulo<|eot_id|>"),
    ("Artículo", "no se"), ("Libro", "Tesis"), ("Otro", "nosotros"),
]


def cells(spark, rows):
    df = spark.createDataFrame(rows, "type string, generated_text string")
    return evaluation.confusion(evaluation.judge(df))


def test_global_scores(spark):
    row = evaluation.global_scores(cells(spark, ROWS)).first()
    # tesis: p 2/3 r 1; articulo: p 1 r 1/2; libro 0; otro 1; sin_clasificar 0
    f1 = [0.8, 2 / 3, 0.0, 1.0, 0.0]
    assert row["n"] == 6
    assert row["accuracy"] == pytest.approx(4 / 6)
    assert row["exact_match"] == pytest.approx(2 / 6)
    assert row["macro_f1"] == pytest.approx(sum(f1) / 5)


def test_class_report_counts_unknown_predictions(spark):
    report = {r["label"]: r for r in evaluation.class_report(cells(spark, ROWS)).collect()}
    assert set(report) == {"tesis", "articulo", "libro", "otro", "sin_clasificar"}
    assert report["sin_clasificar"]["support"] == 0 and report["sin_clasificar"]["recall"] == 0.0
    assert report["tesis"]["precision"] == pytest.approx(2 / 3)
    assert report["libro"]["f1_score"] == 0.0


def test_domain_report_keeps_order_and_absent_classes(spark):
    rows = evaluation.domain_report(cells(spark, ROWS)).orderBy("class_order").collect()
    assert [r["title"] for r in rows][:3] == ["Objeto De Conferencia", "Objeto De Aprendizaje", "Articulo"]
    assert rows[0]["support"] == 0 and rows[0]["exact_match"] == 0.0 and rows[0]["f1_score"] == 0.0
    assert rows[3]["exact_match"] == pytest.approx(0.5)


def test_averages(spark):
    rows = {r["average"]: r for r in evaluation.report_averages(cells(spark, ROWS)).collect()}
    weighted = (2 * 0.8 + 2 * (2 / 3) + 1 * 0.0 + 1 * 1.0) / 6
    assert rows["weighted avg"]["f1_score"] == pytest.approx(weighted)
    assert rows["macro avg"]["support"] == 6
    assert rows["accuracy"]["f1_score"] == pytest.approx(4 / 6) and rows["accuracy"]["precision"] is None


def test_empty_input_scores_zero(spark):
    row = evaluation.global_scores(cells(spark, [])).first()
    assert (row["n"], row["accuracy"], row["exact_match"], row["macro_f1"]) == (0, 0.0, 0.0, 0.0)


def test_batches_are_bounded_and_complete(spark):
    def predict(texts):
        assert len(texts) <= 4
        return [str(len(texts))] * len(texts)

    prompts = spark.range(10).selectExpr("id", "'p' AS prompt").coalesce(1)
    got = evaluation.batch_predict(prompts, "prompt", lambda: predict, batch_rows=4).collect()
    assert sorted(r["generated_text"] for r in got) == ["2"] * 2 + ["4"] * 8


def test_throughput_counts_padding_and_guards_zero(spark):
    rows = spark.createDataFrame(
        [("a", 0, 3, 1.0), ("a", 0, 5, 1.0), ("a", 1, 2, 2.0), ("b", 0, 1, 0.0)],
        "g string, batch int, tokens int, seconds double",
    )
    got = {r["g"]: r for r in evaluation.throughput(rows, "g", "batch", "tokens", "seconds").collect()}
    assert got["a"]["tokens"] == 12 and got["a"]["tokens_per_second"] == 3.0
    assert got["b"]["samples_per_second"] == 0.0
