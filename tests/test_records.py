import itertools
import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folianta.operators import positions, records, runs
from folianta.plans import vector_queries
from folianta.sources import html, jsonl, record_xml, run_logs, wide_csv
from folianta.storage import bounded_table, spread
from folianta.streaming import ingest

RECORDS = """<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>
<record><header><identifier>oai:1</identifier><datestamp>2024-01-02T00:00:00Z</datestamp></header>
<metadata><oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/"
 xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>A &amp; B</dc:title><dc:subject>x</dc:subject>
<dc:subject>y</dc:subject><dc:subject>x</dc:subject><dc:rights></dc:rights>
<dc:identifier>doc/1</dc:identifier></oai_dc:dc></metadata></record>
<record><header status="deleted"><identifier>oai:2</identifier>
<datestamp>2024-01-03T00:00:00Z</datestamp></header></record>
</ListRecords></OAI-PMH>"""


def test_record_scan_and_export(spark, folder):
    Path(folder, "page.xml").write_text(RECORDS, encoding="utf-8")
    found = record_xml.read_records(spark, folder)
    rows = {r["identifier"]: r for r in found.collect()}
    assert rows["oai:1"]["status"] == "active" and rows["oai:2"]["status"] == "deleted"
    assert rows["oai:1"]["dc"]["subject"] == ["x", "y"] and rows["oai:1"]["dc"]["rights"] == []
    assert rows["oai:2"]["dc"] is None
    flat = {r["status"]: r for r in record_xml.flat_records(found).collect()}
    assert flat["active"]["identifier"] == '"doc/1"'  # replaced by the metadata's own
    assert flat["active"]["title"] == '"A & B"' and flat["active"]["subject"] == '["x","y"]'
    assert flat["active"]["creator"] == '""'
    assert flat["deleted"]["identifier"] == '"oai:2"' and flat["deleted"]["title"] is None


def test_damaged_records_take_nothing_with_them(spark, folder):
    def record(name, stamp="2024-01-02"):
        return f"<record><header><identifier>{name}</identifier><datestamp>{stamp}</datestamp></header></record>"

    broken = "<record><header><identifier>x2</identifier></record>", "<record><header><identifier>x4</identifier>"
    text = record("x1") + broken[0] + record("x3", "soon") + broken[1] + record("x5") + "<record>cut off"
    Path(folder, "page.xml").write_text(f"<OAI-PMH><ListRecords>{text}", encoding="utf-8")
    rows = {r["identifier"]: r for r in record_xml.read_records(spark, folder).collect()}
    assert set(rows) == {"x1", "x3", "x5"}
    assert rows["x3"]["datestamp"] is None and rows["x3"]["stamp"] == "soon" and rows["x1"]["datestamp"]
    damaged = [r["element"] for r in record_xml.damaged_records(spark, folder).collect()]
    assert len(damaged) == 3 and all(any(name in d for d in damaged) for name in ("x2", "x4", "cut off"))


def test_unreadable_responses_are_broken(spark):
    bodies = ["<a><b></a>", "", None, "plain text", "<a/><b/>", '<?xml version="1.0"?><a>&nbsp;</a>']
    frame = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [r["state"] for r in record_xml.audit_responses(frame).collect()]
    assert got == ["broken"] * 4 + ["complete", "broken"]


def test_csv_files_keep_their_own_headers(spark, folder):
    Path(folder, "a.csv").write_text("dc.title[es],dc.type[es]\nA,Tesis\n", encoding="utf-8")
    Path(folder, "b.csv").write_text("dc.type[es],x,dc.title[es]\nLibro,1,B\n", encoding="utf-8")
    Path(folder, "c.csv").write_text("dc.title[es]\nC\n", encoding="utf-8")
    rows = {(r["title"], r["type"]) for r in wide_csv.convert_records(wide_csv.read_wide_csv(spark, folder)).collect()}
    assert rows == {("A", "Tesis"), ("B", "Libro"), ("C", "")}


def test_links_of_a_page(spark):
    page = (
        "<!-- <a href='/handle/0'> --><a href='/handle/1?a=1&amp;b=2'><a href=\"/handle/1?a=1&b=2\">"
        "<a href='handle/3'><a href='//o.example/handle/4'><a href='http://p.example/handle/5'><a href='?x=/handle/6'>"
    )
    pages = spark.createDataFrame([("https://s.example/x/y.html#z", page)], "url string, html string")
    got = [r["href"] for r in html.page_links(pages, "url", base="url", deny=[]).collect()]
    assert got == [
        "https://s.example/handle/1?a=1&b=2", "https://s.example/x/handle/3", "https://o.example/handle/4",
        "http://p.example/handle/5", "https://s.example/x/y.html?x=/handle/6",
    ]


def test_versions_without_stamp_stay(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", "2024-01-01", 1), ("b", None, 9)], "k string, t string, n int")
    got = {r["k"]: r["n"] for r in records.latest_versions(rows, "k", "t", "n").collect()}
    assert got == {"a": 2, "b": 1}


def test_window_holds_its_last_day(spark):
    rows = spark.createDataFrame([("2024-01-12 15:00:00",), ("2024-01-13 00:00:00",)], "t string").withColumn("t", F.to_timestamp("t"))
    assert records.harvest_window(rows, "t", end="2024-01-12").count() == 1
    assert records.harvest_window(rows, "t", end="2024-01-12 14:00:00").count() == 0


def test_all_results(spark):
    rows = spark.range(1000)
    assert records.all_results(rows, [F.col("id")], page=3).count() == 800
    assert records.all_results(rows, [F.col("id")], max_items=0).count() == 0


def test_audit(spark):
    bodies = [
        RECORDS,
        RECORDS.replace("</ListRecords>", "<resumptionToken>t1</resumptionToken></ListRecords>"),
        '<OAI-PMH xmlns="urn:x"><error code="badArgument">no</error></OAI-PMH>',
    ]
    frame = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = {r["state"]: r for r in record_xml.audit_responses(frame).collect()}
    assert got["complete"]["records"] == 2 and got["complete"]["token"] is None
    assert got["more"]["token"] == "t1"
    assert (got["broken"]["error_code"], got["broken"]["error_text"]) == ("badArgument", "no")


def test_html(spark):
    page = (
        "<META content='a > b name=DC.fake' name=\"DC.title\"><meta name=DC.date content=2020>"
        "<meta name='DCTERMS.subject' content=' x &amp; y '><meta name='DCTERMS.subject' content='z'>"
        "<meta name='DCTERMS.subject' content='z'><meta name='other' content='n'>"
        "<meta name='DC.rights' content='  '>"
        "<a class=k href='/handle/1'>1</a><A HREF=\"/handle/2/browse\">2</A><a href=/handle/1>3</a><a>4</a>"
    )
    pages = spark.createDataFrame([(1, page), (2, "<p>none")], "id int, html string")
    got = {r["name"]: r["values"] for r in html.meta_values(pages, "id").collect()}
    assert got == {"title": ["a > b name=DC.fake"], "date": ["2020"], "subject": ["x & y", "z"]}
    assert [r["href"] for r in html.page_links(pages).collect()] == ["/handle/1"]


def test_wide_csv(spark, folder):
    text = (
        'dc.title[es],dc.title[en],dc.subject[es],dc.type[es],dc.subtype[es],dc.abstract[en],other\n'
        '"línea\nuno",one,"a||b|| ||a",NA,tesis,"x ""q"", y",z\n'
        ',NaN,c,,libro,no title,z\n'
    )
    Path(folder, "export.csv").write_text(text, encoding="utf-8")
    wide = wide_csv.read_wide_csv(spark, folder)
    assert "other" not in wide.columns and len(wide.columns) == 6
    (row,) = wide_csv.convert_records(wide).collect()
    assert (row["title"], row["abstract"], row["type"]) == ("línea uno", 'x "q", y', "tesis")
    assert row["subjects"] == ["a", "b"]


def test_jsonl_keeps_text_and_skips_empty(spark, folder):
    rows = spark.createDataFrame([("ratón \u2028 \"q\"", None)], "a string, b string").coalesce(1)
    jsonl.write_jsonl(rows, f"{folder}/out")
    raw = next(Path(folder, "out").glob("part-*.json")).read_text(encoding="utf-8")
    assert "ratón" in raw and json.loads(raw)["b"] is None
    assert jsonl.read_jsonl(spark, f"{folder}/out", rows.schema).collect() == rows.collect()
    jsonl.write_jsonl(rows.filter("false"), f"{folder}/none", skip_empty=True)
    assert not Path(folder, "none").exists()


def test_rounded_metrics_let_text_pass(spark):
    rows = spark.createDataFrame([("0.123456",), ("N/A",), (None,), ("2",)], "v string")
    got = [r[0] for r in rows.select(runs.rounded_metric(F.col("v"), 4)).collect()]
    assert got == ["0.1235", "N/A", None, "2.0"]


def test_run_logs(spark, folder):
    config = {"fase": "train", "method": "lora", "lora_r": 8, "target_modules": "all", "seed": 3688191069}
    Path(folder, "m.json").write_text(
        json.dumps({"config": config, "metrics": {"train_time_hours": 1.5, "final_train_loss": "N/A",
                                                  "final_eval_loss": 0.25}}, indent=2))
    row = run_logs.read_train_metrics(spark, folder).first()
    assert row["seed"] == 3688191069 and row["final_train_loss"] is None and row["final_eval_loss"] == 0.25
    history = Path(folder, "history")
    history.mkdir()
    (history / "loss_a.json").write_text(json.dumps([{"epoch": 1.0, "loss": 2.0}, {"epoch": 1.0, "eval_loss": 3.0}]))
    entries = run_logs.read_loss_history(spark, str(history))
    merged = runs.merge_epochs(entries, ["run_file", "epoch"], ["loss", "eval_loss"]).first()
    assert (merged["loss"], merged["eval_loss"]) == (2.0, 3.0)


def test_summary_keeps_null_keys(spark, folder):
    data = [("lora", 8.0, None, 0.5), ("lora", 8.0, None, 0.7), ("fft", None, None, 0.1)]
    frame = spark.createDataFrame(data, "method string, lora_r double, galore_rank double, accuracy double")
    summary = runs.run_summary(frame, ["method", "lora_r", "galore_rank"], ["accuracy"])
    got = {r["method"]: r for r in summary.collect()}
    assert got["lora"]["accuracy_std"] == pytest.approx(0.1414213562)
    assert got["fft"]["accuracy_std"] is None and got["fft"]["lora_r"] is None
    run_logs.write_summary_csv(summary, f"{folder}/s")
    back = run_logs.read_summary_csv(spark, f"{folder}/s", summary.schema)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in summary.collect()}


def test_runs(spark):
    grid = runs.expected_runs(spark, [42])
    assert grid.count() == 34
    done = grid.filter("method <> 'fft'")
    assert [r["method"] for r in runs.missing_runs(grid, done).collect()] == ["fft"]
    keyed = {r["k"] for r in grid.withColumn("k", runs.run_key()).collect()}
    assert {"lora_r8_attn_s42", "galore_rsvd_r128_gap200_all_s42", "fft_s42"} <= keyed
    history = spark.createDataFrame([("a", 1, 2.0, None), ("a", 2, None, None)], "run string, step int, loss double, eval_loss double")
    row = runs.final_losses(history, "run", "step", ["loss", "eval_loss"]).first()
    assert (row["final_loss"], row["final_eval_loss"]) == ("2.0000", "N/A")


def test_search_and_paging(spark):
    rows = spark.createDataFrame([(i, f"2024-01-{i:02d}") for i in range(1, 31)], "id int, day string")
    search = records.faceted_search
    assert search(rows, date="day", date_from="2024-01-05", date_to="2024-01-07").count() == 3
    assert search(rows, date="day", date_from="2024-01-05").count() == 1
    assert search(rows, date="day", date_to="2024-01-05").count() == 30
    page = records.result_page(rows, [F.col("id")], page=2, per_page=10)
    assert [r["id"] for r in page.collect()] == list(range(11, 21))
    window = records.harvest_window(rows.withColumn("t", F.to_timestamp("day")), "t", end="2024-01-03")
    assert window.count() == 3
    url = rows.limit(1).select(records.search_url("u", F.lit(1), F.lit("a b"), [("type", F.lit("é"))]))
    assert rows.limit(1).select(records.search_url("u", F.lit(1), F.lit("a*~b"))).first()[0].endswith("query=a%2A~b")
    assert url.first()[0] == (
        "u?rpp=100&page=1&query=a+b&filtertype_0=type&filter_relational_operator_0=equals&filter_0=%C3%A9"
    )


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_positions_and_neighbours_of_any_key(spark, kind):
    ids = [0, 1, 2, 5, 9, 10, 11, 30, 31, 1 << 60]
    if kind == "string":
        ids = sorted(f"{i * 0x9E3779B97F4A7C15 % (1 << 64):016x}" for i in ids)
    rows = spark.createDataFrame([(i,) for i in ids], f"k {kind}").repartition(4)
    got = positions.assign_batches(rows, "k", 4).orderBy("k").collect()
    assert [(r["k"], r["position"], r["batch"]) for r in got] == [(k, at, at // 4) for at, k in enumerate(ids)]
    grouped = rows.select("k", F.lit("hot").alias("g"))
    nexts = {r["k"]: r["next"] for r in positions.next_in_group(grouped, "g", "k").collect()}
    assert nexts == dict(zip(ids, [*ids[1:], None]))


def test_occurrence_pairs(spark):
    docs = spark.createDataFrame(
        [(1, "el gato negro"), (2, "el perro negro ladra al gato negro ."), (3, "x y negro")],
        "doc_id bigint, text string",
    )
    got = {tuple(r) for r in positions.occurrence_pairs(docs, "negro").collect()}
    assert got == {
        ("same_position", 1, 2, 2, 2), ("same_position", 2, 2, 3, 2), ("same_document", 2, 2, 2, 6),
    }


def test_occurrence_pairs_query_leaves_no_pair_out(spark, folder):
    texts = [(1, "the a the the"), (2, "the"), (3, "b"), (4, "the the")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    got = sorted(tuple(r) for r in vector_queries.occurrence_pairs(spark, folder).collect())
    across = [("same_position", a, 0, b, 0) for a, b in [(1, 2), (1, 4), (2, 4)]]
    assert got == sorted(
        [*across, *[("same_document", 1, a, 1, b) for a, b in [(0, 2), (0, 3), (2, 3)]], ("same_document", 4, 0, 4, 1)]
    )


@pytest.mark.parametrize(("kind", "block"), [("bigint", 1), ("bigint", 3), ("string", 4), ("string", 1_000)])
def test_every_occurrence_pair_of_any_key(spark, monkeypatch, kind, block):
    monkeypatch.setattr(positions, "BLOCK", block)
    words = ["".join("xa"[(n * 7 + at * at) % 3 == 0] for at in range(n % 12)) for n in range(30)]
    ids = [None, *range(28), 27]  # one key is null and one comes twice
    rows = [(None if i is None else int(i) if kind == "bigint" else f"{i:03}", " ".join(w)) for i, w in zip(ids, words)]
    rows.append((rows[1][0], None))
    docs = spark.createDataFrame(rows, f"k {kind}, t string").repartition(3)
    hits = [(k, [at for at, w in enumerate((t or "").split()) if w == "a"]) for k, t in rows]
    wanted = [("same_document", k, a, k, b) for k, found in hits for a, b in itertools.combinations(found, 2)]
    for pos in range(12):
        at = sorted(k for k, found in hits if k is not None and pos in found)
        wanted += [("same_position", a, pos, b, pos) for a, b in itertools.combinations(at, 2)]
    got = [tuple(r) for r in positions.occurrence_pairs(docs, "a", "k", "t", every=True).collect()]
    assert Counter(got) == Counter(wanted) and len(wanted) > 100


def test_group_values_and_unseen(spark):
    rows = spark.createDataFrame(
        [(1, "s", 3, "b"), (1, "s", 1, "a"), (1, "s", 2, "b"), (1, "t", 0, "c")],
        "id int, name string, pos int, value string",
    )
    got = {r["name"]: r["values"] for r in records.group_values(rows, ["id", "name"]).collect()}
    assert got == {"s": ["a", "b"], "t": ["c"]}
    links = spark.createDataFrame([("a",), ("b",), ("a",)], "href string")
    assert [r[0] for r in records.unseen(links, links.filter("href = 'b'")).collect()] == ["a"]


def test_bounded_table_beyond_its_limit_is_left_alone(spark):
    rows = spark.range(50)
    assert bounded_table(rows, 49) is rows
    assert bounded_table(rows, 50).count() == 50
    assert spread(rows.coalesce(1)).rdd.getNumPartitions() >= 4


@pytest.mark.parametrize("watermark", [None, "365 days"])
def test_ingest_equals_batch(spark, folder, sf_dir, watermark):
    from folianta.plans import derived as dv

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    landing, log, checkpoint = (f"{folder}/{n}" for n in ("landing", "log", "checkpoint"))
    late = F.col("ts") >= F.lit("2024-01-20").cast("timestamp")
    for drop in (~late, late, ~late):  # the third drop repeats the first
        dv.land_records(dv.version_rows(events.filter(drop)), landing)
        ingest.ingest_available(spark, landing, log, checkpoint, watermark)
    got = {
        (r["identifier"], r["datestamp"]) for r in ingest.current_records(spark, log).collect()
    }
    batch = records.latest_records(
        events, "user_id", "ts", F.col("event_type") == "error", "event_id"
    )
    assert got == {(str(r["user_id"]), r["ts"]) for r in batch.collect()}


def test_records_by_namespace(spark, folder):
    from folianta.fixed_values import NAMESPACES as N

    oai, box, dc = N["oai"], N["oai_dc"], N["dc"]
    assert record_xml.canonical_record(
        f'<a:record><a:header status="x&amp;y"><a:identifier>1&lt;</a:identifier></a:header><a:metadata><dc xmlns="{box}">'
        f'<title xmlns="{dc}">t</title><b:title xmlns:b="{dc}">u</b:title><title>no</title></dc></a:metadata></a:record>',
        {"a": oai, "": "urn:else"},
    ) == (
        '<record><header status="x&amp;y"><identifier>1&lt;</identifier></header>'
        "<metadata><oai_dc:dc><dc:title>t</dc:title><dc:title>u</dc:title></oai_dc:dc></metadata></record>"
    )
    assert record_xml.canonical_record("<a:record/>", {"a": "urn:else"}) == ""
    assert record_xml.canonical_record(f'<a:record xmlns:a="{oai}"/>', {"a": "urn:else"}) == "<record></record>"
    assert record_xml.canonical_record("<a:record/>", {}) is None
    body = (
        f'<o:OAI xmlns:o="{oai}" xmlns:d="{dc}" xmlns:m="{box}"><o:record><o:header><o:identifier>1</o:identifier></o:header>'
        "<o:metadata><m:dc><d:title>T</d:title></m:dc></o:metadata></o:record><o:record><o:header></o:record>"
        "<record><header><identifier>2</identifier></header></record></o:OAI>"
    )
    Path(folder, "a.xml").write_text(body)
    Path(folder, "b.xml").write_text("<x><record><header><identifier>3</identifier></header></record></x>")
    good = record_xml.read_records(spark, folder, by_namespace=True).orderBy("identifier").collect()
    assert [(r["identifier"], r["dc"] and r["dc"]["title"]) for r in good] == [("1", ["T"]), ("2", None), ("3", None)]
    bad = record_xml.damaged_records(spark, folder, by_namespace=True).collect()
    assert [r["element"] for r in bad] == ["<o:record><o:header>"]
    plain = record_xml.damaged_records(spark, folder).collect()
    assert sorted(r["element"] for r in plain) == ["<o:record>", "<o:record>"]  # listed, not lost
    assert record_xml.declared_prefixes(spark, folder).count() == 3


def test_split_at_every_place(spark, monkeypatch):
    import random

    pick = random.Random(3)
    rows = [(pick.choice([None, 1, 1, 1, 2, 5]), pick.randrange(3), "same") for _ in range(90)] + [(7, 7, "copy")] * 60
    frame = spark.createDataFrame(rows, "a int, b int, c string")
    order = [F.desc_nulls_last("a"), F.col("b")]
    known = [tuple(r) for r in frame.orderBy(*order).collect()]
    for few, places in ((50_000, (0, 60, 400)), (20, (1, 89, 130, 150))):
        monkeypatch.setattr(records, "FEW_ROWS", few)
        for place in places:
            before, after = records.split_at(frame, order, place)
            assert [tuple(r) for r in before.orderBy(*order).collect()] == known[:place]
            assert [tuple(r) for r in after.orderBy(*order).collect()] == known[place:]
    assert [tuple(r) for r in records.all_results(frame, order, 3, 20, 50).collect()] == known[40:90]
    assert [tuple(r) for r in records.all_results(frame, order, 4, 20).collect()] == known[60:]
    assert [r.count() for r in records.split_at(frame.limit(0), order, 3)] == [0, 0]


def test_no_task_gets_all_rows_of_a_cut(spark, monkeypatch):
    monkeypatch.setattr(records, "FEW_ROWS", 100)
    frame = spark.range(10_000).select((F.col("id") % 2).alias("hot"), "id")
    found = records.all_results(frame, [F.col("hot")], 50, 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 5_100
    rows = records.split_at(frame, [F.col("hot")], 4_900)[0]
    sizes = rows.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert max(r["count"] for r in sizes) < 4_900 and "GlobalLimit" not in plan.split("Union")[0]


def test_state_reads_new_batches_and_touched_buckets_only(spark, folder, sf_dir):
    from folianta.plans import derived as dv

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    landing, log, checkpoint, state = (f"{folder}/{n}" for n in ("landing", "log", "checkpoint", "state"))

    def drop(rows):
        dv.land_records(dv.version_rows(rows), landing)
        ingest.ingest_available(spark, landing, log, checkpoint)

    def found(*state):
        return sorted(map(str, ingest.current_records(spark, log, *state).drop("dc", "sets").collect()))

    late = F.col("ts") >= F.lit("2024-01-20").cast("timestamp")
    drop(events.filter(~late))
    first = ingest.fold_log(spark, log, state, buckets=8)
    assert first == events.filter(~late).count()
    assert found(state) == found()
    users = [r[0] for r in events.filter(late).select("user_id").distinct().orderBy("user_id").limit(2).collect()]
    few = events.filter(late & F.col("user_id").isin(users))
    drop(few)
    assert found(state) == found()  # folded and new versions together
    second = ingest.fold_log(spark, log, state, buckets=8)
    people = events.filter(~late).select("user_id").distinct().count()
    assert few.count() <= second < few.count() + 2 / 3 * people  # two of eight buckets at most
    assert ingest.fold_log(spark, log, state, buckets=8) == 0
    assert found(state) == found()
    drop(events.filter(late))
    ingest.fold_log(spark, log, state, buckets=8)
    assert found(state) == found()
    plan = ingest.current_records(spark, log, state)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("size", ["37b", "200b", "3k"])
def test_csv_read_by_blocks_is_the_one_task_reader(spark, folder, size):
    import csv
    import random

    pick = random.Random(11)
    cells = ["", "plain", 'say ""x""', "two\nlines", "a,b", '"', "\n\n", "NA", "é ü", "x" * 90, 'q"\n"r', " pad "]
    for file in range(3):
        with open(f"{folder}/{file}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator="\r\n" if file == 1 else "\n", quoting=csv.QUOTE_MINIMAL)
            writer.writerow(["dc.title[en]", "dc.type[es]", "other"][: 3 - (file == 2)])
            for at in range(60):
                writer.writerow([f"t{file}-{at} " + pick.choice(cells), pick.choice(cells), pick.choice(cells)][: 3 - (file == 2)])
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    known = sorted(map(str, wide_csv.read_wide_csv(spark, folder).collect()))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = wide_csv.read_wide_csv(spark, folder)
        assert sorted(map(str, rows.collect())) == known and len(known) == 180
        blocks = spark.read.text(folder).select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
        assert blocks > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_conversion_counters_of_a_stream(spark, folder):
    wide = [("A", None), ("", "x"), (None, "y"), ("B", "z")]
    rows = spark.createDataFrame(wide, "`dc.title[en]` string, `dc.type[en]` string")
    counters = wide_csv.ConversionCounters()
    spark.streams.addListener(counters)
    try:
        for at in range(2):
            rows.write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
            done = wide_csv.convert_records(stream, observation="conversion").writeStream.format("noop")
            done.option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start().awaitTermination()
        import time

        for _ in range(100):
            if counters.totals.get("conversion", {}).get("read") == 8:
                break
            time.sleep(0.1)
        assert counters.totals == {"conversion": {"read": 8, "valid": 4}}
    finally:
        spark.streams.removeListener(counters)


def test_references_are_resolved_like_urljoin(spark):
    from urllib.parse import urljoin

    bases = ["http://h.x/a/b/c.html?q=/r/#f", "https://h.x", "http://h.x/a/", "http://h.x/a/b/../c/"]
    hrefs = [
        "g", "./g", "g/", "/g", "//o.x/g", "?y", "g?y/../z", "#s", "g#s/../t", "..", "../", "../g", "../..", "../../g",
        "../../../../g", ".", "./", "/./g", "/../g", "g.", ".g", "..g", "./../g", "./g/.", "g/./h", "g/../h",
    ]
    rows = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "base string, href string")
    found = rows.select("*", html.absolute(F.col("href"), F.col("base")).alias("url")).collect()
    for row in found:
        plain = {"https://h.x": "https://h.x/", "http://h.x/a/b/../c/": "http://h.x/a/c/"}
        expected = urljoin(plain.get(row["base"], row["base"]), row["href"])
        assert row["url"].removesuffix("/") == expected.removesuffix("/"), row


def test_markup_is_found_like_a_parser(spark):
    import random
    from html.parser import HTMLParser

    class Links(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            if tag == "a" and dict(attrs).get("href"):
                self.found.append(dict(attrs)["href"])

    parts = [
        '<a href="/handle/{}">x</a>', "<A class=b HREF='/handle/{}'>", "<!-- <a href='/handle/{}'> -->", "text {} < 3",
        "<script type='x>y'>w('<a href=/handle/{}>')</script>", "<STYLE>a {{ }} <a href='/handle/{}'></STYLE >",
        "<script>// <!-- <a href='/handle/{}'></script>", "<!-- <script> --><a href='/handle/{}'>", "<a-b href='/handle/{}'>",
        "<p title='<a href=/handle/{}>'>", "<script></script><a href=/handle/{}>", "<abbr href='/handle/{}'>",
    ]
    pick = random.Random(2)
    pages = ["".join(pick.choice(parts).format(f"{i}-{j}") for j in range(8)) for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    mine = {}
    for row in html.page_links(frame, "id", deny=[]).collect():
        mine.setdefault(row["id"], []).append(row["href"])
    for i, page in enumerate(pages):
        parser = Links()
        parser.feed(page)
        parser.close()
        assert sorted(mine.get(i, [])) == sorted(set(parser.found)), page
