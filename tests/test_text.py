import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from folianta import fixed_values as fixed
from folianta.functions import prompts
from folianta.functions import text as tx

TEXTS = [
    "Una CASA amarilla mira el camión nuevo. ΟΔΟΣ", "", "  a\t\n b  c  ", "école \x07bell",
    "ÅNGSTRÖM ﬁ ² ½ _x-y!!", "日本語 テスト", "a\x1fb", "ẛ̣ İstanbul", "x\x85y", None,
]
QUIET = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def apply(spark, step, texts, kind="string"):
    rows = spark.createDataFrame(list(enumerate(texts)), f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", step(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_text_collapses_unicode_spaces(spark):
    expected = ["" if t is None else " ".join(t.split()) for t in TEXTS]
    assert apply(spark, tx.clean_text, TEXTS) == expected


def test_whitespace_class_is_pythons(spark):
    points = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    got = apply(spark, lambda c: F.regexp_like(c, F.lit(f"^[{fixed.WHITESPACE}]$")), points)
    assert [p for p, hit in zip(points, got) if hit] == [p for p in points if p.isspace()]


@pytest.mark.parametrize("step, form", [(tx.compose, "NFC"), (tx.decompose, "NFD")])
def test_normal_forms(spark, step, form):
    expected = [t if t is None else unicodedata.normalize(form, t) for t in TEXTS]
    assert apply(spark, step, TEXTS) == expected


def test_normalize_nfc_matches_library(spark):
    library = normalizers.Sequence(
        [
            normalizers.NFC(),
            normalizers.Replace(Regex(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"), ""),
            normalizers.Replace(Regex(r"\s+"), " "),
            normalizers.Strip(),
        ]
    )
    expected = [t if t is None else library.normalize_str(t) for t in TEXTS]
    assert apply(spark, tx.normalize_nfc, TEXTS) == expected


def test_fold_text_matches_library(spark):
    library = normalizers.Sequence(
        [normalizers.NFD(), normalizers.Lowercase(), normalizers.StripAccents()]
    )
    expected = [t if t is None else library.normalize_str(t) for t in TEXTS]
    assert apply(spark, tx.fold_text, TEXTS) == expected


def test_pre_tokenize_matches_library(spark):
    known = unicodedata.ucd_3_2_0.category  # newer letters depend on the JVM's Unicode version
    every = "".join(f" a{chr(c)}b" for c in range(0x21, 0x3100) if known(chr(c)) != "Cn")
    texts = [*filter(None, TEXTS), every, "\U0001f130x \U0001f600y"]
    library = pre_tokenizers.Whitespace()
    expected = [[token for token, _ in library.pre_tokenize_str(t)] for t in texts]
    assert apply(spark, tx.pre_tokenize, texts) == expected


@QUIET
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_steps_are_idempotent(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for step in (tx.clean_text, tx.normalize_nfc):
        once = apply(spark, step, texts)
        assert apply(spark, step, once) == once


@pytest.mark.parametrize(
    "said, expected",
    [
        ("Artículo", "articulo"), ("  TESIS doctoral", "tesis"), ("nosotros", "otro"),
        ("libro sobre una tesis", "tesis"), ("objeto de aprendizaje u objeto de conferencia",
                                             "objeto de conferencia"),
        ("", "sin_clasificar"), ("revista", "sin_clasificar"),
    ],
)
def test_extract_category(spark, said, expected):
    assert apply(spark, tx.extract_category, [said]) == [expected]


def test_split_list_and_merge(spark):
    cells = ["a||b|| ||a", None, "", " x \n y ||z", "a|b"]
    assert apply(spark, tx.split_list, cells) == [["a", "b", "a"], [], [], ["x y", "z"], ["a|b"]]
    row = spark.createDataFrame([(["b", "a"], ["a", "c"])], "p array<string>, q array<string>")
    assert row.select(tx.merge_lists(F.col("p"), F.col("q")).alias("m")).first()["m"] == ["b", "a", "c"]


def test_best_by_language(spark):
    names = ["t[en]", "t[es]", "t[]"]
    rows = spark.createDataFrame(
        [("e", " s ", "n"), ("e", " ", "n"), (None, None, "n"), (None, "", None)],
        ", ".join(f"`{n}` string" for n in names),
    )
    got = [r[0] for r in rows.select(tx.best_by_language(names)).collect()]
    assert got == ["s", "e", "n", ""]


def test_first_line_and_control_tokens(spark):
    assert apply(spark, tx.first_line, ["\n a b \n c", "x", ""]) == ["a b", "x", ""]
    assert apply(spark, tx.strip_control_tokens, ["Tesis<|eot_id|>"]) == ["Tesis"]


def test_scalar_or_list(spark):
    lists = [[], ["a\"b"], ["a", "é"]]
    assert apply(spark, tx.scalar_or_list, lists, "array<string>") == ['""', '"a\\"b"', '["a","é"]']


def test_any_matches_ignores_case_before_normalization(spark):
    lists = [["INFORMÁTICA"], ["Informática"], ["x", "Computer Science"], []]
    step = lambda c: tx.any_matches(c, fixed.SUBJECT_REGEX)
    assert apply(spark, step, lists, "array<string>") == [True, False, True, False]


def test_labels(spark):
    assert apply(spark, lambda c: tx.default_label(c, "D"), [None, "", "x"]) == ["D", "D", "x"]
    got = apply(spark, lambda c: tx.collapse_classes(c, ["Audio"], "Otro"), ["Audio", "audio"])
    assert got == ["Otro", "audio"]


def test_render_prompt(spark):
    row = spark.createDataFrame([("T", None, "Tesis")], "t string, a string, l string")
    plain, full = row.select(
        prompts.render_prompt(F.col("t"), F.col("a")),
        prompts.render_prompt(F.col("t"), F.col("a"), F.col("l")),
    ).first()
    assert plain.startswith("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n")
    assert "<titulo>T</titulo>\n<resumen></resumen><|eot_id|>" in plain
    assert full == plain + "Tesis<|eot_id|>"


def test_chat_segments_cover_all_turns(spark):
    turns = spark.createDataFrame(
        [(1, t, "user", f"m{t}") for t in range(25)], "conv_id int, turn int, role string, text string"
    )
    rows = prompts.render_chat(turns, segment_turns=10).orderBy("segment").collect()
    assert [r["n_turns"] for r in rows] == [10, 10, 5]
    whole = "".join(r["chat"] for r in rows)
    assert [whole.index(f"m{t}<") for t in range(25)] == sorted(whole.index(f"m{t}<") for t in range(25))


def test_truncate_pad(spark):
    rows = spark.createDataFrame(
        [(0, 0, list("abcde")), (1, 0, ["x"]), (2, 1, [])], "id int, batch int, tokens array<string>"
    )
    left = {r["id"]: r for r in prompts.truncate_pad(rows, "tokens", "batch", limit=3).collect()}
    assert left[0]["tokens"] == list("cde") and left[0]["attention_mask"] == [1, 1, 1]
    assert left[1]["tokens"] == ["[PAD]", "[PAD]", "x"] and left[1]["attention_mask"] == [0, 0, 1]
    assert left[2]["tokens"] == [] and left[2]["attention_mask"] == []
    right = prompts.truncate_pad(rows, "tokens", "batch", 3, "right", "right").collect()
    assert {r["id"]: r["tokens"] for r in right}[1] == ["x", "[PAD]", "[PAD]"]
