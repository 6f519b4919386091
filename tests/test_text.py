from pyspark.sql import functions as F

from sheafworks.functions import patterns as P
from sheafworks.functions import text as T

ODD = [
    "", " ", "a", " a b ", "a\tb\nc", "　x y\x85", "\x1cq\x1dr", "one  two   three\n",
    "a\r\nb\rc", "a\n\nb", "é ü z", "a\x0bb\x0c", "tail\r\n", "x y",
]


def test_whitespace_set_is_pythons():
    assert set(P.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_words_and_lines_match_python(value):
    assert value(T.strip, ODD) == [s.strip() for s in ODD]
    assert value(T.rstrip, ODD) == [s.rstrip() for s in ODD]
    assert value(T.word_count, ODD) == [len(s.split()) for s in ODD]
    assert value(T.line_count, ODD) == [len(s.splitlines()) for s in ODD]
    assert value(T.byte_count, ODD) == [len(s.encode()) for s in ODD]


def test_markup(value):
    inputs = ["<b>x</b> y", "a ![alt](u) b", "[label](http://t) z", "<p\nclass=q>w", "a < b and c > d", "[x](y"]
    assert value(T.strip_markup, inputs) == ["x y", "a  b", "label z", "w", "a  d", "[x](y"]


def test_dropped_lines(value):
    kept = ["plain text", "", "a badge of honour", "shields"]
    dropped = [
        "─────", "-----", "│ ─ │ ─ │", "= * _ -".replace(" ", ""), "^ Back To TOP ^", "x img.shields.io y",
        "see BADGE at http://x", "  ---  ",
    ]
    assert value(T.is_dropped_line, kept) == [False] * len(kept)
    assert value(T.is_dropped_line, dropped) == [True] * len(dropped)


def test_box_runs_count_runs_not_characters(value):
    assert value(T.box_runs, ["────", "─ ─", "ab", "│a│─"]) == [1, 2, 0, 2]


def test_noise_reasons(spark):
    long = "word " * 30
    rows = [
        (0, "short", "too_short"),
        (1, "│a" * 40, "box_heavy"),
        (2, "| " + long + " |", "table_row"),
        (3, "-" * 60 + "abc", "separator_only"),
        (4, "https://example.com/" + "p" * 80 + " tail", "mostly_urls"),
        (5, long, None),
        (6, "| " + long + " |\nnext line", None),
    ]
    df = spark.createDataFrame(rows, "i int, x string, reason string")
    flags = T.noise_reasons(F.col("x"))
    found = df.select("i", "reason", *(c.alias(n) for n, c in flags.items()), T.is_noise(F.col("x")).alias("noise"))
    for row in found.collect():
        assert row["noise"] == (row["reason"] is not None), row
        if row["reason"]:
            assert row[row["reason"]], row


def test_noise_limits_are_parameters(value):
    text = ["just twenty-five letters !"]
    assert value(lambda c: T.is_noise(c), text) == [True]
    assert value(lambda c: T.is_noise(c, min_size=10), text) == [False]


def test_names(value):
    paths = ["raw/my-repo_README_20250101_101500.md", "x/other.md", "README.md", "a_README_b_README_c.md"]
    assert value(T.repo_name, paths) == ["my-repo", "other", "README", "a"]
    assert value(T.repo_name_with_time, paths) == ["my-repo_20250101_101500", "other", "README", "a_b_c"]
    assert value(T.base_name, paths)[0] == "my-repo_README_20250101_101500.md"


def test_file_name_and_payload(spark, value):
    row = spark.sql("select timestamp_ntz'2025-03-04 05:06:07.123' t").select(T.readme_file_name(F.lit("r"), F.col("t")))
    assert row.first()[0] == "r_README_20250304_050607.md"
    assert value(T.decode_base64, ["aMOp", "%%%", ""]) == ["hé", None, ""]


def test_ids_are_stable_and_uuid_shaped(value):
    ids = value(lambda c: T.hash_uuid(c, F.lit(1)), ["a", "b", "a"])
    assert ids[0] == ids[2] != ids[1]
    assert [len(p) for p in ids[0].split("-")] == [8, 4, 4, 4, 12]
