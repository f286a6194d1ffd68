"""Micro-cases for the composed column expressions (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from clickmart.functions.text import clean_event_type, initcap_words, page_title, parent_page_title
from clickmart.functions.timefn import file_hour, whole_second_diff
from clickmart.functions.variant import json_int, json_string, property_path


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col(schema.split()[0])).alias("r")).first()["r"]


def test_initcap_after_punctuation(spark):
    assert _one(spark, initcap_words, "sign-up_now x") == "Sign-Up_Now X"
    assert _one(spark, initcap_words, "[Amplitude]page_viewed été-x") == "[Amplitude]Page_Viewed Été-X"
    assert _one(spark, initcap_words, "ELEMENT   clicked ") == "Element   Clicked "
    assert _one(spark, initcap_words, "") == ""
    assert _one(spark, initcap_words, None) is None


def test_clean_event_type_rules(spark):
    assert _one(spark, clean_event_type, "[Amplitude] Page Viewed") == "Page Viewed"
    # tag without a blank: nothing removed, underscores kept, capitals after punctuation
    assert _one(spark, clean_event_type, "[Amplitude]page_viewed") == "[Amplitude]Page_Viewed"
    assert _one(spark, clean_event_type, "sign_up") == "Sign Up"
    assert _one(spark, clean_event_type, "sign-up_now") == "Sign-Up Now"
    assert _one(spark, clean_event_type, "purchase") == "Purchase"
    # the tag is removed anywhere in the text, and such names keep underscores
    assert _one(spark, clean_event_type, "x [Amplitude] a_b") == "X A_B"
    assert _one(spark, clean_event_type, None) is None


def test_page_titles(spark):
    cases = {
        "https://ex.com": ("ex.com", None),
        "https://ex.com/blog/post/": ("post", "blog"),
        "https://ex.com/a?next=/x/y": ("y", "x"),
        "https://ex.com/a//": (None, None),
        "noslash": (None, None),
        "": (None, None),
    }
    for url, (title, parent) in cases.items():
        assert _one(spark, page_title, url) == title, url
        assert _one(spark, parent_page_title, url) == parent, url


def test_file_hour(spark):
    import datetime as dt

    assert _one(spark, file_hour, "data/2026-05-14_2#1.json") == dt.datetime(2026, 5, 14, 2)
    assert _one(spark, file_hour, "s3://b/x/0_2026-05-14_23#0.json") == dt.datetime(2026, 5, 14, 23)
    assert _one(spark, file_hour, "data/nohour.json") is None
    # the first match in the whole path wins (a dated folder beats the file)
    assert _one(spark, file_hour, "2026-01-02_3/0_2026-05-14_2.json") == dt.datetime(2026, 1, 2, 3)


def test_whole_second_diff(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.9", "2024-01-01 00:00:02.1"),
                                ("2024-01-01 00:00:02.1", "2024-01-01 00:00:00.9"),
                                ("1969-12-31 23:59:59.5", "1970-01-01 00:00:00.5"),
                                ("2024-01-01 00:00:00", None)], "a string, b string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    got = [r["d"] for r in df.select(whole_second_diff(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [2, -2, 1, None]


def test_json_extraction(spark):
    df = spark.createDataFrame(
        [('{"a": 1715000000123, "event_properties": {"[Amplitude] Page Counter": 2.6}}',),
         ('{"a": null, "event_properties": {"[Amplitude] Page Counter": 2.4}}',),
         ('{"event_properties": {"[Amplitude] Page Counter": -2.5}}',)], "j string")
    v = F.parse_json("j")
    rows = df.select(json_string(v, "$.a").alias("a"),
                     json_int(v, property_path("[Amplitude] Page Counter")).alias("pc"),
                     json_string(v, "$.missing").alias("m")).collect()
    assert [r["a"] for r in rows] == ["1715000000123", None, None]
    assert [r["pc"] for r in rows] == [3, 2, -3]
    assert all(r["m"] is None for r in rows)


def _title_words(s):
    """Plain-Python statement of the rule: a letter is upper-cased when it
    starts the text or follows white space or a delimiter, else lower-cased."""
    from clickmart.schemas import INITCAP_DELIMITERS

    out, start = [], True
    for ch in s:
        out.append(ch.upper() if start else ch.lower())
        start = ch.isspace() or ch in INITCAP_DELIMITERS
    return "".join(out)


def test_initcap_words_against_plain_rule(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("abcXYZ éÉ019 \t_-.[]()/|#&~^@!?<>{}%*+,:;'\"\\"))
    samples = []

    @settings(max_examples=300, suppress_health_check=list(HealthCheck), derandomize=True)
    @given(st.text(alphabet=alphabet, max_size=24))
    def collect(s):
        samples.append(s)

    collect()
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r["r"] for r in df.select(initcap_words(F.col("s")).alias("r")).collect()]
    assert got == [_title_words(s) for s in samples]
