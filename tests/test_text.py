import datetime
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.functions.times import micros, seconds
from corpusflow.operators import text_samples


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def texts(df, **kw):
    return [r["text"] for r in text_samples.with_text(df, **kw).collect()]


def test_messages_list_wins_and_does_not_fall_through(spark):
    schema = "messages array<struct<role:string,content:string>>, text string"
    rows = [
        ([("user", "a"), ("assistant", None), ("user", "b")], "t"),
        ([("user", None)], "t"),
        ([], "t"),
        (None, "t"),
    ]
    assert texts(spark.createDataFrame(rows, schema)) == ["a\n\nb", "", "", "t"]


def test_messages_string_and_maps(spark):
    assert texts(spark.createDataFrame([("hello", "t"), (None, "t")], "messages string, text string")) == ["hello", "t"]
    rows = [([{"content": "x"}, {"role": "user"}],)]
    assert texts(spark.createDataFrame(rows, "messages array<map<string,string>>")) == ["x"]


def test_messages_without_content_field_are_empty(spark):
    rows = [([("user",)], "t"), (None, "t")]
    assert texts(spark.createDataFrame(rows, "messages array<struct<role:string>>, text string")) == ["", "t"]


def test_conversation_list_and_conversation_string(spark):
    rows = [([("a",), ("b",)], "t"), (None, "t")]
    assert texts(spark.createDataFrame(rows, "conversation array<struct<content:string>>, text string")) == ["a\n\nb", "t"]
    assert texts(spark.createDataFrame([("ignored", "p")], "conversation string, prompt string")) == ["p"]


def test_first_existing_field_even_when_null(spark):
    rows = [(None, "instruction"), ("c", "instruction")]
    assert texts(spark.createDataFrame(rows, "content string, instruction string")) == [None, "c"]
    assert texts(spark.createDataFrame([(True,)], "question boolean")) == ["True"]


def test_fallback_takes_strings_longer_than_ten(spark):
    rows = [("ten chars.", "eleven char", 12345678901234, "another long one"), ("short", "no", 1, None)]
    df = spark.createDataFrame(rows, "a string, b string, c long, d string")
    assert texts(df) == ["eleven char\n\nanother long one", ""]


def test_partition_columns_are_no_sample_text(spark):
    df = spark.createDataFrame([("a long dataset name", "a long split name", 1)], "dataset string, split string, n int")
    assert texts(df) == [""]


@pytest.mark.parametrize(
    ("text", "kept"),
    [(None, False), ("", False), (" \t\n", False), (" 　 ", False), ("\x1c\x1f", False), ("​", True), (" x ", True)],
)
def test_blank(spark, text, kept):
    assert value(spark, T.has_text(F.lit(text).cast("string"))) is kept


def test_cutting(spark):
    assert value(spark, T.cut(F.lit("é" * 6), 5)) == "é" * 5 + "..."
    assert value(spark, T.cut(F.lit("abcde"), 5)) == "abcde"
    assert value(spark, T.keep_tail(F.lit("x" * 10 + "y" * 37))) == "..." + "y" * 37
    assert value(spark, T.keep_tail(F.lit("x" * 40))) == "x" * 40
    assert value(spark, T.one_line(F.lit("a\nb\n"))) == "a b "


def test_numbers_for_display(spark):
    assert value(spark, T.size_label(F.lit(1023.999))) == "1024.00 MB"
    assert value(spark, T.size_label(F.lit(1536.0))) == "1.50 GB"
    assert value(spark, T.megabytes(F.lit(3 * 1024 * 1024))) == 3.0
    assert value(spark, T.percent(F.lit(1), F.lit(0))) == 0.0
    assert value(spark, T.percent(F.lit(1), F.lit(4))) == 25.0


def test_data_uri_has_no_line_breaks(spark):
    uri = value(spark, T.data_uri(F.lit(bytes(range(200)))))
    assert uri.startswith("data:image/png;base64,") and not set("\r\n") & set(uri)


def test_decoding_drops_invalid_bytes(spark):
    df = spark.createDataFrame([(b"a\xffb\xc3\xa9", "s"), (None, "s")], "body binary, plain string")
    rows = df.select(T.decoded(df, "body").alias("b"), T.decoded(df, "plain").alias("p")).collect()
    assert [tuple(r) for r in rows] == [("abé", "s"), (None, "s")]


def test_turns_in_order_across_parts(spark):
    turns = [(1, t, f"t{t}") for t in range(10)] + [(2, 0, None), (2, 1, "only"), (3, 0, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, text string").repartition(7)
    found = {r["conv_id"]: r["text"] for r in text_samples.text_of_turns(df, turns_per_part=3).collect()}
    assert found == {1: "\n\n".join(f"t{t}" for t in range(10)), 2: "only", 3: ""}


def test_micros_do_not_depend_on_the_zone_of_the_session(spark):
    text = "2024-03-10 02:30:00.250001"  # this hour is missing in New York
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(f"SELECT TIMESTAMP_NTZ'{text}' AS a, TIMESTAMP'{text}Z' AS b")
        row = df.select(micros(df, "a").alias("a"), micros(df, "b").alias("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    expected = datetime.datetime(2024, 3, 10, 2, 30, 0, 250001, datetime.timezone.utc)
    at = int(expected.timestamp()) * 1_000_000 + 250001
    assert (row["a"], row["b"]) == (at, at)
    assert value(spark, seconds(F.lit(at), F.lit(at + 1_500_000))) == 1.5


def test_invalid_bytes_are_left_out_without_python(spark):
    rng = random.Random(1)
    odd = [bytes(rng.choice(b"aZ\x00\x80\x9f\xa0\xbf\xc1\xc3\xe0\xe2\xed\xef\xf0\xf4\xf5\xff") for _ in range(12)) for _ in range(3000)]
    odd += ["é日😀\ufffd$1\\".encode()[:n] for n in range(16)] + [b"\xff" + b"x" * 200_000 + b"\xc3", b"\xff" + "é".encode() * 50_000]
    rows = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(odd)], "i int, body binary")
    found = rows.select("i", T.decoded(rows, "body").alias("text"))
    assert "Python" not in found._jdf.queryExecution().toString()
    assert {r["i"]: r["text"] for r in found.collect()} == {i: b.decode(errors="ignore") for i, b in enumerate(odd)}
