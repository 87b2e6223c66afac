from __future__ import annotations

import hashlib
from datetime import date, datetime

import pytest

from pyspark.sql import functions as F

from loadledger import functions as fn
from series import CONTRACT

HEX = hashlib.sha256(b"x").hexdigest()
FOLDER = "abc://zone/respondent=US48/year=2026/month=09/day=26/"


def evaluate(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", column.alias("out")).orderBy("i").collect()]


def test_safe_numeric(spark):
    texts = ["539672", "-1.5", "abc", "", None, " 7 "]
    assert evaluate(spark, texts, fn.safe_numeric("v")) == [539672.0, -1.5, None, None, None, 7.0]


def test_parse_period(spark):
    texts = ["2026-09-26T00", "2026-09-26T23", "2026-09-26T24", "2026-09-26 00", "x", None]
    expected = [datetime(2026, 9, 26), datetime(2026, 9, 26, 23), None, None, None, None]
    assert evaluate(spark, texts, fn.parse_period("v")) == expected
    assert evaluate(spark, texts[:2], fn.period_date("v")) == [date(2026, 9, 26)] * 2


def test_normalize(spark):
    texts = ["2026-09-26T05", "2026-09-26 05:00:00", "2026-09-26T05:00:00Z"]
    assert evaluate(spark, texts, fn.normalize_hour("v")) == ["2026-09-26 05"] * 3
    assert evaluate(spark, texts, fn.normalize_date("v")) == ["2026-09-26"] * 3


@pytest.mark.parametrize(
    ("a", "b", "close"),
    [(1.0, 1.009, True), (1.0, 1.02, False), (1e12, 1e12 + 900, True), (1e12, 1e12 + 1100, False),
     (0.0, 0.0, True), (-5.0, 5.0, False), (float("inf"), float("inf"), True)],
)
def test_is_close(spark, a, b, close):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(fn.is_close("a", "b").alias("out")).first()["out"] is close


def test_is_newer(spark):
    def newer(source, target):
        df = spark.createDataFrame([(source, target)], "s struct<m:int,p:string>, t struct<m:int,p:string>")
        return df.select(fn.is_newer("s", "t", ("m", "p")).alias("out")).first()["out"]

    assert newer((2, "a"), (1, "z"))
    assert newer((1, "b"), (1, "a"))
    assert not newer((1, "a"), (1, "a"))
    assert not newer((1, "z"), (2, "a"))
    assert not newer((None, "z"), (1, "a"))
    assert not newer((1, "z"), (None, "a"))


def test_first_present(spark):
    df = spark.createDataFrame([(1, "", "7", "x"), (2, "3", None, "y")], "i int, a string, b string, c string")
    out = df.select("i", fn.first_present(df, ["none", "a", "b"], numeric=True).alias("out"))
    assert {r["i"]: r["out"] for r in out.collect()} == {1: 7.0, 2: 3.0}
    with pytest.raises(KeyError):
        fn.first_present(df, ["none"])
    empty = spark.createDataFrame([("", None)], "a string, b string")
    lenient = fn.first_present(empty, ["a", "b"], strict=False)
    assert empty.select(lenient.alias("out")).first()["out"] is None
    with pytest.raises(Exception, match="no value in any of"):
        empty.select(fn.first_present(empty, ["a", "b"])).collect()


@pytest.mark.parametrize(
    ("name", "accepted"),
    [
        ("eia_us48_2026-09-26.json", True),
        (f"revisions/eia_us48_2026-09-26_revision_{HEX}.json", True),
        (f"revisions/eia_us48_2026-09-26_sha256_{HEX}.json", True),
        (f"revisions/eia_us48_2026-09-26_revision_{HEX[1:]}.json", False),
        (f"revisions/eia_us48_2026-09-26_revision_{HEX.upper()}.json", False),
        ("eia_us48_2026-09-26T00_to_2026-09-26T23.json", False),
        ("eia_us48_2026-09-26.json.tmp", False),
        ("other/eia_us48_2026-09-26.json", False),
        ("version=canonical/part-00000-a.c000.txt", True),
        (f"version=revision_{HEX}/part-00000-a.c000.txt", True),
        (f"version=revision_{HEX}_at_20261001T080000/part-00000-a.c000.txt", True),
        ("version=other/part-00000-a.c000.txt", False),
    ],
)
def test_landing_names(spark, name, accepted):
    assert evaluate(spark, [FOLDER + name], fn.is_landing_path("v", CONTRACT)) == [accepted]


def test_landing_name_outside_a_day_folder(spark):
    paths = ["abc://zone/eia_us48_2026-09-26.json"]
    assert evaluate(spark, paths, fn.is_landing_path("v", CONTRACT)) == [False]


def test_names_and_their_parts(spark):
    days = [date(2026, 9, 26)]
    name = fn.canonical_name("v", CONTRACT)
    assert evaluate(spark, days, name, "date") == ["eia_us48_2026-09-26.json"]
    revised = fn.revision_name(name, F.lit(HEX))
    assert evaluate(spark, days, revised, "date") == [f"eia_us48_2026-09-26_revision_{HEX}.json"]
    folder = fn.landing_folder(F.lit("US48"), "v")
    assert evaluate(spark, days, folder, "date") == ["respondent=US48/year=2026/month=09/day=26"]
    paths = [FOLDER + "eia_us48_2026-09-26.json", FOLDER + f"revisions/a_sha256_{HEX}.json",
             FOLDER + f"version=revision_{HEX}_at_20261001T080000/part-0.txt"]
    assert evaluate(spark, paths, fn.path_respondent("v")) == ["US48"] * 3
    assert evaluate(spark, paths, fn.path_date("v")) == days * 3
    assert evaluate(spark, paths, fn.path_revision_id("v")) == [None, HEX, HEX]
    assert evaluate(spark, paths, fn.path_version("v")) == [
        "canonical", f"revision_{HEX}", f"revision_{HEX}_at_20261001T080000"]
    assert evaluate(spark, paths, fn.source_of("v"))[2] == paths[2].rsplit("/", 1)[0]


def test_content_fingerprint(spark):
    found = evaluate(spark, [bytearray(b"abc")], fn.content_fingerprint("v"), "binary")
    assert found == [hashlib.sha256(b"abc").hexdigest()]
