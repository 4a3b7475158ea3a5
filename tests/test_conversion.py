from conftest import values
from pyspark.sql import functions as F

from fleetgauge.functions.conversion import (
    epoch_to_time,
    moment,
    to_day,
    to_double,
    to_time,
    to_whole_number,
)


def converted(frame, texts, convert):
    df = frame("t STRING", [(t,) for t in texts])
    return [r[0] for r in df.select(convert(F.col("t"))).collect()]


def test_bad_text_is_null_not_an_error(frame):
    bad = ["n/a", "", None, "12x"]
    for convert in (to_double, to_whole_number, to_time, to_day):
        assert converted(frame, bad, convert) == [None] * 4


def test_whole_number_drops_decimals(frame):
    assert converted(frame, ["2015", "2015.0", " 7 ", "1.9", "1.x"], to_whole_number) == [
        2015, 2015, 7, 1, None]
    assert converted(frame, ["99999999999"], lambda c: to_whole_number(c, "int")) == [None]


def test_day_of_a_text_with_a_bad_time(frame):
    assert [str(d) for d in converted(frame, ["2024-01-02 xx", "2024-01-02T10:00:00"], to_day)] == [
        "2024-01-02", "2024-01-02"]
    assert converted(frame, ["2024-01-02 xx"], to_time) == [None]


def test_epoch_out_of_range_is_null(frame):
    df = frame("s BIGINT", [(0,), (1704067200,), (1704067200000000,), (-10**17,), (None,)])
    got = values(df.select(epoch_to_time(F.col("s")).cast("string").alias("t")))
    assert got == [(None,), (None,), (None,), ("1970-01-01 00:00:00",), ("2024-01-01 00:00:00",)]


def test_moment(spark):
    one = spark.range(1)
    assert str(one.select(moment("2024-01-02 03:00:00")).first()[0]) == "2024-01-02 03:00:00"
    assert one.select(moment(None)).first()[0] is not None
