from datetime import datetime

import pytest
from pyspark.sql import functions as F

from listinglake.functions import times

NOON = datetime(2026, 9, 21, 12, 55, 11)

VECTORS = [
    ("2026-09-21T12:55:11", NOON),
    ("2026-09-21 12:55:11", NOON),
    ("2026-09-21", datetime(2026, 9, 21)),
    ("2026-09-21T12:55:11Z", NOON),
    ("2026-09-21T12:55:11.123Z", NOON),
    ("2026-09-21T12:55:11+02:00", NOON),
    ("2026-09-21T12:55:11.5-0330", NOON),
    ("2026-09-21Z", datetime(2026, 9, 21)),
    ("2026-09-21T12:55:11 +0200", datetime(2026, 9, 21, 10, 55, 11)),
    ("2026-09-21T12:55:11.123", datetime(2026, 9, 21, 12, 55, 11, 123000)),
    ("2026-09-21T12:55", datetime(2026, 9, 21, 12, 55)),
    ("2026-09-21T12:55+02:00", None),
    ("2026", datetime(2026, 1, 1)),
    ("1780000000", None),
    ("20260921", None),
    ("garbage", None),
    ("", None),
    ("2026-13-01", None),
    ("2026-02-30T00:00:00Z", None),
    ("Mon, 21 Sep 2026 12:55:11 GMT", None),
    (None, None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = spark.createDataFrame([(v,) for v, _ in VECTORS], "v string")
    drop = times.parse_publication(F.col("v")).alias("drop")
    convert = times.parse_publication(F.col("v"), "convert").alias("convert")
    as_text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS") for c in (drop, convert)]
    return {r[0]: (r[1], r[2]) for r in rows.select("v", *as_text).collect()}


def shown(moment):
    return moment and moment.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]


@pytest.mark.parametrize("given, wanted", VECTORS)
def test_wall_clock_is_kept(parsed, given, wanted):
    assert parsed[given][0] == shown(wanted)


def test_offsets_apply_on_request(parsed):
    assert parsed["2026-09-21T12:55:11+02:00"][1] == "2026-09-21 10:55:11.000"
    assert parsed["2026-09-21T12:55:11"][1] == shown(NOON)
    with pytest.raises(ValueError):
        times.parse_publication(F.lit("x"), "keep")


def test_publication_timestamp_takes_any_column_type(spark):
    dates = spark.sql("SELECT DATE'2026-01-02' AS publication_date")
    found = dates.select(F.date_format(times.publication_timestamp(dates), "HH:mm")).first()
    assert found[0] == "00:00"
    none = spark.range(1)
    assert none.select(times.publication_timestamp(none).alias("t")).first().t is None


def test_epochs(frame):
    given = ["1780000000", "1780000000000", "10000000000", " 2026-01-02 ", "", None, "1e400"]
    data = frame([(v,) for v in given], "v string")
    found = data.select(
        times.publication_text(F.col("v")), times.publication_text(F.col("v"), False)
    ).collect()
    assert [r[0] for r in found] == [
        "2026-05-28T20:26:40",
        "2026-05-28T20:26:40",
        "2286-11-20T17:46:40",
        "2026-01-02",
        "",
        "",
        "",
    ]
    assert [r[1] for r in found][:2] == ["1780000000", "1780000000000"]


def test_capture_stamp_is_utc(spark):
    moment = F.lit(datetime(2026, 9, 21, 12, 55, 11)).cast("timestamp_ntz")
    assert spark.range(1).select(times.capture_stamp(moment)).first()[0] == "20260921_125511"
