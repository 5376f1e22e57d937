import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.functions import paths, text as tx
from eventloom.functions.numbers import kb_to_mb, whole
from eventloom.functions.times import elapsed_clock, iso_text, minute_boundaries, utc_now
from eventloom.functions.typed import BIGINT, DATETIME, INT, failed, typed


def one(spark, col, **inputs):
    schema = ", ".join(f"{k} {t}" for k, (_, t) in inputs.items()) or "x int"
    row = tuple(v for v, _ in inputs.values()) or (1,)
    return spark.createDataFrame([row], schema).select(col.alias("r")).first().r


@pytest.mark.parametrize(
    "text,kind,expected",
    [
        ("42", INT, 42),
        (" 42 ", INT, 42),
        ("-7", BIGINT, -7),
        ("", INT, 0),
        ("  ", BIGINT, 0),
        (None, INT, None),
        ("abc", INT, None),
        ("12.5", BIGINT, None),
        ("99999999999", INT, None),
        ("99999999999", BIGINT, 99999999999),
    ],
)
def test_numbers(spark, text, kind, expected):
    assert one(spark, typed(F.col("t"), kind), t=(text, "string")) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize(
    "text,expected",
    [
        ("2015-02-10T22:04:26.300Z", dt.datetime(2015, 2, 10, 22, 4, 26, 300000)),
        ("2015-02-10T22:04:26.123456Z", dt.datetime(2015, 2, 10, 22, 4, 26, 123456)),
        ("2015-02-10 22:04:26.300", dt.datetime(2015, 2, 10, 22, 4, 26, 300000)),
        ("2015-02-10T22:04:26+02:00", dt.datetime(2015, 2, 10, 20, 4, 26)),
        ("2015-02-10T22:04:26-05:30", dt.datetime(2015, 2, 11, 3, 34, 26)),
        ("2015-03-08T02:30:00Z", dt.datetime(2015, 3, 8, 2, 30)),  # does not exist in New York
        ("2015-02-10", dt.datetime(2015, 2, 10)),
        ("", dt.datetime(1900, 1, 1)),
        ("yesterday", None),
        (None, None),
    ],
)
def test_times_do_not_depend_on_the_session_zone(spark, zone, text, expected):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, typed(F.col("t"), DATETIME), t=(text, "string")) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_width_and_failed(spark):
    assert one(spark, typed(F.col("t"), width=3), t=("abcdef", "string")) == "abc"
    assert one(spark, failed(F.col("t"), INT), t=("x", "string")) is True
    assert one(spark, failed(F.col("t"), INT), t=("1", "string")) is False
    assert one(spark, failed(F.col("t"), INT), t=(None, "string")) is False


def test_comparison_ignores_case_and_trailing_blanks(spark):
    assert one(spark, tx.same(F.col("t"), "clean"), t=("CLEAN  ", "string")) is True
    assert one(spark, tx.same(F.col("t"), "clean"), t=(" clean", "string")) is False
    assert one(spark, tx.one_of(F.col("t"), ["DB Startup"]), t=("DB STARTUP", "string")) is True
    assert one(spark, tx.same(F.col("t"), "clean"), t=(None, "string")) is None


@pytest.mark.parametrize(
    "start,end,expected",
    [(0, -1, "añbcdef"), (4, -1, "bcdef"), (4, 8, "bcd"), (0, 0, "a"), (6, 6, "c"), (12, 100, "f"), (8, 4, "")],
)
def test_statement_slice(spark, start, end, expected):
    col = tx.statement_slice(F.col("t"), F.col("s"), F.col("e"))
    assert one(spark, col, t=("añbcdef", "string"), s=(start, "int"), e=(end, "int")) == expected


def test_statement_slice_cut(spark):
    col = tx.statement_slice(F.col("t"), F.lit(0), F.lit(-1), 4)
    assert one(spark, col, t=("abcdefgh", "string")) == "abcd"


def test_one_line(spark):
    assert one(spark, tx.one_line(F.col("t")), t=("\n a\r\nb \t", "string")) == "a  b \t"
    assert len(one(spark, tx.one_line(F.col("t")), t=("x" * 5000, "string"))) == 1000


def test_shortened_statements(spark):
    long = "L\n" * 700
    assert one(spark, tx.shorten_statement(F.col("t")), t=(long, "string")) == long[:1155] + "\n"
    short = "a\n" * 100
    assert one(spark, tx.shorten_statement(F.col("t")), t=(short, "string")) == "a" * 100
    # Trailing blanks do not count towards the length.
    padded = "a\nb" + " " * 500
    assert one(spark, tx.shorten_statement(F.col("t")), t=(padded, "string")) == ("ab" + " " * 500)[:220]
    assert one(spark, tx.shorten_failover_statement(F.col("t")), t=("x\n" * 100, "string")) == "x" * 80


@pytest.mark.parametrize(
    "ms,expected",
    [(0, "00:00:00"), (3661999, "01:01:01"), (359999000, "99:59:59"), (360000000, "00:00:00"), (445 * 3600000, "45:00:00")],
)
def test_elapsed_clock_wraps_hours(spark, ms, expected):
    assert one(spark, elapsed_clock(F.col("ms")), ms=(ms, "bigint")) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_minute_boundaries(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:

        def minutes(a, b):
            col = minute_boundaries(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
            return one(spark, col, a=(a, "string"), b=(b, "string"))

        assert minutes("2020-01-01 10:00:59", "2020-01-01 10:01:00") == 1
        assert minutes("2020-01-01 10:00:01", "2020-01-01 10:00:59") == 0
        assert minutes("2020-01-01 10:01:00", "2020-01-01 10:00:59") == -1
        assert minutes("2020-03-08 01:59:00", "2020-03-08 03:01:00") == 62
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_whole_division(spark):
    assert one(spark, whole(F.col("a"), 2), a=(-7, "bigint")) == -3
    assert one(spark, kb_to_mb(F.col("a")), a=(2047, "bigint")) == 1
    assert one(spark, whole(F.col("a"), F.col("b")), a=(1, "bigint"), b=(0, "bigint")) is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_text_and_now_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for micros, text in [(678901, ".678"), (0, ".000"), (120000, ".120"), (5000, ".005")]:
            ts = dt.datetime(2015, 3, 8, 2, 30, 5, micros)  # an hour New York skips
            assert one(spark, iso_text(F.col("t")), t=(ts, "timestamp_ntz")) == "2015-03-08 02:30:05" + text
        now = one(spark, utc_now())
        assert abs(now - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_paths(spark):
    assert one(spark, paths.folder_of(F.col("p")), p=("D:\\Log\\a_0_1.xel", "string")) == "D:\\Log\\"
    assert one(spark, paths.folder_of(F.col("p")), p=("a.xel", "string")) == ""
    assert one(spark, paths.as_folder(F.col("p")), p=("D:\\Log", "string")) == "D:\\Log\\"
    assert one(spark, paths.as_folder(F.col("p")), p=("D:\\Log\\", "string")) == "D:\\Log\\"
    assert one(spark, paths.pattern_in(F.col("p"), "*.xel"), p=("D:\\Log", "string")) == "D:\\Log\\*.xel"
