"""Parity rules of SURVEY 0 / 1.4, one test each."""
import datetime as dt

from pyspark.sql import functions as F

from switchboard.functions import exprs as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_float_to_int_cast_rounds_half_away_from_zero(spark):
    assert one(spark, X.round_to_bigint(F.lit(1500) / 1000)) == 2
    assert one(spark, X.round_to_bigint(F.lit(2500) / 1000)) == 3
    assert one(spark, X.round_to_bigint(F.lit(-1500) / 1000)) == -2
    assert one(spark, X.round_to_bigint(F.lit(1499) / 1000)) == 1


def test_regexp_extract_no_match_is_null(spark):
    assert one(spark, X.extract_or_null(F.lit("no tag here"), r"^\[([A-Z]{2,5})\]")) is None
    assert one(spark, X.extract_or_null(F.lit("[ABC] x"), r"^\[([A-Z]{2,5})\]")) == "ABC"


def test_case_insensitive_regex_folds_unicode(spark):
    # U+017F (long s) folds to 's' under Unicode case folding, as in RE2
    assert one(spark, X.contains_ci(F.lit("reset paſsword"), "(password)")) is True
    assert one(spark, X.contains_ci(F.lit("PASSWORD"), "(password)")) is True


def test_safe_divide_and_pct(spark):
    assert one(spark, X.safe_pct(F.lit(5), F.lit(0))) is None
    assert one(spark, X.safe_pct(F.lit(1), F.lit(4))) == 25.0
    assert one(spark, X.safe_divide(F.lit(1), F.lit(None).cast("int"))) is None


def test_epoch_seconds_floors_and_is_zone_free(spark):
    ts = F.expr("TIMESTAMP_NTZ'1969-12-31 23:59:59.5'")
    assert one(spark, X.epoch_seconds(ts)) == -1
    ts2 = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:07.9'")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, X.epoch_seconds(ts2)) == 1704067207
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_seconds_and_millis_to_ntz(spark):
    assert one(spark, X.seconds_to_ts(F.lit(0))) == dt.datetime(1970, 1, 1)
    assert one(spark, X.millis_to_ts(F.lit(1500))) == dt.datetime(1970, 1, 1, 0, 0, 1, 500000)


def test_parse_date_key_and_date_key(spark):
    assert one(spark, X.parse_date_key(F.lit(20240229))) == dt.date(2024, 2, 29)
    assert one(spark, X.date_key(F.lit(dt.date(2024, 3, 1)))) == 20240301


def test_concat_propagates_null(spark):
    assert one(spark, X.bar_concat(F.lit("a"), F.lit(None).cast("string"))) is None


def test_add_days_exact_is_168_hours(spark):
    ts = F.expr("TIMESTAMP_NTZ'2024-03-08 12:00:00'")
    assert one(spark, X.add_days_exact(ts, 7)) == dt.datetime(2024, 3, 15, 12, 0)


def test_ntz_maths_is_zone_free_inside_a_dst_gap(spark):
    # 02:30 on 1997-04-06 does not exist in New York; NTZ values must not move
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ts = F.expr("TIMESTAMP_NTZ'1997-04-06 02:30:00.25'")
        assert one(spark, X.epoch_micros(ts)) == (860284800 + 9000) * 10**6 + 250000
        assert one(spark, X.epoch_seconds(ts)) == 860284800 + 9000
        assert one(spark, X.epoch_millis(ts)) == (860284800 + 9000) * 1000 + 250
        assert one(spark, X.format_ntz(ts)) == "19970406023000"
        assert one(spark, X.instant_to_ntz(X.ntz_to_instant(ts))) == dt.datetime(1997, 4, 6, 2, 30, 0, 250000)
        assert one(spark, F.window(ts, "30 minutes").start) == dt.datetime(1997, 4, 6, 2, 30)
        assert one(spark, F.hour(ts)) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
