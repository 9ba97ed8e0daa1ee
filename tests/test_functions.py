import math

from pyspark.sql import functions as F

from tickwise.functions import parse_date, parse_iso_date, parse_number, redact_message, round_half_up
from tickwise.functions.rounding import round_half_even


def _col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_number_rejects_what_pandas_rejects(spark):
    got = _col(spark, [" 1.5 ", "1.0d", "1f", "bad", None, "1e3", ".5", "5.", "-2"], parse_number)
    assert got == [1.5, None, None, None, None, 1000.0, 0.5, 5.0, -2.0]


def test_parse_number_special_values(spark):
    got = _col(spark, ["inf", "-Infinity", "nan"], parse_number)
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2])


def test_parse_iso_date(spark):
    got = _col(spark, ["2026-01-02", "2026", "not-a-date", "2026-02-30",
                       "2024-01-05T23:00:00-05:00", " 2024-01-05 "], parse_iso_date)
    assert [str(d) if d else None for d in got] == [
        "2026-01-02", None, None, None, "2024-01-06", "2024-01-05"]


def test_round_half_up_and_half_even(spark):
    df = spark.createDataFrame([(100.12345,), (-2.5,), (2.5,)], "x double")
    up = [r[0] for r in df.select(round_half_up("x", 4)).collect()]
    even = [r[0] for r in df.select(round_half_even("x", 0)).collect()]
    assert up[0] == 100.1235
    assert _col(spark, [1e31, -1e300, math.inf], lambda c: round_half_up(c, 4), "double") == [1e31, -1e300, math.inf]
    assert even[1:] == [-2.0, 2.0]


def test_redaction_matches_reference_case(spark):
    text = "password=hunter2 api_key=secret " + "x" * 600
    df = spark.createDataFrame([(text,), (None,), ("a\r\nb token: zz&k",)], "m string")
    out = [r[0] for r in df.select(redact_message("m", ["hunter2"])).collect()]
    assert len(out[0]) <= 500
    assert "hunter2" not in out[0] and "secret" not in out[0]
    assert out[0].startswith("password=[REDACTED] api_key=[REDACTED]")
    assert out[1] == "Pipeline processing failed."
    assert out[2] == "a  b token=[REDACTED]&k"


def test_round_half_even_is_pandas(spark):
    import numpy as np
    import pandas as pd

    values = np.random.default_rng(3).integers(0, 10**9, 20_000) / 100_000
    values = [*values.tolist(), 1.00005, 0.00015, -2.5, 1e15 / 7, 0.0]
    for scale in (4, 6):
        got = _col(spark, values, lambda c: round_half_even(c, scale), "double")  # noqa: B023
        assert got == pd.Series(values).round(scale).tolist()


def test_parse_date_forms(spark):
    got = _col(spark, ["20260102", "01/02/2026", "Jan 2, 2026", "2026-1-2", "2026-01-02T10", "2026-01-02",
                       " 2026-01-02 10:30:00 ", "20261302", "13/40/2026", "Foo 2, 2026", "2026", "", None, "1/2/26"],
               parse_date)
    assert [str(d) if d else None for d in got] == ["2026-01-02"] * 7 + [None] * 7
