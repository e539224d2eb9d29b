import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import finance


def schedule(cost, residual, term, a, wacc, curve):
    """Period by period, as the balance is defined."""
    term = max(term, 1)
    dep = cost - residual
    z, b, r, bal, disc, interest, run = dep / term, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0
    for p in range(1, term):
        left = 1 - a * (p - 1)
        paid = z * left + (dep - z * left - b) * a / left
        b += paid
        given = (residual - r) * a / left
        r += given
        balance = cost - b - r
        bal += balance
        disc += balance / (1 + wacc / 12) ** p
        interest += (paid + given) * p
        run += (paid + given) * p * curve[(p - 1) % len(curve)] / 12
    return run / interest * 12, bal / 12, disc / 12


def test_run_off_matches_the_schedule(spark):
    curve = [round(0.02 + 0.0007 * i, 6) for i in range(84)]
    curves = spark.createDataFrame([("c", "|".join(map(str, curve)))], "name string, curve string")
    moments = finance.curve_moments(curves, "name", "curve", max_term=120)
    cases = [(30000.0, 12000.0, t, a, w, "c") for t in (0, 1, 2, 36, 60, 100) for a in (0.0, 0.005) for w in (0.0, 1e-7, 0.03)]
    df = spark.createDataFrame(cases, "cost double, residual double, term int, a double, wacc double, name string")
    out = finance.run_off(df, {"cof": moments}, {"cof": "name"}, "cost", "residual", "term", "a", "wacc").collect()
    assert len(out) == len(cases)
    for r in out:
        want = schedule(r["cost"], r["residual"], r["term"], r["a"], r["wacc"], curve)
        assert (r["cof"], r["anr"], r["anr_disc"]) == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_terms_and_curves_are_never_cut_short(spark):
    curves = spark.createDataFrame([("c", "|".join(["0.1"] * 84)), ("s", "0.1|0.2")], "name string, curve string")
    df = spark.createDataFrame([(100.0, 40.0, 72, 0.01, 0.03, "c")], "cost double, residual double, term int, a double, wacc double, name string")
    full = curves.filter("name = 'c'")
    with pytest.raises(Exception, match="no moments for term"):
        finance.run_off(df, {"cof": finance.curve_moments(full, "name", "curve", 60)}, {"cof": "name"}, "cost", "residual", "term", "a", "wacc").collect()
    with pytest.raises(Exception, match="too few points"):
        finance.curve_moments(curves, "name", "curve", 60).collect()
    longest = df.agg(F.max("term")).scalar()
    r = finance.run_off(df, {"cof": finance.curve_moments(full, "name", "curve", longest)}, {"cof": "name"}, "cost", "residual", "term", "a", "wacc").first()
    assert r["cof"] > 0 and r["anr"] > 0


def test_missing_curve_gives_zero(spark):
    curves = spark.createDataFrame([("c", "0.1|0.2")], "name string, curve string")
    moments = finance.curve_moments(curves, "name", "curve", max_term=60, size=2)
    df = spark.createDataFrame([(100.0, 40.0, 12, 0.01, 0.03, "other")], "cost double, residual double, term int, a double, wacc double, name string")
    r = finance.run_off(df, {"cof": moments}, {"cof": "name"}, "cost", "residual", "term", "a", "wacc").first()
    assert (r["cof"], r["anr"], r["anr_disc"]) == (0.0, 0.0, 0.0)


def test_implied_rate_reaches_the_target(spark):
    df = spark.createDataFrame(
        [(36, 450.0, -20000.0, -8000.0, 1), (60, 300.0, -15000.0, -1000.0, 0), (24, 500.0, -12000.0, 0.0, 1)],
        "n int, pmt double, pv double, fv double, due int",
    )
    rate = finance.implied_rate(*[F.col(c) for c in ("n", "pmt", "pv", "fv", "due")])
    solved = df.withColumn("r", rate).withColumn("back", finance.future_value(F.col("r"), F.col("n"), F.col("pmt"), F.col("pv"), F.col("due")))
    for r in solved.collect():
        assert r["back"] == pytest.approx(r["fv"], abs=1e-5)


def test_rate_that_does_not_exist_is_null(spark):
    df = spark.createDataFrame([(12, 100.0, 1000.0, -1e9)], "n int, pmt double, pv double, fv double")
    assert df.select(finance.implied_rate(F.col("n"), F.col("pmt"), F.col("pv"), F.col("fv"), F.lit(0)).alias("r")).first()["r"] is None


def test_future_value_at_zero_rate_keeps_payments(spark):
    fv = finance.future_value(F.lit(0.0), F.lit(10), F.lit(5.0), F.lit(100.0), F.lit(0))
    assert spark.range(1).select(fv).first()[0] == 150.0


def test_newton_batch_is_independent_of_its_neighbours():
    one = finance._newton(np.array([36.0]), np.array([450.0]), np.array([-20000.0]), np.array([-8000.0]), np.array([1.0]), 0.01, 25)
    both = finance._newton(*[np.array([x, y]) for x, y in zip((36.0, 450.0, -20000.0, -8000.0, 1.0), (12.0, 100.0, 1000.0, -1e9, 0.0))], 0.01, 25)
    assert one[0] == pytest.approx(both[0], rel=1e-12)
