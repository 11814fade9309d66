"""Quartiles of rolling windows are rounded as the SQL's, so that a value on the fence is judged alike."""

import duckdb
import pandas as pd

from terraline.operators import ordered

KEYS = [
    [1.99, 0.89, 0.59, 1.11, 1.51, 0.81, 1.93, 0.29, 2.05, 0.76, 0.36, 1.81, 1.08, 1.82, 2.73, 0.12, 1.76, 2.1, 1.19, 1.38, 1.67, 0.05, 0.18],
    [1.0] * 15 + [5.0], [float("inf")] * 8 + [0.1, 0.2, 0.3] * 4, [None, 0.1, 0.7] * 9,
]


def test_a_value_on_the_fence(spark):
    rows = [(k, i, v) for k, values in enumerate(KEYS) for i, v in enumerate(values)]
    rows += [(10 + i // 22, i, (i * 7919 % 307) / 100) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, i int, a double")
    got = {(r["k"], r["i"]): r["flagged_axes_count"] for r in ordered.rolling_outliers(df, ["k"], ["i"], ["a"], iqr_k=0.5).collect()}
    con = duckdb.connect()
    con.register("t", pd.DataFrame([r for r in rows if r[0] != 2], columns=["k", "i", "a"]))
    sql = """SELECT k, i, coalesce(count(a) OVER w >= 15 AND CASE WHEN quantile_cont(a, 0.75) OVER w - quantile_cont(a, 0.25) OVER w > 1e-6
      THEN a < quantile_cont(a, 0.25) OVER w - 0.5 * (quantile_cont(a, 0.75) OVER w - quantile_cont(a, 0.25) OVER w) OR a > quantile_cont(a, 0.75) OVER w + 0.5 * (quantile_cont(a, 0.75) OVER w - quantile_cont(a, 0.25) OVER w)
      ELSE abs(a - quantile_cont(a, 0.5) OVER w) > 6.0 * 1.4826 * mad(a) OVER w END, false)::INT FROM (SELECT k, i, CASE WHEN NOT isnan(a) THEN a END AS a FROM t)
      WINDOW w AS (PARTITION BY k ORDER BY i ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING)"""
    want = {(k, i): f for k, i, f in con.execute(sql).fetchall()}
    assert {at: f for at, f in got.items() if at[0] != 2} == want
