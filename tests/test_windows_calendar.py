import datetime as dt

import pytest

from jobflow.functions import calendar as M
from jobflow.operators import ranking as G
from jobflow.operators import windows as W


def _series(spark, vals, start_year=2020):
    rows = [(f"{start_year + i // 12}{i % 12 + 1:02d}", v, v * 2) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "competencia string, saldo_mensal bigint, admissoes bigint")


def test_ytd_resets_each_year(spark):
    s = _series(spark, [1] * 14)
    got = [r.saldo_ano for r in W.ytd(s).orderBy("competencia").collect()]
    assert got == list(range(1, 13)) + [1, 2]


def test_pct_change_and_moving_average(spark):
    s = _series(spark, [10, 20, 0, 5])
    rows = W.moving_avg(W.pct_change(s, value="saldo_mensal"), 3).orderBy("competencia").collect()
    assert [r.var_pct_saldo_mensal for r in rows] == [None, 100.0, -100.0, None]   # previous 0 -> null
    assert [r.media_movel_3 for r in rows] == [10.0, 15.0, 10.0, round(25 / 3, 6)]


def test_seasonality_index(spark):
    s = _series(spark, [1] * 12 + [3] * 12)        # admissoes = 2 then 6 -> every month mean 4
    out = W.seasonality(s).collect()
    assert len(out) == 12 and all(r.indice_sazonal == 1.0 for r in out)


def test_head_tail_short_series_repeats_rows(spark):
    s = _series(spark, [1, 2, 3])
    tags = sorted((r.competencia, r.posicao) for r in G.head_tail(s, 2).collect())
    assert tags == [("202001", "inicio"), ("202002", "fim"), ("202002", "inicio"), ("202003", "fim")]


def test_topk_ties_break_by_key(spark):
    df = spark.createDataFrame([("a", "x", 5), ("a", "y", 5), ("a", "z", 1), ("b", "x", 2)], "g string, k string, n int")
    got = sorted((r.g, r.k) for r in G.topk_per_group(df, ["g"], "n", 1, tie=["k"]).collect())
    assert got == [("a", "x"), ("b", "x")]


def test_calendar_rules(spark):
    assert M.validate_period(2021) == ("202101", "202112")
    assert M.validate_period(2021, start_month=3) == ("202103", "202103")
    assert M.validate_period(2021, 2022, 11, 2) == ("202111", "202202")
    for bad in [dict(start_year=2019), dict(start_year=2022, end_year=2021),
                dict(start_year=2030, as_of=dt.date(2025, 1, 1)), dict(start_year=2021, start_month=13)]:
        with pytest.raises(ValueError):
            M.validate_period(**bad)
    months = [r.competencia for r in M.calendar(spark, "202111", "202202").collect()]
    assert months == ["202111", "202112", "202201", "202202"]


def test_densify_fills_missing_months(spark):
    s = spark.createDataFrame([("202101", 3), ("202103", 1)], "competencia string, n bigint")
    d = M.densify(s, M.calendar(spark, "202101", "202104")).orderBy("competencia").collect()
    assert [(r.competencia, r.n) for r in d] == [("202101", 3), ("202102", 0), ("202103", 1), ("202104", 0)]
