"""Mergeable distinct counts, trends and company profiles."""

import random

import pytest
from pyspark.sql import functions as F

from jobflow.operators import profiles as PR


def test_a_year_of_twelve_sketches(spark):
    df = spark.range(240000).select(
        F.concat(F.lit("2021"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")).alias("competencia_mov"),
        (F.col("id") % 50000).alias("cnpj"), F.when(F.col("id") % 3 == 0, F.lit(" ")).otherwise((F.col("id") % 27).cast("string")).alias("uf"))
    s = PR.distinct_sketches(df, ["cnpj", "uf"])
    assert s.count() == 12
    year = {r.coluna: r.distintos_estimados for r in PR.distinct_over(s, ["cnpj", "uf"], F.substring("competencia", 1, 4), "ano").collect()}
    assert year["cnpj"] == pytest.approx(50000, rel=0.03) and year["uf"] == 18     # 27 states less those of every third row
    half = PR.distinct_over(s.where("competencia <= '202106'"), ["cnpj"], F.lit(1), "faixa").first()
    want = df.where("competencia_mov <= '202106'").select("cnpj").distinct().count()
    assert half.distintos_estimados == pytest.approx(want, rel=0.03)
    # a month that is counted again replaces its own sketch only
    again = s.where("competencia <> '202103'").unionByName(PR.distinct_sketches(df.where("competencia_mov = '202103'"), ["cnpj", "uf"]))
    assert PR.distinct_over(again, ["cnpj"], F.lit(1), "a").first().distintos_estimados == year["cnpj"]


def test_trend_of_known_lines(spark):
    rows = [("a", f"2021{m:02d}", "MOV", "10", 3 * m + 1) for m in range(1, 13)]
    rows += [("b", f"2021{m:02d}", "MOV", "10", 5) for m in range(1, 5)] + [("c", "202101", "MOV", "10", 7), ("d", "junk", "MOV", "10", 7)]
    rows += [("e", "202101", "MOV", "10", 9), ("e", "202104", "EXC", "10", 3), (None, "202101", "MOV", "10", 1), (None, "202102", "MOV", "10", 2)]
    df = spark.createDataFrame(rows, "uf string, competencia_mov string, tipo string, tipo_movimentacao string, saldo_movimentacao int")
    got = {r.uf: tuple(r)[1:] for r in PR.segment_trend(df, "uf").collect()}
    assert got == {"a": (12, 3.0, 4.0, 1.0, "alta"), "b": (4, 0.0, 5.0, None, "estavel"), "c": (1, None, None, None, None),
                   "e": (2, -4.0, 9.0, 1.0, "queda"), None: (2, 1.0, 1.0, 1.0, "alta")}


def test_profiles_find_planted_groups(spark):
    rng, rows = random.Random(4), []
    for c, (a, d, m, s) in enumerate([(5, 5, 3, 1500), (200, 10, 12, 1800), (30, 300, 10, 9000)]):
        for k in range((60, 30, 15)[c]):
            rows.append((c * 100 + k, *(v * rng.uniform(0.9, 1.1) for v in (a, d, m, s))))
    df = spark.createDataFrame(rows, "cnpj long, admissoes double, desligamentos double, meses_ativos double, salario_medio double")
    got = {r.cnpj: r.perfil for r in PR.company_profiles(df, 3).collect()}
    groups = [{got[c * 100 + k] for k in range(n)} for c, n in enumerate((60, 30, 15))]
    assert groups == [{0}, {1}, {2}]


def test_features_of_companies(spark):
    rows = [(1, "202101", "10", 10.5), (1, "202101", "31", None), (1, "202102", "10", 20.0), (2, "202101", "XX", None), (None, "202101", "10", 1.0)]
    df = spark.createDataFrame(rows, "cnpj long, competencia_mov string, tipo_movimentacao string, salario double")
    got = {r.cnpj: tuple(r)[1:] for r in PR.company_features(df).collect()}
    assert got == {1: (2.0, 1.0, 2.0, 15.25), 2: (0.0, 0.0, 1.0, 0.0)}
