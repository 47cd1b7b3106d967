import pytest
from pyspark.sql import functions as F

from jobflow.operators import filters as C


def _df(spark):
    rows = [(i, f"{2020 + i % 4}{(i % 12) + 1:02d}", (-1) ** i, f"{i % 100:05d}123") for i in range(200)]
    return spark.createDataFrame(rows, "id int, competencia_mov string, saldo_movimentacao int, cep string")


def test_period_range_first_of_month(spark):
    d = _df(spark)
    got = {r.competencia_mov for r in C.filter_period(d, start="2021-03-15", end="2022-02-28").collect()}
    assert all("202104" <= m <= "202202" for m in got)
    got1 = {r.competencia_mov for r in C.filter_period(d, start="2021-03-01").collect()}
    assert min(got1) == "202103" or min(got1) > "202103"


def test_years_months(spark):
    d = _df(spark)
    assert all(r.competencia_mov[:4] in ("2021", "2023") for r in C.filter_period(d, years=[2021, 2023]).collect())
    assert all(r.competencia_mov[4:] == "06" for r in C.filter_period(d, months=[6]).collect())


def test_movement_both_is_error(spark):
    import pytest
    with pytest.raises(ValueError):
        C.filter_movement(_df(spark), only="both")


def test_wildcards_are_escaped():
    assert C.wildcard_regex("01.?*") == r"^01\..*.*$".replace(".*.*", "..*")


def test_cep_wildcards(spark):
    d = _df(spark)
    n = C.filter_geo(d, ceps=["0001*", "00?02123"]).count()
    assert n == d.where(F.col("cep").startswith("0001") | F.col("cep").rlike("^00.02123$")).count()


def test_chain_report_matches_sequential_filters(spark):
    d = _df(spark)
    chain = C.FilterChain().period(years=[2021, 2022]).movement(only="admissions").add("cep", ["cep"], F.col("cep") < "00050")
    rep = chain.report(d).orderBy("passo").collect()
    seq = [d.count()]
    cur = d
    for name, cols, p in chain.steps:
        cur = cur.where(p())
        seq.append(cur.count())
    assert [r.linhas_depois for r in rep] == seq[1:]
    assert [r.linhas_antes for r in rep] == seq[:-1]
    assert chain.apply(d).count() == seq[-1]


def test_chain_fails_on_absent_columns_unless_told(spark):
    d = _df(spark)
    chain = C.FilterChain().geo(regions=[1])
    with pytest.raises(ValueError, match="regiao"):
        chain.apply(d)
    lenient = C.FilterChain(skip_absent=True).geo(regions=[1])
    assert lenient.apply(d).count() == d.count()
    assert [(r.filtro, r.situacao, r.removidas) for r in lenient.report(d).collect()] == [("regiao", "ignorado", 0)]
    with pytest.raises(ValueError, match="nada"):
        C.range_rules(d, {"nada": {"min": 1}})


def test_chain_table_step_keeps_each_row_once(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id long, subclasse string")
    codes = spark.createDataFrame([("a",), ("a",), ("z",)], "code string")
    chain = C.FilterChain().cnae_table(codes)
    assert sorted(r.id for r in chain.apply(d).collect()) == [1, 3] and chain.apply(d).columns == d.columns
    assert chain.report(d).first().linhas_depois == 2


def test_year_filter_prunes_directories(spark):
    from jobflow.session import scratch_path
    path = scratch_path(spark, "t-prune")
    rows = [(f"{y}{m:02d}", y, m) for y in (2020, 2021, 2022) for m in (1, 2)]
    spark.createDataFrame(rows, "competencia_mov string, ano int, mes int").write.partitionBy("ano", "mes").parquet(path)
    d = C.filter_period(spark.read.parquet(path), years=[2021], months=[2])
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan.replace("isnotnull(mes#", "isnotnull(ano#") and d.count() == 1
