import datetime as dt

from pyspark.sql import functions as F

from jobflow.operators import quality as Q


def _df(spark):
    rows = [(1, "202001", "1", 5, 2, 3), (2, "2020-13", "M", 1, 1, 5), (3, None, "7", None, 1, 1), (4, "2030-01", "F", 2, 0, 2)]
    return spark.createDataFrame(rows, "id int, periodo string, sexo string, admitidos int, desligados int, saldo int")


def test_fused_checks_equal_individual(spark):
    d = _df(spark)
    checks = [Q.period_format(), Q.period_range(as_of=dt.date(2025, 12, 31)), Q.domain("sexo", ["1", "2", "9", "M", "F"]),
              Q.balance_formula()]
    fused = {r.check_name: (r.bad_rows, r.total_rows) for r in Q.run_checks(d, checks).collect()}
    for c in checks:
        single = Q.run_checks(d, [c]).collect()[0]
        assert fused[c.name] == (single.bad_rows, single.total_rows)
    assert fused["saldo_formula"] == (1, 3)
    assert fused["intervalo_periodo"] == (1, 3)


def test_report_overall_and_quarantine(spark):
    d = _df(spark)
    rep = Q.QualityReport(d, [Q.period_format(), Q.domain("sexo", ["1", "2", "9", "M", "F"])]).run()
    geral = rep.where(F.col("check_name") == "geral").collect()[0]
    assert geral.status == "falha" and geral.bad_rows == 1
    q = Q.quarantine(d, [Q.domain("sexo", ["1", "2", "9", "M", "F"])]).orderBy("id").collect()
    assert [r.valido for r in q] == [True, True, False, True]
    assert q[2].motivos == "dominio_sexo:sexo"


def test_structure_without_data_scan_for_schema(spark):
    d = _df(spark)
    rows = {(r.check_name, r.column_name): r.bad_rows for r in Q.structure(d).collect()}
    assert rows[("campo_essencial", "competencia")] == 0     # PERIODO
    assert rows[("campo_essencial", "municipio")] == 1
    assert rows[("nao_vazio", "*")] == 0


def test_duplicates_and_keys_equal_their_own_operators(spark):
    from pyspark.sql import functions as F

    from jobflow.operators import aggregates as A
    rows = [(1, "a", 1.0), (1, "a", 1.0), (1, "a", 2.0), (2, None, None), (2, None, None), (2, None, None), (None, "b", 3.0), (3, "c", 4.0)]
    df = spark.createDataFrame(rows, "k long, t string, v double")
    for frame in (df, df.limit(0), df.where("k = 3"), df.withColumn("same", F.lit(1))):
        got = A.duplicates_and_keys(frame, ["k", "t"]).first()
        whole, keys = A.duplicate_rows(frame).first(), A.duplicate_keys(frame, ["k", "t"]).first()
        assert got[:3] == whole[:] and got.chaves_distintas == keys.chaves_distintas
        assert got.chaves_duplicadas == (keys.linhas_duplicadas or 0)


def test_report_removes_its_copy_and_leaves_the_session_alone(spark):
    import os

    from jobflow import session
    from jobflow.operators import quality as Q
    df = spark.createDataFrame([(1, "MOV"), (2, "XX")], "id long, tipo string")
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    before = set(session._SCRATCH)
    r = Q.QualityReport(df, [Q.domain("tipo", ["MOV"], "tipos")], materialize=True, duplicate_keys=["id", "tipo"]).run()
    assert {x.check_name: x.bad_rows for x in r.collect()} == {"tipos": 1, "duplicatas": 0, "chaves_duplicadas": 0, "geral": 1}
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit
    new = [p for p in set(session._SCRATCH) - before if "quality-input" in p]
    assert not new and not [f for f in os.listdir(session.ensure_checkpoint_dir(spark).removeprefix("file:")) if f.startswith("quality-input")]
