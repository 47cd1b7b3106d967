import datetime as dt

from pyspark.sql import functions as F

from jobflow.operators import analytics as AN
from jobflow.operators import balance as B
from jobflow.operators import oplog as OL
from jobflow.streaming import incremental as INC


def test_kaplan_meier_textbook(spark):
    # durations 1,1(censored),2,3,3 -> S(1)=4/5... events at 1 (1 of 5), 2 (1 of 3), 3 (1 of 2, plus one censored)
    rows = [(1, True), (1, False), (2, True), (3, True), (3, False)]
    sp = spark.createDataFrame(rows, "duracao int, evento boolean")
    km = {r.duracao: r.sobrevivencia for r in AN.kaplan_meier(sp).collect()}
    assert km[1] == round(4 / 5, 6)
    assert km[2] == round(4 / 5 * 2 / 3, 6)
    assert km[3] == round(4 / 5 * 2 / 3 * 1 / 2, 6)


def test_tenure_pairs_admission_with_next_separation(spark):
    rows = [("c", "p", "202001", "10"), ("c", "p", "202004", "31"), ("c", "q", "202002", "10"), ("c", "q", "202003", "20")]
    df = spark.createDataFrame(rows, "cnpj string, cpf string, competencia_mov string, tipo_movimentacao string")
    sp = {(r.cpf, r.coorte): (r.evento, r.duracao) for r in AN.tenure(df).collect()}
    assert sp[("p", "202001")] == (True, 3)
    assert sp[("q", "202002")] == (False, 1)     # censored at the last observed month
    assert sp[("q", "202003")] == (False, 0)


def test_op_metrics_and_recent(spark):
    ts = dt.datetime(2024, 1, 10, 12)
    rows = [(1, "a", True, 10.0, ts), (2, "a", False, 30.0, ts - dt.timedelta(hours=30)), (3, "b", True, 5.0, ts)]
    log = spark.createDataFrame(rows, "op_id long, operation string, success boolean, duration double, ts timestamp_ntz")
    m = {r.operation: (r.total, r.sucesso, r.duracao_media) for r in OL.op_metrics(log).collect()}
    assert m["a"] == (2, 1, 20.0) and m["geral"] == (3, 2, 15.0)
    rec = OL.recent_ops(log, ref=ts, hours=24)
    assert sorted(r.op_id for r in rec.collect()) == [1, 3]


def test_retroactive_merge_equals_batch(spark):
    cols = "competencia_mov string, tipo_movimentacao string, tipo string, saldo_movimentacao int"
    base = [("202001", "10", "MOV", 1), ("202002", "31", "MOV", -1)]
    late = [("202001", "31", "FOR", -1), ("202003", "10", "FOR", 1), ("202002", "31", "EXC", -1)]
    full = B.balance_series(spark.createDataFrame(base + late, cols)).orderBy("competencia").collect()
    state = INC.signed_delta(spark.createDataFrame(base, cols))
    inc = INC.balance_incremental(state, spark.createDataFrame(late, cols)).orderBy("competencia").collect()
    assert [tuple(r) for r in full] == [tuple(r) for r in inc]


def test_company_rollup_total_equals_sum(spark):
    from jobflow.operators import aggregates as A
    rows = [("1", "202001", 3, 1, 2), ("2", "202001", 1, 4, -3), ("1", "202002", 2, 2, 0), ("", "202002", 9, 9, 0)]
    e = spark.createDataFrame(rows, "cnpj string, competencia string, admitidos int, desligados int, saldo int")
    out = {r.cnpj: (r.admissoes, r.desligamentos, r.saldo) for r in A.company_balance_with_total(e).collect()}
    assert out["GERAL"] == (6, 7, -1) and "" not in out


def test_approximate_options_close_to_exact(spark):
    from jobflow.operators import aggregates as A
    rows = [(str(i % 50), "202001", i % 7, 1, 1, "s") for i in range(500)]
    e = spark.createDataFrame(rows, "cnpj string, competencia string, uf int, admitidos int, desligados int, secao string")
    e = e.withColumn("saldo", F.col("admitidos") - F.col("desligados"))
    ex = A.indicators(e).collect()[0]
    ap = A.indicators(e, approx=True).collect()[0]
    assert ex.total_cnpjs_distintos == 50 and abs(ap.total_cnpjs_distintos - 50) <= 3
    assert ex.total_ufs_distintas == ap.total_ufs_distintas == 7
    q = spark.range(1000).withColumn("v", F.col("id").cast("double"))
    exact = A.iqr_fences(q, ["v"])["v"][:2]
    approx = A.iqr_fences(q, ["v"], exact=False)["v"][:2]
    assert exact == (249.75, 749.25) and abs(approx[0] - 249.75) <= 2 and abs(approx[1] - 749.25) <= 2


def test_exact_quantiles_match_sorting(spark):
    import random
    from jobflow.operators import aggregates as A
    rng = random.Random(4)
    rows = [(rng.choice([None, float(rng.randrange(40))]), round(rng.gauss(0, 1e4), 2), None) for _ in range(3001)]
    d = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    got = A.exact_quantiles(d, ["a", "b", "c"], (0.0, 0.25, 0.5, 0.9, 1.0))
    for i, c in enumerate("ab"):
        v = sorted(r[i] for r in rows if r[i] is not None)
        for q, x in zip((0.0, 0.25, 0.5, 0.9, 1.0), got[c], strict=True):
            at = q * (len(v) - 1)
            lo, hi = v[int(at)], v[min(int(at) + 1, len(v) - 1)]
            assert abs(x - (lo + (hi - lo) * (at - int(at)))) < 1e-9
    assert got["c"] == [None] * 5


def test_checksum_tells_null_places_apart(spark):
    from jobflow.operators import aggregates as A
    one = spark.createDataFrame([(None, "x")], "a string, b string")
    two = spark.createDataFrame([("x", None)], "a string, b string")
    assert A.checksum(one).first().hash_linhas != A.checksum(two).first().hash_linhas


def test_recent_operations_have_no_cap(spark):
    ref = dt.datetime(2024, 1, 10, 12)
    log = spark.range(5000).selectExpr("id AS op_id", "'Download' AS operation", "TIMESTAMP_NTZ '2024-01-10 11:00:00' AS ts")
    assert OL.recent_ops(log, ref=ref, operations=["down"]).count() == 5000
    assert OL.recent_ops(log, ref=ref, keep=7).count() == 7
