"""Balance and stock: edge cases from the reference's unit tests and the SURVEY's list."""

from pyspark.sql import functions as F

from jobflow.operators import balance as B


def _mov(spark, rows):
    return spark.createDataFrame(rows, "competencia_mov string, tipo_movimentacao string, tipo string, saldo_movimentacao int")


def _series(spark, rows):
    return spark.createDataFrame(rows, "competencia string, saldo_mensal bigint")


def test_stock_anchor_month_gets_baseline(spark):
    s = _series(spark, [("202001", 112113), ("202002", 50000), ("202003", -30000)])
    out = {r.competencia: r.estoque for r in B.running_stock(s, baseline=B.TEST_BASELINE).collect()}
    assert out["202001"] == 39567082 + 112113
    assert out["202002"] == 39567082 + 112113 + 50000
    assert out["202003"] == 39567082 + 112113 + 50000 - 30000


def test_stock_first_on_or_after_variant(spark):
    s = _series(spark, [("202003", 25000), ("202004", -15000)])
    out = {r.competencia: r.estoque for r in
           B.running_stock(s, baseline=B.TEST_BASELINE, mode="first_on_or_after").collect()}
    assert out == {"202003": 39567082 + 25000, "202004": 39567082 + 10000}
    # default F1 mode: anchor absent -> no baseline
    out1 = {r.competencia: r.estoque for r in B.running_stock(s).collect()}
    assert out1 == {"202003": 25000, "202004": 10000}


def test_stock_series_before_anchor_gets_none(spark):
    s = _series(spark, [("201911", 100000), ("201912", 50000)])
    out = {r.competencia: r.estoque for r in
           B.running_stock(s, baseline=B.TEST_BASELINE, mode="first_on_or_after").collect()}
    assert out == {"201911": 100000, "201912": 150000}


def test_stock_unordered_input(spark):
    s = _series(spark, [("202003", 30000), ("202001", 112113), ("202002", 20000)])
    rows = B.running_stock(s, baseline=0).orderBy("competencia").collect()
    assert [r.estoque for r in rows] == [112113, 132113, 162113]


def test_missing_direction_gives_zero(spark):
    m = _mov(spark, [("202001", "10", "MOV", 1), ("202001", "20", "MOV", 1)])
    r = B.monthly_balance(m).collect()[0]
    assert (r.admissoes, r.desligamentos, r.saldo_mensal) == (2, 0, 2)


def test_exclusion_inversion_and_codes(spark):
    m = _mov(spark, [("202001", "10", "MOV", 1), ("202001", "31", "MOV", -1), ("202001", "99", "MOV", -1),
                     ("202001", "10", "EXC", 1), ("202001", "XX", "MOV", 1), ("202001", "admissão", "FOR", 1)])
    r = B.monthly_balance(m).collect()[0]
    # admissions: 1 (MOV) - 1 (EXC inverted) + 1 (alias) = 1 ; separations |-2| = 2 (99 counts as separation)
    assert (r.admissoes, r.desligamentos, r.saldo_mensal) == (1, 2, -1)
    unk = B.unrecognized(m).collect()
    assert [(u.codigo, u.n_registros) for u in unk] == [("XX", 1)]


def test_formula_equals_balance(spark):
    m = _mov(spark, [("202001", "10", "MOV", 1), ("202001", "31", "FOR", -1), ("202001", "20", "EXC", 1),
                     ("202001", "40", "EXC", -1), ("202002", "10", "MOV", 1)])
    a = {r.competencia: r.saldo_mensal for r in B.monthly_balance(m).collect()}
    b = {r.competencia: r.saldo_formula for r in B.balance_by_formula(m).collect()}
    assert a == b


def test_empty_input(spark):
    m = _mov(spark, [])
    assert B.balance_series(m).count() == 0


def test_union_sources_inverts_exclusions(spark):
    cols = "competencia_mov string, tipo_movimentacao string, saldo_movimentacao int"
    mov = spark.createDataFrame([("202001", "10", 1)], cols)
    exc = spark.createDataFrame([("202001", "10", 1)], cols)
    u = B.union_sources(mov, exc, None)
    assert sorted((r.tipo, r.saldo_movimentacao) for r in u.collect()) == [("EXC", -1), ("MOV", 1)]


def test_append_recalc_equals_full(spark):
    m = _mov(spark, [("202001", "10", "MOV", 1), ("202002", "31", "MOV", -1), ("202003", "10", "MOV", 1)])
    full = B.balance_series(m).orderBy("competencia").collect()
    old = B.balance_series(m.where(F.col("competencia_mov") < "202003"))
    new = B.monthly_balance(m.where(F.col("competencia_mov") >= "202003"))
    inc = B.append_recalc(old, new).orderBy("competencia").collect()
    assert [tuple(r) for r in full] == [tuple(r) for r in inc]


def test_exclusions_in_declared_month(spark):
    cols = "competencia_mov string, competencia_dec string, tipo_movimentacao string, tipo string, saldo_movimentacao int"
    m = spark.createDataFrame([("202001", "202001", "10", "MOV", 1), ("202001", "202003", "10", "EXC", 1)], cols)
    by_mov = {r.competencia: r.admissoes for r in B.monthly_balance(m).collect()}
    by_dec = {r.competencia: r.admissoes for r in B.monthly_balance(m, exclusion_month="declared").collect()}
    assert by_mov == {"202001": 0}
    assert by_dec == {"202001": 1, "202003": -1}
