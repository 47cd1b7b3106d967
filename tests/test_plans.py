"""Plan-shape checks: pushdown, pruning, no Python in the hot path, and the driver contract."""

from jobflow.operators import filters as C
from jobflow.sources.tables import mov, table
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).collect()
    assert len(rows) > 0 and list(E.entry(spark).columns) == ["competencia", "admissoes", "desligamentos", "saldo_mensal", "estoque"]


def test_every_query_has_a_callable_and_most_have_oracles():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


# keys that write files or run an action before they return
ACTING = ("a4_", "a7_", "a8_", "a9_", "a1", "a22_landed", "a23_landed", "c3_layout", "e16_", "j9_", "j26_", "k1_", "k2_", "n1_", "n2_from",
          "a6_", "n2_schema", "n3_job", "k3_stream", "b21_fact", "e8_distinct", "n4_")


def test_no_python_udf_in_registered_plans(spark):
    from jobflow.plans import registry
    registry.load_all()
    for k, fn in registry.QUERIES.items():
        if not k.startswith(ACTING):
            p = _plan(fn(spark, SF_SMALL))
            assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k
            assert "RoundRobinPartitioning" not in p, k


def test_scan_prunes_columns_and_pushes_filters(spark):
    li = table(spark, SF_SMALL, "orders")
    df = li.where("o_orderstatus = 'F'").select("o_orderkey")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_balance_plan_has_one_aggregate_over_facts(spark):
    import __spark_entry__ as E
    p = _plan(E.entry(spark))
    assert p.count("HashAggregate") >= 2          # partial + final
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint" in p


def test_mov_joins_only_needed_tables(spark):
    p = _plan(mov(spark, SF_SMALL, ["competencia_mov", "tipo"]))
    assert "part.parquet" not in p and "customer.parquet" not in p


def test_company_balance_joins_facts_once(spark):
    from jobflow.plans import registry
    registry.load_all()
    for k in ("e4_company_balance", "j1_balance_formula", "j24_balance_valid", "j27_quarantine", "j2_period_format"):
        p = _plan(registry.QUERIES[k](spark, SF_SMALL))
        assert p.count("lineitem.parquet") == 1 and "part.parquet" not in p and "customer.parquet" not in p, k


def test_results_do_not_depend_on_session_time_zone(spark):
    import __spark_entry__ as E
    from jobflow.session import session_conf
    q = E.queries()
    keys = ["n2_balance", "e21_recent", "d3_stale", "b17_parse_date", "k3_lateness", "f8_month_gaps"]
    base = {k: sorted(map(tuple, q[k](spark, SF_SMALL).collect())) for k in keys}
    with session_conf(spark, spark__sql__session__timeZone="America/Sao_Paulo"):
        other = {k: sorted(map(tuple, q[k](spark, SF_SMALL).collect())) for k in keys}
    assert base == other


def test_bucketed_fixture_join_has_no_exchange(spark):
    from jobflow.operators import balance as B
    from jobflow.sources.tables import bucket_fixture
    from jobflow.session import session_conf
    bucket_fixture(spark, SF_SMALL, 4)
    with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        m = mov(spark, SF_SMALL, ["competencia_mov", "tipo_movimentacao", "tipo", "saldo_movimentacao"], bucketed=True)
        plan = _plan(m)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        a = sorted(map(tuple, B.balance_series(m).collect()))
    b = sorted(map(tuple, B.balance_series(mov(spark, SF_SMALL, ["competencia_mov", "tipo_movimentacao", "tipo",
                                                                   "saldo_movimentacao"])).collect()))
    assert a == b


def test_the_movement_join_carries_codes_and_months(spark):
    plan = _plan(mov(spark, SF_SMALL, ["id", "competencia_mov", "tipo", "tipo_movimentacao"], shuffled=True))
    joined = plan[plan.index("SortMergeJoin"):]
    dealt = [line for line in joined.splitlines() if "Sort [" in line]
    below = [line for line in joined.splitlines() if "Project [" in line]
    assert len(dealt) == 2 and any(" AS code#" in line and " AS ship_ym#" in line for line in below)
    assert not any("BroadcastHashJoin" in line for line in plan.splitlines())


def test_movements_are_the_same_by_a_shuffle(spark):
    a, b = mov(spark, SF_SMALL), mov(spark, SF_SMALL, shuffled=True)
    assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_derived_movement_columns_of_missing_cells(spark, tmp_path):
    import datetime as dt
    d, other = dt.datetime(1996, 12, 31), dt.datetime(1997, 1, 1)
    lines = [(1, 1, 6, 3, "R", "F", d), (1, 2, 0, 10, None, None, other), (1, 3, None, None, "N", "F", None), (2, 1, 5, 5, "A", "O", d),
             (None, 1, 5, 5, "A", "O", d), (3, 1, 1, None, "N", "O", d)]
    spark.createDataFrame([(*x, 1.0, 2.0) for x in lines], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7, d), (2, 8, None), (None, 9, d)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(
        f"{tmp_path}/orders.parquet")
    for shuffled in (False, True):
        got = mov(spark, str(tmp_path), ["id", "competencia_mov", "competencia_dec", "tipo", "tipo_movimentacao", "saldo_movimentacao"],
                  shuffled=shuffled)
        assert sorted(map(tuple, got.collect())) == [
            (11, "202112", "202112", "EXC", "XX", 1), (12, "202112", "202201", "FOR", "98", -1), (13, "202112", None, "MOV", "XX", 1),
            (21, None, "202112", "MOV", "45", -1)]
