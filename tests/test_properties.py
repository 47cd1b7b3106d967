"""Property tests (hypothesis) against small pure-Python models."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobflow.functions import clean as CL
from jobflow.operators import balance as B

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _py_clean_int(v):
    if v is None:
        return 0
    s = re.sub(r"[^0-9-]", "", v)
    if re.fullmatch(r"-*", s) or re.fullmatch(r"0+", s):
        s = "0"
    try:
        return int(s) if re.fullmatch(r"-?\d+", s) else 0
    except ValueError:
        return 0


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789-ab ,.", max_size=8)), min_size=1, max_size=20))
def test_clean_int_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.i for r in df.select(CL.clean_int(F.col("v")).alias("i")).collect()]
    want = [_py_clean_int(v) for v in values]
    # values beyond 64 bits are unparseable on both sides -> 0
    want = [w if -2**63 <= w < 2**63 else 0 for w in want]
    assert got == want


@SETTINGS
@given(st.lists(st.integers(min_value=-1000, max_value=1000), min_size=1, max_size=24),
       st.integers(min_value=0, max_value=23))
def test_running_stock_is_prefix_sum(spark, saldos, anchor_pos):
    months = [f"{2019 + i // 12}{i % 12 + 1:02d}" for i in range(len(saldos))]
    anchor = months[min(anchor_pos, len(months) - 1)]
    s = spark.createDataFrame(list(zip(months, saldos)), "competencia string, saldo_mensal bigint")
    got = [r.estoque for r in B.running_stock(s, anchor=anchor, baseline=1000000).orderBy("competencia").collect()]
    acc, want = 0, []
    for m, v in zip(months, saldos):
        acc += v + (1000000 if m == anchor else 0)
        want.append(acc)
    assert got == want


def _py_clean_float(v):
    if v is None:
        return 0.0
    s = re.sub(r"[^0-9.,-]", "", v)
    if "," in s:
        s = s.replace(".", "").replace(",", ".")
    if s == "":
        s = "0"
    try:
        return float(s)
    except ValueError:
        return 0.0


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789-.,R$ x", max_size=10)), min_size=1, max_size=20))
def test_clean_float_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.f for r in df.select(CL.clean_float(F.col("v")).alias("f")).collect()]
    assert got == [_py_clean_float(v) for v in values]
