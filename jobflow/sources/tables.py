"""Driver tables and the labour-shaped views derived from them.

The driver ships TPC-H-like tables.  ``mov`` derives a movement fact table
(one row per line item) from them, ``estab`` the establishment layout (one
row per company and month), ``catalog`` a landed-file catalogue (one file per
order) and ``oplog`` an operation log (one operation per event).  All are
lazy DataFrames: nothing is read before an action.

Scale notes
* ``mov`` always needs lineitem JOIN orders (movement month and company come
  from the order).  That is a shuffle of both sides on the order key; on a
  cluster that reads these tables repeatedly, :func:`bucket_fixture` writes
  them bucketed by order key once and ``mov(..., bucketed=True)`` joins them
  without a shuffle.  The real microdata is a flat file, so production plans
  start after this join.
* customer/nation and part are joined only when a requested column needs
  them (the driver data keeps TPC-H foreign keys total, so the inner join
  never drops rows).  nation is 25 rows by definition and broadcast; the
  others are left to AQE, which broadcasts them only when their measured
  size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOV_COLUMNS = [
    "id", "competencia_mov", "competencia_dec", "tipo", "tipo_movimentacao", "saldo_movimentacao",
    "regiao", "uf", "cnpj", "cpf", "municipio", "secao", "subclasse", "idade",
    "horas_contratuais", "salario", "origem_informacao",
]
_GEO = {"regiao", "uf"}
_PART = {"secao", "subclasse", "idade"}

# Year shift that moves the fixture's order dates into the 2020s series.
YEAR_SHIFT = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; file splits and AQE decide the parallelism."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bucketed_name(sf_dir: str, name: str) -> str:
    import zlib
    return f"jobflow_{name}_b{zlib.crc32(sf_dir.rstrip('/').encode()):08x}"


def bucket_fixture(spark: SparkSession, sf_dir: str, n_buckets: int, root: str | None = None) -> None:
    """Write lineitem and orders bucketed and sorted by order key (same bucket count) to the shared
    folder and register them as session tables.  ``mov(..., bucketed=True)`` then joins them with
    a sort-merge join that needs no exchange on either side - worth it when the fixture is read
    repeatedly at scale.  Uses the session's in-memory catalog only (no metastore database)."""
    from jobflow.session import scratch_path
    if spark.conf.get("spark.sql.catalogImplementation", "in-memory") != "in-memory":
        raise RuntimeError("bucket_fixture registers tables in the in-memory catalog only")
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        path = root.rstrip("/") + f"/{name}" if root else scratch_path(spark, f"bucketed-{name}")
        (table(spark, sf_dir, name).write.bucketBy(n_buckets, key).sortBy(key)
         .option("path", path).mode("overwrite").saveAsTable(_bucketed_name(sf_dir, name)))


def _ym(ts):
    return F.year(ts) * 100 + F.month(ts)


def _shifted(ym, years: int):
    """A month of :func:`_ym` so many years later, as text."""
    return (ym + F.lit(years * 100)).cast("string")


def _yyyymm(ts, shift: int = 0):
    return _shifted(_ym(ts), shift)


def _code_from_modulo(key, codes: list[str], default: str):
    """codes[key % (n+1)] for remainders 0..n-1, ``default`` for remainder n."""
    m = key % (len(codes) + 1)
    expr = None
    for i, c in enumerate(codes):
        expr = F.when(m == i, F.lit(c)) if expr is None else expr.when(m == i, F.lit(c))
    return expr.otherwise(F.lit(default))


# fixed values: codes assigned by the fixture to finished (F) and open (O) line items
_FIXTURE_ADMISSION_CODES = ["10", "20", "25", "35", "70", "97"]   # plus 'XX' (unknown) for remainder 6
_FIXTURE_SEPARATION_CODES = ["31", "32", "33", "40", "43", "45", "50", "60", "80", "90"]  # remainder 10 -> '98'


def mov(spark: SparkSession, sf_dir: str, cols: list[str] | None = None, *, bucketed: bool = False,
        shuffled: bool = False) -> DataFrame:
    """Movement fact view (FIXTURES.md §3), restricted to ``cols``.

    ``bucketed=True`` reads the tables written by :func:`bucket_fixture`, so the
    lineitem-orders join is co-located (no shuffle).  ``shuffled=True`` joins them by a shuffle at any
    size: orders small enough to be broadcast don't change the plan.  What depends on one side alone is
    derived before the join, so the shuffle carries codes and months instead of keys and timestamps."""
    want = list(cols or MOV_COLUMNS)
    src = (lambda n: spark.table(_bucketed_name(sf_dir, n))) if bucketed else (lambda n: table(spark, sf_dir, n))
    finished = F.col("l_linestatus") == "F"
    li = src("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        (F.col("l_returnflag") == "R").alias("returned"), _ym("l_shipdate").alias("ship_ym"),
        F.when(finished, F.lit(1)).otherwise(F.lit(-1)).alias("sign"),
        F.when(finished, _code_from_modulo(F.col("l_partkey"), _FIXTURE_ADMISSION_CODES, "XX"))
        .otherwise(_code_from_modulo(F.col("l_suppkey"), _FIXTURE_SEPARATION_CODES, "98")).alias("code"))
    o = src("orders").select("o_orderkey", "o_custkey", _ym("o_orderdate").alias("order_ym"))
    df = li.join(o.hint("merge") if shuffled else o, li.l_orderkey == o.o_orderkey)
    if _GEO & set(want):
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
        # nation: 25 rows in every scale factor -> broadcast is size-bounded.
        df = df.join(c, df.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
    if _PART & set(want):
        p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
        df = df.join(p, df.l_partkey == p.p_partkey)

    exprs = {
        "id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "competencia_mov": _shifted(F.col("order_ym"), YEAR_SHIFT),
        "competencia_dec": _shifted(F.col("ship_ym"), YEAR_SHIFT),
        "tipo": (F.when(F.col("returned"), F.lit("EXC"))
                 .when(F.col("ship_ym") > F.col("order_ym"), F.lit("FOR")).otherwise(F.lit("MOV"))),
        "tipo_movimentacao": F.col("code"),
        "saldo_movimentacao": F.col("sign"),
        "regiao": F.col("n_regionkey") + 1,
        "uf": F.col("n_nationkey"),
        "cnpj": F.col("o_custkey"),
        "cpf": F.col("l_suppkey"),
        "municipio": F.col("o_custkey") % 97,
        "secao": F.col("p_type"),
        "subclasse": F.col("p_brand"),
        "idade": F.col("p_size"),
        "horas_contratuais": F.col("l_quantity"),
        "salario": F.col("l_extendedprice"),
        "origem_informacao": (F.col("o_custkey") + F.col("l_suppkey")) % 3 + 1,
    }
    return df.select(*[exprs[c].alias(c) for c in want])


ESTAB_COLUMNS = ["cnpj", "competencia", "uf", "secao", "admitidos", "desligados", "saldo"]


def estab(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """Establishment layout: one row per (company, month), restricted to ``cols``.

    ``saldo`` nets exclusions (sign-inverted) while ``admitidos``/``desligados``
    count raw rows, so the balance-formula checks see real inconsistencies.
    Place and sector need two more joins each, done only when asked for.
    """
    want = list(cols or ESTAB_COLUMNS)
    extra = [c for c in ("uf", "secao") if c in want]
    m = mov(spark, sf_dir, ["cnpj", "competencia_mov", "tipo", "saldo_movimentacao", *extra])
    s = F.col("saldo_movimentacao")
    return (m.groupBy(F.col("cnpj").cast("string").alias("cnpj"), F.col("competencia_mov").alias("competencia"))
            .agg(*[F.min(c).alias(c) for c in extra],
                 F.count_if(s == 1).alias("admitidos"),
                 F.count_if(s == -1).alias("desligados"),
                 F.sum(F.when(F.col("tipo") == "EXC", -s).otherwise(s)).cast("bigint").alias("saldo"))
            .select(*want))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed-file catalogue: one file per order.

    file_name = <type><YYYYMM>_<orderkey><ext>; type from the order status
    (F -> MOV, O -> FOR, P -> EXC); size and modification time from the order.
    """
    o = table(spark, sf_dir, "orders")
    comp = _yyyymm(F.col("o_orderdate"), YEAR_SHIFT)
    tipo = (F.when(F.col("o_orderstatus") == "F", "MOV").when(F.col("o_orderstatus") == "O", "FOR")
            .otherwise("EXC"))
    ext = F.when(F.col("o_orderkey") % 3 == 0, ".7z").when(F.col("o_orderkey") % 3 == 1, ".txt").otherwise(".parquet")
    return o.select(
        F.concat(tipo, comp, F.lit("_"), F.col("o_orderkey").cast("string"), ext).alias("file_name"),
        F.col("o_orderkey").alias("file_id"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size_bytes"),
        F.col("o_orderdate").alias("mtime"),
        (F.col("o_custkey") % 27).cast("int").alias("uf"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("processed"),
    )


def oplog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operation log: operation = event type, duration = value (s), success unless id % 5 = 0."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("op_id"),
        F.col("event_type").alias("operation"),
        ((F.col("event_id") % 5) != 0).alias("success"),
        F.col("value").alias("duration"),
        F.col("ts").alias("ts"),
        F.col("user_id").alias("item_id"),
        F.col("props").alias("details"),
    )
