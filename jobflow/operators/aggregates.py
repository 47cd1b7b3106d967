"""Company balances, indicators, profiles and distinct-based aggregates.

All of these are single hash aggregates with partial (map-side) aggregation;
many statistics over many columns are fused into ONE ``agg`` so the data is
scanned once, then reshaped to long form with ``unpivot``/``inline`` over the
single result row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobflow.operators.filters import valid_key
from jobflow.session import remove, scratch_path

GERAL = "GERAL"


# --- E4 / E5 -------------------------------------------------------------------------

def company_balance(df: DataFrame, *, by=("cnpj", "competencia"), company: str = "cnpj",
                    admitted: str = "admitidos", separated: str = "desligados", saldo: str = "saldo") -> DataFrame:
    """Sums of admitted / separated / balance per company (valid ids only)."""
    return (valid_key(df, company).groupBy(*by)
            .agg(F.sum(admitted).cast("bigint").alias("admissoes"),
                 F.sum(separated).cast("bigint").alias("desligamentos"),
                 F.sum(saldo).cast("bigint").alias("saldo")))


def company_balance_with_total(df: DataFrame, *, company: str = "cnpj", admitted: str = "admitidos",
                               separated: str = "desligados", saldo: str = "saldo") -> DataFrame:
    """E5: company rows plus one grand-total row labelled GERAL (ROLLUP + grouping())."""
    return (valid_key(df, company).rollup(company)
            .agg(F.sum(admitted).cast("bigint").alias("admissoes"),
                 F.sum(separated).cast("bigint").alias("desligamentos"),
                 F.sum(saldo).cast("bigint").alias("saldo"),
                 F.grouping(company).alias("_g"))
            .select(F.when(F.col("_g") == 1, F.lit(GERAL)).otherwise(F.col(company).cast("string")).alias(company),
                    "admissoes", "desligamentos", "saldo"))


# --- E6-E9 -----------------------------------------------------------------------------

def _n_unique_with_null(c: Column, approx: bool = False) -> Column:
    """Distinct count where null counts as one value (Polars n_unique semantics).

    approx=True uses HyperLogLog++ (``approx_count_distinct``): fixed-size
    buffers and no Expand of the input, for very large inputs where an exact
    count is not required.
    """
    n = F.approx_count_distinct(c) if approx else F.count_distinct(c)
    return n + F.max(F.when(c.isNull(), 1).otherwise(0))


def indicators(df: DataFrame, *, by=("competencia",), admitted: str = "admitidos", separated: str = "desligados",
               saldo: str = "saldo", uf: str | None = "uf", cnae: str | None = "secao",
               company: str | None = "cnpj", approx: bool = False) -> DataFrame:
    """E6-E8 in one aggregate, wide: one row per group with every indicator as a double.

    Ratios are null when undefined (zero denominator) and rounded to 6 places.
    """
    a, d = F.col("total_admitidos"), F.col("total_desligados")
    n = F.col("total_registros")
    aggs = [F.sum(admitted).cast("double").alias("total_admitidos"),
            F.sum(separated).cast("double").alias("total_desligados"),
            F.sum(saldo).cast("double").alias("total_saldo"),
            F.count(F.lit(1)).cast("double").alias("total_registros")]
    if uf:
        aggs.append(_n_unique_with_null(F.col(uf), approx).cast("double").alias("total_ufs_distintas"))
    if cnae:
        aggs.append(_n_unique_with_null(F.col(cnae), approx).cast("double").alias("total_cnaes_distintas"))
    if company:
        ok = F.col(company).isNotNull() & (F.length(F.col(company).cast("string")) > 0)
        cnt = F.approx_count_distinct if approx else F.count_distinct
        aggs.append(cnt(F.when(ok, F.col(company))).cast("double").alias("total_cnpjs_distintos"))
    out = df.groupBy(*by).agg(*aggs)
    r6 = lambda e: F.round(e, 6)
    out = out.withColumns({
        "saldo_liquido_calculado": a - d,
        "taxa_rotatividade": r6(F.when(((a + d) > 0) & (n > 0), (a + d) / 2 / n * 100)),
        "taxa_crescimento_liquido": r6(F.when(n > 0, (a - d) / n * 100)),
        "razao_admissao_desligamento": r6(F.when(d > 0, a / d)),
        "densidade_movimentacao": r6(F.when(n > 0, (a + d) / n)),
    })
    if company:
        c = F.col("total_cnpjs_distintos")
        out = out.withColumn("media_movimentacoes_por_cnpj", r6(F.when(c > 0, n / c)))
    return out


BASIC = ["total_admitidos", "total_desligados", "total_saldo", "total_registros", "saldo_liquido_calculado"]
ADVANCED = ["taxa_rotatividade", "taxa_crescimento_liquido", "razao_admissao_desligamento", "densidade_movimentacao"]
SEGMENT = ["total_ufs_distintas", "total_cnaes_distintas", "total_cnpjs_distintos", "media_movimentacoes_por_cnpj"]


def indicators_long(wide: DataFrame, *, by=("competencia",), names: list[str] | None = None) -> DataFrame:
    """Long (group..., indicador, valor) keeping only finite values."""
    names = [c for c in (names or BASIC + ADVANCED + SEGMENT) if c in wide.columns]
    long = wide.unpivot(list(by), names, "indicador", "valor")
    v = F.col("valor")
    return long.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


# --- E15-E17: profiles --------------------------------------------------------------------

def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(coluna, nulos, total, pct_nulos) for every column, from one aggregate."""
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.count_if(F.col(c).isNull()).alias(f"__null_{i}")
                                                for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(f"__null_{i}").alias("nulos"))
                     for i, c in enumerate(cols)])
    return (one.select(F.col("__n").alias("total"), F.inline(rows))
            .select("coluna", "nulos", "total",
                    F.round(F.when(F.col("total") > 0, F.col("nulos") / F.col("total") * 100.0).otherwise(0.0), 6)
                    .alias("pct_nulos")))


def exact_quantiles(df: DataFrame, cols: list[str], probs=(0.25, 0.75)) -> dict[str, list[float | None]]:
    """Exact quantiles (linear interpolation, equal to SQL quantile_cont) without a single-task buffer.

    Values are counted per column (map-side combine), range-partitioned by column and value and written
    to the shared folder with their partition number.  The driver gets one total per column and
    partition; only the partitions that hold a wanted rank are read again, each summed on its own.
    """
    spark = df.sparkSession
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
    counts = df.select(F.inline(pairs)).where("v IS NOT NULL").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "quantiles")
    counts.repartitionByRange("c", "v").withColumn("p", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    totals: dict[int, list[tuple[int, int]]] = {i: [] for i in range(len(cols))}
    for r in ranged.groupBy("c", "p").agg(F.sum("n").alias("n")).orderBy("c", "p").collect():
        totals[r["c"]].append((r["p"], r["n"]))
    places: dict[int, list[tuple[int, int, float]]] = {}
    wanted: dict[tuple[int, int], set[int]] = {}    # (column, partition) -> ranks within it
    local: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i, parts in totals.items():
        n = sum(k for _, k in parts)
        for q in probs if n else ():
            at = q * (n - 1)
            low, high = int(at), min(int(at) + 1, n - 1)
            places.setdefault(i, []).append((low, high, at - low))
            for rank in (low, high):
                before = 0
                for p, k in parts:
                    if rank < before + k:
                        wanted.setdefault((i, p), set()).add(rank - before)
                        local[i, rank] = (i, p, rank - before)
                        break
                    before += k
    if not wanted:
        remove(spark, path)
        return {c: [None] * len(probs) for c in cols}
    pick = reduce(or_, [(F.col("c") == i) & (F.col("p") == p) for i, p in wanted])
    upto = F.sum("n").over(Window.partitionBy("c", "p").orderBy("v"))
    hit = reduce(or_, [(F.col("c") == i) & (F.col("p") == p) & (F.col("e") > k) & (F.col("e") - F.col("n") <= k)
                       for (i, p), ks in wanted.items() for k in ks])
    found = {}
    for r in ranged.where(pick).withColumn("e", upto).where(hit).collect():
        for k in wanted[r["c"], r["p"]]:
            if r["e"] - r["n"] <= k < r["e"]:
                found[r["c"], r["p"], k] = r["v"]
    out = {}
    for i, c in enumerate(cols):
        ends = [(found[local[i, lo]], found[local[i, hi]], part) for lo, hi, part in places.get(i, [])]
        out[c] = [lo + (hi - lo) * part for lo, hi, part in ends] or [None] * len(probs)
    remove(spark, path)
    return out


def iqr_fences(df: DataFrame, cols: list[str], *, exact: bool = True, accuracy: int = 10000) -> dict[str, tuple]:
    """(q1, q3, lower, upper 1.5-IQR fence) per column, a few numbers; None where a column has no value.

    exact=False uses ``percentile_approx`` (one pass, bounded memory).
    """
    if exact:
        quartiles = exact_quantiles(df, cols)
    else:
        one = df.agg(*[F.percentile_approx(F.col(c).cast("double"), F.array(F.lit(0.25), F.lit(0.75)), accuracy).alias(f"q_{i}")
                       for i, c in enumerate(cols)]).first()
        quartiles = {c: list(one[f"q_{i}"] or (None, None)) for i, c in enumerate(cols)}
    return {c: (q1, q3, None, None) if q1 is None else (q1, q3, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
            for c, (q1, q3) in quartiles.items()}


def outside(col: str, fence: tuple) -> Column:
    """Whether a value lies beyond its fences."""
    return F.lit(False) if fence[2] is None else (F.col(col) < F.lit(fence[2])) | (F.col(col) > F.lit(fence[3]))


def iqr_outliers(df: DataFrame, cols: list[str], *, exact: bool = True) -> DataFrame:
    """Quartiles, fences and outlier count per column: the fences, then one fused counting pass."""
    fences = iqr_fences(df, cols, exact=exact)
    aggs = [F.count(F.lit(1)).alias("total")] + [F.count_if(outside(c, fences[c])).alias(f"o_{i}") for i, c in enumerate(cols)]
    rows = F.array(*[F.struct(F.lit(c).alias("coluna"), F.lit(fences[c][0]).cast("double").alias("q1"),
                              F.lit(fences[c][1]).cast("double").alias("q3"), F.col(f"o_{i}").alias("outliers"))
                     for i, c in enumerate(cols)])
    out = df.agg(*aggs).select("total", F.inline(rows))
    return (out.withColumn("iqr", F.col("q3") - F.col("q1"))
            .withColumn("limite_inferior", F.col("q1") - 1.5 * F.col("iqr"))
            .withColumn("limite_superior", F.col("q3") + 1.5 * F.col("iqr"))
            .withColumn("pct_outliers", F.round(F.col("outliers") / F.col("total") * 100.0, 6)))


def checksum(df: DataFrame) -> DataFrame:
    """Order-independent dataset checksum: columns, type signature, rows, row-hash sum, nulls.

    A row is hashed as text in which a null differs from any value; each cell begins with its length, so columns
    cannot run together whatever they hold.
    """
    cols = df.columns
    texts = [F.col(c).cast("string") for c in cols]
    cells = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit("="), t), F.lit("~")) for t in texts]
    sixty_bits = F.conv(F.substring(F.md5(F.concat(*cells)), 1, 15), 16, 10).cast("decimal(38,0)")
    sig = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name))
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in cols], F.lit(0).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("linhas"), F.coalesce(F.sum(sixty_bits), F.lit(0)).cast("string").alias("hash_linhas"),
                  F.coalesce(F.sum(nulls), F.lit(0).cast("long")).alias("nulos")).select(
        F.lit(len(cols)).alias("colunas"), F.sha2(F.lit(sig), 256).alias("assinatura_tipos"), "linhas", "hash_linhas", "nulos")


# --- H3-H5 -----------------------------------------------------------------------------------

def duplicate_rows(df: DataFrame) -> DataFrame:
    """H3: total rows, distinct rows, duplicate rows, exact.

    One aggregate on all columns: copies shrink to one row per task before the shuffle, so a row that is a
    third of the table does not meet in one task, and the input is computed once.
    """
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    both = g.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("total_linhas"), F.count(F.lit(1)).alias("linhas_distintas"))
    return both.select("total_linhas", "linhas_distintas",
                       (F.col("total_linhas") - F.col("linhas_distintas")).alias("linhas_duplicadas"))


def duplicates_and_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """H3 and H4 together, exact: total_linhas, linhas_distintas and linhas_duplicadas, chaves_distintas, chaves_duplicadas.

    One pass counts rows by their keys and a 64-bit hash of all columns, so narrow rows are shuffled, not whole ones.  Only rows whose
    keys and hash repeat are compared as whole rows (a second read, of nothing where no row repeats); two
    different rows of equal keys and hash are told apart there.
    """
    spark = df.sparkSession
    names = [f"__k{i}" for i in range(len(keys))]
    mark = F.xxhash64(*df.columns).alias("__h")
    path = scratch_path(spark, "row-marks")
    df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], mark).groupBy(*names, "__h").agg(F.count("*").alias("__n")).write.parquet(path)
    marks = spark.read.parquet(path)
    total = marks.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("total"), F.count("*").alias("marks"), F.count_if(F.col("__n") > 1).alias("repeated"))
    per_key = marks.groupBy(*names).agg(F.sum("__n").alias("__n")).agg(
        F.count("*").alias("chaves_distintas"), F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("chaves_duplicadas"))
    t, k = total.first(), per_key.first()  # one row each
    distinct = t["marks"]
    if t["repeated"]:
        twice = marks.where(F.col("__n") > 1).select(F.struct("__h", *names).alias("__m"))
        own = F.struct(mark, *[F.col(k).alias(n) for k, n in zip(keys, names)])
        rows = df.withColumn("__own", own).join(twice, F.col("__own") == F.col("__m"), "left_semi").drop("__own")
        distinct += rows.groupBy(*df.columns).agg(F.count("*").alias("__n")).count() - t["repeated"]
    return spark.range(1).select(F.lit(t["total"]).cast("bigint").alias("total_linhas"), F.lit(distinct).cast("bigint").alias("linhas_distintas"),
                                 F.lit(t["total"] - distinct).cast("bigint").alias("linhas_duplicadas"),
                                 F.lit(k["chaves_distintas"]).cast("bigint").alias("chaves_distintas"),
                                 F.lit(k["chaves_duplicadas"]).cast("bigint").alias("chaves_duplicadas"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """H4: rows, distinct keys, rows beyond the first per key, keys that repeat."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.sum("__n").cast("bigint").alias("total_linhas"),
                 F.count(F.lit(1)).alias("chaves_distintas"),
                 F.sum(F.col("__n") - 1).cast("bigint").alias("linhas_duplicadas"),
                 F.count_if(F.col("__n") > 1).alias("chaves_repetidas"))


def dedupe_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """H4 (rows): one row per key (arbitrary representative, as ``dropDuplicates``)."""
    return df.dropDuplicates(keys)


def periods(df: DataFrame, col: str = "competencia_mov") -> DataFrame:
    """H5: distinct months (sorting is left to the consumer; the set is tiny)."""
    return df.select(F.col(col).cast("string").alias("competencia")).distinct()
