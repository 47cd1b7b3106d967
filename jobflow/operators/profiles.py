"""Distinct counts that merge over months (E8), trends per segment (N5) and company profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobflow.functions.codes import ADMISSION, SEPARATION, direction
from jobflow.operators.analytics import month_index
from jobflow.operators.balance import signed_balance
from jobflow.session import scratch_path

# 2^14 registers: 12 KB a sketch, a relative standard error of 0.8 %
SKETCH_BITS = 14


def distinct_sketches(df: DataFrame, cols: list[str], *, month: str = "competencia_mov", bits: int = SKETCH_BITS) -> DataFrame:
    """One row per month with a mergeable sketch of the distinct values of each column (nulls and blank texts left out).

    The sketches are a few KB whatever the rows, so a stored table of them answers any range of months
    without reading the movements again; a late month only replaces its own row.
    """
    def value(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.when(F.length(F.trim(text)) > 0, text)
    return df.groupBy(F.col(month).cast("string").alias("competencia")).agg(
        *[F.hll_sketch_agg(value(c), F.lit(bits)).alias(c) for c in cols])


def distinct_over(sketches: DataFrame, cols: list[str], by: Column, name: str) -> DataFrame:
    """Long (``name``, coluna, distintos_estimados): the sketches of all months of a group ``by`` merged."""
    one = sketches.groupBy(by.alias(name)).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in cols])
    return one.unpivot([name], cols, "coluna", "distintos_estimados")


def segment_trend(df: DataFrame, segment: str, *, month: str = "competencia_mov", code: str = "tipo_movimentacao", tipo: str = "tipo",
                  saldo: str = "saldo_movimentacao", stable: float = 0.1) -> DataFrame:
    """Least-squares line through a segment's monthly balance: months, slope per month, level at its first month, r2, direction.

    Months collapse to one row by partial aggregation; the sums are whole numbers and are divided once, so
    the result does not depend on the partitioning.  A segment of one month has no slope; a constant one has r2 null.
    """
    d = direction(F.col(code))
    monthly = df.where(d.isNotNull()).groupBy(F.col(segment), month_index(F.col(month)).cast("bigint").alias("t")).agg(
        F.sum(signed_balance(F.col(tipo), F.col(saldo))).cast("bigint").alias("y")).where("t IS NOT NULL")
    first = monthly.groupBy(F.col(segment).alias("__s")).agg(F.min("t").alias("__t0"))
    x = monthly.join(first, F.col(segment).eqNullSafe(F.col("__s"))).select(segment, (F.col("t") - F.col("__t0")).alias("x"), "y")
    sums = {"n": F.count("*"), "sx": F.sum("x"), "sy": F.sum("y"), "sxy": F.sum(F.col("x") * F.col("y")),
            "sxx": F.sum(F.col("x") * F.col("x")), "syy": F.sum(F.col("y") * F.col("y"))}
    g = x.groupBy(segment).agg(*[v.alias(k) for k, v in sums.items()])
    c = {k: F.col(k).cast("double") for k in sums}
    cov, var_x, var_y = c["n"] * c["sxy"] - c["sx"] * c["sy"], c["n"] * c["sxx"] - c["sx"] * c["sx"], c["n"] * c["syy"] - c["sy"] * c["sy"]
    slope = F.when(var_x > 0, cov / var_x)
    out = g.select(segment, F.col("n").alias("meses"), slope.alias("__b"), ((c["sy"] - slope * c["sx"]) / c["n"]).alias("__a"),
                   F.when((var_x > 0) & (var_y > 0), cov * cov / (var_x * var_y)).alias("__r2"))
    way = F.when(F.col("__b") > stable, "alta").when(F.col("__b") < -stable, "queda").when(F.col("__b").isNotNull(), "estavel")
    return out.select(segment, "meses", F.round("__b", 6).alias("inclinacao"), F.round("__a", 6).alias("nivel_inicial"),
                      F.round("__r2", 6).alias("r2"), way.alias("tendencia"))


PROFILE_FEATURES = ["admissoes", "desligamentos", "meses_ativos", "salario_medio"]


def company_features(df: DataFrame, *, company: str = "cnpj", month: str = "competencia_mov", code: str = "tipo_movimentacao",
                     salary: str = "salario") -> DataFrame:
    """One row per company: hires, separations, active months, mean salary (whole cents divided once; none is 0)."""
    d = direction(F.col(code))
    cents = F.round(F.col(salary) * 100).cast("bigint")
    # first one row per company and month, so that months need no distinct of a whole company
    monthly = df.where(F.col(company).isNotNull()).groupBy(F.col(company), F.col(month)).agg(
        F.count_if(d == ADMISSION).alias("a"), F.count_if(d == SEPARATION).alias("d"), F.sum(cents).alias("c"), F.count(cents).alias("n"))
    return monthly.groupBy(company).agg(
        F.sum("a").cast("double").alias("admissoes"), F.sum("d").cast("double").alias("desligamentos"),
        F.count("*").cast("double").alias("meses_ativos"),
        F.coalesce(F.sum("c") / F.sum("n") / 100.0, F.lit(0.0)).alias("salario_medio"))


def company_profiles(features: DataFrame, k: int, *, columns: list[str] = PROFILE_FEATURES, seed: int = 42, rounds: int = 40) -> DataFrame:
    """``features`` with ``perfil``, the number of the nearest of ``k`` centres, 0 for the largest group.

    Features are centred and scaled to unit variance (a constant one counts nothing) and clustered by the
    distributed k-means of ``pyspark.ml``; the features are stored once, since every round reads them.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    spark = features.sparkSession
    path = scratch_path(spark, "profiles")
    features.write.parquet(path)
    stored = spark.read.parquet(path)
    steps = [VectorAssembler(inputCols=columns, outputCol="__v"), StandardScaler(inputCol="__v", outputCol="__z", withMean=True),
             KMeans(featuresCol="__z", predictionCol="__c", k=k, seed=seed, maxIter=rounds)]
    found = Pipeline(stages=steps).fit(stored).transform(stored).drop("__v", "__z")
    sizes = sorted(found.groupBy("__c").count().collect(), key=lambda r: (-r["count"], r["__c"]))  # k rows
    number = F.lit(None).cast("int")
    for n, r in enumerate(sizes):
        number = F.when(F.col("__c") == r["__c"], n).otherwise(number)
    return found.withColumn("perfil", number).drop("__c")
