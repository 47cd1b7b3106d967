"""Data-quality checks (family J), fused.

Every row-level check is a pair of predicates (eligible, bad).  ``run_checks``
turns N checks into ONE aggregate with 2N ``count_if`` expressions, so the
whole battery costs one scan and one tiny shuffle (partial counts per task),
whatever N is; completeness and outlier checks are row checks too.  Checks
that need grouping (duplicates, duplicate keys, per-month consistency) are
separate aggregates that produce the same report schema and are unioned:

    check_name, column_name, bad_rows, total_rows, pct, tolerance, status

``status`` is 'ok' when pct <= tolerance, else 'falha'.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobflow.functions.clean import norm_period
from jobflow.functions.codes import OFFICIAL_ADMISSION_CODES, OFFICIAL_SEPARATION_CODES, direction
from jobflow.operators import aggregates as A
from jobflow.session import ensure_checkpoint_dir, remove, scratch_path, side_session

# fixed values: tolerances (%) and patterns of the validation rules
BALANCE_TOLERANCE = 5.0
REFERENTIAL_TOLERANCE = 2.0
COMPLETENESS_LIMIT = 50.0
OUTLIER_LIMIT = 5.0
ENTITY_NULL_LIMIT = 80.0
PERIOD_PATTERN = r"^\d{4}-\d{2}$|^\d{6}$|^\d{4}/\d{2}$"
CBO_PATTERN = r"^\d{6}$"
PERIOD_MIN = "2020-01"
MOVEMENT_DOMAIN = OFFICIAL_ADMISSION_CODES + OFFICIAL_SEPARATION_CODES + ["99"]
ENTITY_TYPE_SHORT_LIST = ["1", "2", "ADMISSAO", "ADMISSÃO", "DESLIGAMENTO", "DEMISSAO", "DEMISSÃO"]
EXCLUSION_MARKERS = ["99", "EXC", "EXCLUSAO"]
ESSENTIAL_GROUPS = {
    "competencia": ["COMPETENCIA_MOV", "COMPETENCIA", "COMP", "ANO_MES", "PERIODO"],
    "municipio": ["MUNICIPIO", "MUNIC", "CIDADE"],
    "tipo_movimentacao": ["TIPO_MOVIMENTACAO", "TIPOMOVIMENTACAO", "TIPO_MOV", "MOVIMENTACAO"],
    "saldo_movimentacao": ["SALDO_MOVIMENTACAO", "SALDOMOVIMENTACAO", "SALDO", "VARIACAO"],
}

REPORT_COLUMNS = ["check_name", "column_name", "bad_rows", "total_rows", "pct", "tolerance", "status"]


@dataclass
class Check:
    name: str
    column: str
    bad: Column
    eligible: Column | None = None
    tolerance: float = 0.0


def _finish(df: DataFrame) -> DataFrame:
    """Add pct and status to (check_name, column_name, bad_rows, total_rows, tolerance)."""
    pct = F.round(F.when(F.col("total_rows") > 0, F.col("bad_rows") / F.col("total_rows") * 100.0)
                  .otherwise(F.lit(0.0)), 6)
    return (df.withColumn("pct", pct)
            .withColumn("status", F.when(F.col("pct") <= F.col("tolerance"), F.lit("ok")).otherwise(F.lit("falha")))
            .select(*REPORT_COLUMNS))


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level checks in one aggregate, reshaped to one report row per check."""
    aggs = []
    for i, c in enumerate(checks):
        elig = c.eligible if c.eligible is not None else F.lit(True)
        aggs += [F.count_if(elig).alias(f"t{i}"), F.count_if(elig & F.coalesce(c.bad, F.lit(False))).alias(f"b{i}")]
    rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                              F.col(f"b{i}").cast("bigint").alias("bad_rows"),
                              F.col(f"t{i}").cast("bigint").alias("total_rows"),
                              F.lit(float(c.tolerance)).alias("tolerance"))
                     for i, c in enumerate(checks)])
    return _finish(df.agg(*aggs).select(F.inline(rows)))


# --- row-level check builders --------------------------------------------------------------

def _nn(c: str) -> Column:
    return F.col(c).isNotNull()


def balance_formula(a="admitidos", d="desligados", s="saldo", tol=BALANCE_TOLERANCE) -> Check:
    """saldo = admitidos - desligados on rows with all three present."""
    return Check("saldo_formula", s, F.col(s) != F.col(a) - F.col(d), _nn(a) & _nn(d) & _nn(s), tol)


def period_format(col="periodo") -> Check:
    """J2."""
    return Check("formato_periodo", col, ~F.col(col).rlike(PERIOD_PATTERN), _nn(col))


def _ym(d: _dt.date, sep: str = "") -> str:
    return f"{d.year:04d}{sep}{d.month:02d}"


def period_range(col="periodo", *, as_of: _dt.date, minimum=PERIOD_MIN) -> Check:
    """Normalised period within [minimum, month of as_of]."""
    n = norm_period(F.col(col))
    return Check("intervalo_periodo", col, (n < minimum) | (n > _ym(as_of, "-")), _nn(col))


def domain(col: str, values, name: str | None = None) -> Check:
    """J5 (and J21): non-null value outside the domain."""
    return Check(name or f"dominio_{col}", col, ~F.col(col).isin(list(values)), _nn(col))


def castable(col: str, to: str = "double") -> Check:
    """Non-null value that does not cast."""
    return Check("tipo_numerico", col, F.col(col).try_cast(to).isNull(), _nn(col))


def uf_municipality(uf="uf", mun="municipio", tol=REFERENTIAL_TOLERANCE) -> list[Check]:
    """Municipality without UF, UF without municipality."""
    return [Check("municipio_sem_uf", mun, F.col(uf).isNull() & _nn(mun), None, tol),
            Check("uf_sem_municipio", uf, _nn(uf) & F.col(mun).isNull(), None, tol)]


def cnae_prefix(classe="classe", sub="subclasse_cnae", tol=REFERENTIAL_TOLERANCE) -> Check:
    """Sub-class must start with its class."""
    return Check("cnae_hierarquia", sub, ~F.col(sub).startswith(F.col(classe)), _nn(classe) & _nn(sub), tol)


def cnae_length(col: str, n: int, tol=REFERENTIAL_TOLERANCE) -> Check:
    """Class has 5 digits, sub-class 7."""
    return Check("cnae_tamanho", col, F.length(F.col(col)) != n, _nn(col), tol)


def cbo(col="cbo", tol=REFERENTIAL_TOLERANCE) -> Check:
    """Occupation code has 6 digits."""
    return Check("cbo_formato", col, ~F.col(col).rlike(CBO_PATTERN), _nn(col), tol)


def future(col="competencia_dec", *, as_of: _dt.date) -> Check:
    """Month after the as-of month."""
    return Check("competencia_futura", col, F.col(col) > _ym(as_of), _nn(col))


def bad_exclusions(tipo="tipo", code="tipo_movimentacao", saldo="saldo_movimentacao") -> Check:
    """Exclusion rows with a positive balance."""
    exc = (F.col(tipo) == "EXC") | F.col(code).isin(EXCLUSION_MARKERS)
    return Check("exclusao_positiva", saldo, exc & (F.col(saldo) > 0), None)


def late_window_limits(as_of: _dt.date) -> tuple[str, str]:
    return _ym(as_of - _dt.timedelta(days=180)), _ym(as_of + _dt.timedelta(days=30))


def late_window(col="competencia_mov", *, as_of: _dt.date) -> Check:
    """Month older than as_of-180 days or later than as_of+30 days."""
    lo, hi = late_window_limits(as_of)
    return Check("fora_janela_declaracao", col, (F.col(col) < lo) | (F.col(col) > hi), _nn(col))


def negatives(col: str) -> Check:
    """J20 (per-column opt-in).  The value is cast leniently, so a text column works and
    non-numeric text is simply not negative."""
    return Check("valores_negativos", col, F.col(col).try_cast("double") < 0, _nn(col))


def entity_type(code="tipo_movimentacao") -> Check:
    """J22 (type part): entity movement type outside the short list."""
    return Check("tipo_entidade", code, ~F.col(code).cast("string").isin(ENTITY_TYPE_SHORT_LIST), _nn(code))


def entity_nulls(col: str) -> Check:
    """J22 (null part): identifier more than 80 % null."""
    return Check("entidade_nulos", col, F.col(col).isNull(), None, ENTITY_NULL_LIMIT)


def entity_valid(id_col="id", month="competencia_mov", code="tipo_movimentacao") -> Check:
    """Id > 0, month set, movement maps to admission/separation."""
    ok = (F.col(id_col) > 0) & (F.length(F.col(month)) > 0) & direction(F.col(code)).isNotNull()
    return Check("entidade_valida", id_col, ~F.coalesce(ok, F.lit(False)), None)


def balance_row_valid(a="admitidos", d="desligados", s="saldo") -> Check:
    """|A - D - S| <= 1 and A, D >= 0."""
    bad = (F.abs(F.col(a) - F.col(d) - F.col(s)) > 1) | (F.col(a) < 0) | (F.col(d) < 0)
    return Check("saldo_registro_valido", s, bad, None)


def month_in_range(col: str) -> Check:
    """J25 (month part): month number 1-12."""
    m = F.col(col).try_cast("int")
    return Check("mes_valido", col, m.isNull() | ~m.between(1, 12), _nn(col))


# --- aggregate checks (same report schema) ------------------------------------------------

def _rows(df: DataFrame, name: str, column: str, bad: Column, total: Column, tol: float) -> DataFrame:
    return _finish(df.select(F.lit(name).alias("check_name"), F.lit(column).alias("column_name"),
                             bad.cast("bigint").alias("bad_rows"), total.cast("bigint").alias("total_rows"),
                             F.lit(float(tol)).alias("tolerance")))


def completeness(df: DataFrame, cols: list[str] | None = None, tol=COMPLETENESS_LIMIT) -> DataFrame:
    """Null share per column against the 50 % limit (one aggregate via E15)."""
    p = A.null_profile(df, cols)
    return _finish(p.select(F.lit("completude").alias("check_name"), F.col("coluna").alias("column_name"),
                            F.col("nulos").cast("bigint").alias("bad_rows"), F.col("total").cast("bigint").alias("total_rows"),
                            F.lit(float(tol)).alias("tolerance")))


def duplicates(df: DataFrame, tol=0.0) -> DataFrame:
    """Full-row duplicates."""
    d = A.duplicate_rows(df)
    return _rows(d, "duplicatas", "*", F.col("linhas_duplicadas"), F.col("total_linhas"), tol)


def duplicate_key_check(df: DataFrame, keys: list[str], tol=0.0) -> DataFrame:
    """Duplicate (company, person, month) keys; needs at least 2 key columns present."""
    keys = [k for k in keys if k in df.columns]
    if len(keys) < 2:
        raise ValueError("duplicate key check needs at least two of the key columns")
    d = A.duplicate_keys(df, keys)
    return _rows(d, "chaves_duplicadas", ",".join(keys), F.col("linhas_duplicadas"), F.col("total_linhas"), tol)


def outlier_share(df: DataFrame, cols: list[str], tol=OUTLIER_LIMIT) -> DataFrame:
    """Share of IQR outliers per column against 5 %."""
    o = A.iqr_outliers(df, cols)
    return _finish(o.select(F.lit("outliers").alias("check_name"), F.col("coluna").alias("column_name"),
                            F.col("outliers").cast("bigint").alias("bad_rows"), F.col("total").cast("bigint").alias("total_rows"),
                            F.lit(float(tol)).alias("tolerance")))


def monthly_consistency(df: DataFrame, *, month="competencia", a="admitidos", d="desligados", s="saldo",
                        tol=0.0) -> DataFrame:
    """Months whose total balance differs from total admitted - separated."""
    g = df.groupBy(month).agg(F.sum(a).alias("_a"), F.sum(d).alias("_d"), F.sum(s).alias("_s"))
    c = g.agg(F.count_if(F.col("_s") != F.col("_a") - F.col("_d")).alias("bad"), F.count(F.lit(1)).alias("n"))
    return _rows(c, "consistencia_mensal", s, F.col("bad"), F.col("n"), tol)


def _schema_rows(df: DataFrame) -> list[tuple[str, str, int, int]]:
    """Schema-only rows of J10 with B6 (invalid names) and B7 (essential-field coverage)."""
    from jobflow.functions.names import field_coverage, invalid_names
    cov = field_coverage(df.columns, ESSENTIAL_GROUPS)
    rows = [("campo_essencial", g, 0 if ok else 1, 1) for g, ok in cov]
    rows.append(("colunas_minimas", "*", 1 if len(df.columns) < 5 else 0, 1))
    rows.append(("nomes_invalidos", "*", len(invalid_names(df.columns)), len(df.columns)))
    rows.append(("cobertura_essencial", "*", sum(1 for _, ok in cov if not ok), len(cov)))
    return rows


def structure(df: DataFrame) -> DataFrame:
    """J10 (+B6, B7): essential field groups present, >= 5 columns, valid names, non-empty.

    Column checks are schema metadata (no data read); emptiness is one count,
    and all rows come from that single one-row aggregate.
    """
    return structure_rows(df, df.agg(F.count(F.lit(1)).alias("__n")))


def union_reports(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_overall(report: DataFrame) -> DataFrame:
    """Append one 'geral' row: bad = failing checks, status ok only if none fails."""
    g = report.agg(F.count_if(F.col("status") == "falha").alias("bad"), F.count(F.lit(1)).alias("n"))
    return report.unionByName(_rows(g, "geral", "*", F.col("bad"), F.col("n"), 0.0))


def quarantine(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Every row with ``valido`` and the comma-joined names of the checks it fails.

    Split with ``where('valido')`` / ``where('not valido')``; one pass, no join.
    """
    reasons = F.array_compact(F.array(*[
        F.when((c.eligible if c.eligible is not None else F.lit(True)) & F.coalesce(c.bad, F.lit(False)),
               F.lit(f"{c.name}:{c.column}")) for c in checks]))
    return df.withColumn("motivos", F.concat_ws(",", reasons)).withColumn("valido", F.col("motivos") == "")


def outlier_checks(df: DataFrame, cols: list[str], tol=OUTLIER_LIMIT, *, exact: bool = True) -> list[Check]:
    """J9 as row checks: fences first (a few numbers to the driver),
    then 'value outside the fences' joins the fused battery."""
    fences = A.iqr_fences(df, cols, exact=exact)
    return [Check("outliers", c, A.outside(c, fences[c]), None, tol) for c in cols]


def completeness_checks(cols: list[str], tol=COMPLETENESS_LIMIT) -> list[Check]:
    """J6 as row checks (null share per column)."""
    return [Check("completude", c, F.col(c).isNull(), None, tol) for c in cols]


def structure_rows(df: DataFrame, counted: DataFrame) -> DataFrame:
    """J10 from schema metadata plus the row count already computed by the fused aggregate."""
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(c).alias("column_name"),
                              F.lit(b).cast("bigint").alias("bad_rows"), F.lit(t).cast("bigint").alias("total_rows"))
                     for n, c, b, t in _schema_rows(df)],
                   F.struct(F.lit("nao_vazio").alias("check_name"), F.lit("*").alias("column_name"),
                            F.when(F.col("__n") == 0, 1).otherwise(0).cast("bigint").alias("bad_rows"),
                            F.lit(1).cast("bigint").alias("total_rows")))
    return _finish(counted.select(F.inline(rows)).withColumn("tolerance", F.lit(0.0)))


class QualityReport:
    """Runs a check battery on one frame with a fixed number of passes, whatever the number of checks:

    1. exact quartiles from value counts (only when outlier columns are given),
    2. ONE fused aggregate for every row-level, completeness and outlier check,
       which also yields the row count used by the structure check,
    3. one pass of narrow rows for duplicate rows and duplicate keys.
    The small intermediate results (one row; the ~40-row report) are
    checkpointed to the shared checkpoint folder, so deriving several report
    rows and the overall 'geral' row from them never re-runs a scan.
    """

    def __init__(self, df: DataFrame, checks: list[Check], *, completeness_cols=(), outlier_cols=(),
                 duplicate_keys=None, structure: bool = False, extra: list[DataFrame] | None = None,
                 materialize: bool = False):
        self.df, self.checks, self.extra = df, list(checks), extra or []
        self.materialize = materialize
        self.completeness_cols, self.outlier_cols = list(completeness_cols), list(outlier_cols)
        self.duplicate_keys, self.structure = duplicate_keys, structure

    def run(self) -> DataFrame:
        df, path = self.df, None
        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        if self.materialize:
            # The input is an expensive derived frame (joins): write it once as Parquet to the
            # shared checkpoint folder and run the three passes over that table instead of
            # recomputing the joins three times.  Not needed when the input is already a table.
            path = scratch_path(spark, "quality-input")
            df.write.parquet(path)
            df = spark.read.schema(df.schema).parquet(path)
        checks = self.checks + completeness_checks(self.completeness_cols)
        if self.outlier_cols:
            checks += outlier_checks(df, self.outlier_cols)
        aggs = [F.count(F.lit(1)).alias("__n")]
        for i, c in enumerate(checks):
            elig = c.eligible if c.eligible is not None else F.lit(True)
            aggs += [F.count_if(elig).alias(f"t{i}"), F.count_if(elig & F.coalesce(c.bad, F.lit(False))).alias(f"b{i}")]
        # one row; checkpointed (shared checkpoint folder) so the rows derived from it
        # below do not re-run the scan.  Dozens of conditional counts fused with the
        # scan generate a method above the JVM's 8 KB JIT limit; over a stored table
        # a session of its own is told to fall back to non-fused code, which the JIT compiles.
        if path is None:
            counted = df.agg(*aggs).checkpoint(eager=True)
        else:
            one = scratch_path(spark, "quality-counts")
            side = side_session(spark, spark__sql__codegen__hugeMethodLimit="8000")
            side.read.schema(df.schema).parquet(path).agg(*aggs).write.parquet(one)
            counted = spark.read.parquet(one)
        rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                                  F.col(f"b{i}").cast("bigint").alias("bad_rows"),
                                  F.col(f"t{i}").cast("bigint").alias("total_rows"),
                                  F.lit(float(c.tolerance)).alias("tolerance")) for i, c in enumerate(checks)])
        parts = [_finish(counted.select(F.inline(rows)))]
        if self.structure:
            parts.append(structure_rows(df, counted))
        if self.duplicate_keys is not None:
            keys = [k for k in self.duplicate_keys if k in df.columns]
            if len(keys) < 2:
                raise ValueError("duplicate key check needs at least two of the key columns")
            d = A.duplicates_and_keys(df, keys)
            parts.append(_rows(d, "duplicatas", "*", F.col("linhas_duplicadas"), F.col("total_linhas"), 0.0))
            parts.append(_rows(d, "chaves_duplicadas", ",".join(keys), F.col("chaves_duplicadas"), F.col("total_linhas"), 0.0))
        report = union_reports(parts + self.extra).checkpoint(eager=True)
        if path is not None:
            remove(spark, path)
        return with_overall(report)
