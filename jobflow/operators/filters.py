"""Domain filters (family C) and the fused filter-chain report.

Predicates are written against raw columns so Catalyst can push them into
the Parquet scan: period bounds compare the fixed-width ``YYYYMM`` text to
literals (no cast, no function on the column), year lists become OR-ed
ranges, and code lists become ``IN`` sets.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _any(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds)


def _all(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)


def _require(df: DataFrame, col: str) -> None:
    if col not in df.columns:
        raise KeyError(f"column {col!r} not in {df.columns}")


# --- C1 / C2 / C15: industry -------------------------------------------------

def filter_cnae(df: DataFrame, codes, *, col: str = "subclasse") -> DataFrame:
    """Keep rows whose industry code is in ``codes``; an empty list means no filter."""
    codes = list(codes or [])
    if not codes:
        return df
    _require(df, col)
    return df.where(F.col(col).isin(codes))


def cnae_codes(cnae: DataFrame, *, situacao=1, code_col: str = "classe_cnae",
               status_col: str = "situacao") -> DataFrame:
    """A17 (selection part): distinct codes of the classification with the wanted status."""
    return cnae.where(F.col(status_col) == situacao).select(F.col(code_col).alias("code")).distinct()


def filter_cnae_table(df: DataFrame, cnae: DataFrame, *, col: str = "subclasse", situacao=1,
                      code_col: str = "classe_cnae", status_col: str = "situacao") -> DataFrame:
    """Left-semi join to the selected classification codes.

    No broadcast hint: the planner broadcasts the code set when its measured
    size is below ``spark.sql.autoBroadcastJoinThreshold`` and falls back to
    a shuffle join otherwise.
    """
    codes = cnae_codes(cnae, situacao=situacao, code_col=code_col, status_col=status_col)
    return df.join(codes, df[col] == codes["code"], "left_semi")


def cnae_stats(cnae: DataFrame, *, situacao=1, status_col: str = "situacao") -> DataFrame:
    """Classification total, selected, % selected."""
    sel = F.count_if(F.col(status_col) == situacao)
    return cnae.agg(F.count(F.lit(1)).alias("total"), sel.alias("selecionados"),
                    F.round(sel / F.count(F.lit(1)) * 100.0, 6).alias("pct_selecionados"))


# --- C3-C5: period ---------------------------------------------------------------

def _month_text(d: _dt.date) -> str:
    return f"{d.year:04d}{d.month:02d}"


def period_predicate(*, years=None, months=None, start: str | None = None, end: str | None = None,
                     col: str = "competencia_mov") -> Column | None:
    """Predicate on a ``YYYYMM`` text column.

    C3 years -> OR of ['YYYY01','YYYY12'] ranges; C4 months -> month part in list;
    C5 range: the competência stands for the first day of its month and must be
    >= start and <= end (``Y-m-d`` strings, either optional).
    """
    c = F.col(col)
    preds = []
    if years:
        preds.append(_any([(c >= f"{int(y):04d}01") & (c <= f"{int(y):04d}12") for y in years]))
    if months:
        preds.append(F.substring(c, 5, 2).isin([f"{int(m):02d}" for m in months]))
    if start:
        s = _dt.date.fromisoformat(start)
        # first-of-month >= start: the start month itself only qualifies when start is day 1
        preds.append(c >= _month_text(s) if s.day == 1 else c > _month_text(s))
    if end:
        preds.append(c <= _month_text(_dt.date.fromisoformat(end)))
    return _all(preds) if preds else None


def filter_period(df: DataFrame, *, years=None, months=None, start=None, end=None,
                  col: str = "competencia_mov", year_col: str = "ano", month_col: str = "mes") -> DataFrame:
    """C3-C5.  Uses the competência column when present, else the ANO/MES columns.

    Where both are present, as in the written tipo/ano/mes layout, the year and month columns are asked as
    well, so whole directories are left out of the scan.
    """
    if col in df.columns:
        p = period_predicate(years=years, months=months, start=start, end=end, col=col)
        coarse = []
        if year_col in df.columns:
            if years:
                coarse.append(F.col(year_col).isin([int(y) for y in years]))
            if start:
                coarse.append(F.col(year_col) >= int(start[:4]))
            if end:
                coarse.append(F.col(year_col) <= int(end[:4]))
        if months and month_col in df.columns:
            coarse.append(F.col(month_col).isin([int(m) for m in months]))
        if coarse:
            p = _all(coarse) & p
    else:
        preds = []
        if years:
            preds.append(F.col(year_col).isin([int(y) for y in years]))
        if months:
            preds.append(F.col(month_col).isin([int(m) for m in months]))
        if start or end:
            ym = F.col(year_col) * 100 + F.col(month_col)
            if start:
                s = _dt.date.fromisoformat(start)
                preds.append(ym >= int(_month_text(s)) if s.day == 1 else ym > int(_month_text(s)))
            if end:
                preds.append(ym <= int(_month_text(_dt.date.fromisoformat(end))))
        p = _all(preds) if preds else None
    return df if p is None else df.where(p)


# --- C6-C8: movement ---------------------------------------------------------------

def filter_movement(df: DataFrame, *, types=None, only: str | None = None,
                    code: str = "tipo_movimentacao", saldo: str = "saldo_movimentacao") -> DataFrame:
    """C6 type list; C7 only='admissions' (balance > 0); C8 only='separations' (balance < 0)."""
    if only not in (None, "admissions", "separations"):
        raise ValueError("only must be 'admissions' or 'separations' (asking for both is an error)")
    if types:
        df = df.where(F.col(code).isin([str(t) for t in types]))
    if only == "admissions":
        df = df.where(F.col(saldo) > 0)
    elif only == "separations":
        df = df.where(F.col(saldo) < 0)
    return df


# --- C9-C12: geography ----------------------------------------------------------------

def wildcard_regex(pattern: str) -> str:
    """'*' -> any run, '?' -> one char; everything else literal; anchored."""
    parts = []
    for ch in pattern:
        if ch == "*":
            parts.append(".*")
        elif ch == "?":
            parts.append(".")
        else:
            parts.append(re.escape(ch))
    return "^" + "".join(parts) + "$"


def cep_predicate(ceps, col: str = "cep") -> Column:
    """Exact codes via IN, wildcard codes via anchored regex, all OR-ed."""
    exact = [c for c in ceps if "*" not in c and "?" not in c]
    wild = [c for c in ceps if c not in exact]
    preds = []
    if exact:
        preds.append(F.col(col).isin(exact))
    preds += [F.col(col).rlike(wildcard_regex(w)) for w in wild]
    return _any(preds)


def _upper_vals(vals):
    return [v.upper() if isinstance(v, str) else v for v in vals]


def filter_geo(df: DataFrame, *, ufs=None, regions=None, municipalities=None, ceps=None,
               uf_col: str = "uf", region_col: str = "regiao", municipality_col: str = "municipio",
               cep_col: str = "cep") -> DataFrame:
    """C9 UF list (values upper-cased), C10 regions, C11 municipalities, C12 postal codes."""
    if ufs:
        df = df.where(F.col(uf_col).isin(_upper_vals(ufs)))
    if regions:
        df = df.where(F.col(region_col).isin(list(regions)))
    if municipalities:
        df = df.where(F.col(municipality_col).isin(list(municipalities)))
    if ceps:
        df = df.where(cep_predicate(ceps, cep_col))
    return df


# --- C16 / C17 ----------------------------------------------------------------------

def range_predicate(rules: dict) -> Column | None:
    preds = []
    for c, r in rules.items():
        if r.get("min") is not None:
            preds.append(F.col(c) >= r["min"])
        if r.get("max") is not None:
            preds.append(F.col(c) <= r["max"])
    return _all(preds) if preds else None


def range_rules(df: DataFrame, rules: dict, *, skip_absent: bool = False) -> DataFrame:
    """Keep rows inside every ``{col: {min, max}}`` rule; a rule on an absent column is an error unless ``skip_absent``."""
    absent = [c for c in rules if c not in df.columns]
    if absent and not skip_absent:
        raise ValueError(f"range rule on absent column(s) {', '.join(absent)}")
    p = range_predicate({c: r for c, r in rules.items() if c not in absent})
    return df if p is None else df.where(p)


def valid_key(df: DataFrame, col: str = "cnpj") -> DataFrame:
    """C17: key non-null and non-empty after trimming."""
    return df.where(F.length(F.trim(F.col(col).cast("string"))) > 0)


# --- C13: filter chain ----------------------------------------------------------------

@dataclass
class FilterChain:
    """Ordered filter steps; ``apply`` composes them, ``report`` counts all steps in one pass.

    Each step is (name, required columns, predicate).  A column that the frame
    lacks is an error; with ``skip_absent`` its step does nothing and is reported as 'ignorado'.
    A classification table marks the rows by a left join before the steps run.
    """

    steps: list[tuple[str, tuple[str, ...], Callable[[], Column]]] = field(default_factory=list)
    tables: list[tuple[str, str, DataFrame]] = field(default_factory=list)
    skip_absent: bool = False

    def add(self, name: str, columns, predicate: Column | Callable[[], Column]) -> "FilterChain":
        pred = predicate if callable(predicate) and not isinstance(predicate, Column) else (lambda p=predicate: p)
        self.steps.append((name, tuple(columns), pred))
        return self

    # builder helpers mirroring the domain filters
    def period(self, col: str = "competencia_mov", **kw) -> "FilterChain":
        p = period_predicate(col=col, **kw)
        return self if p is None else self.add("periodo", [col], p)

    def cnae(self, codes, col: str = "subclasse") -> "FilterChain":
        return self if not codes else self.add("cnae", [col], F.col(col).isin(list(codes)))

    def cnae_table(self, codes: DataFrame, col: str = "subclasse") -> "FilterChain":
        """Rows whose code is in the one-column frame ``code`` (see :func:`load_cnae`, :func:`cnae_codes`)."""
        mark = f"__tabela_{len(self.tables)}"
        self.tables.append((mark, col, codes))
        return self.add("cnae_tabela", [col], F.coalesce(F.col(mark), F.lit(False)))

    def movement(self, types=None, only=None, code="tipo_movimentacao", saldo="saldo_movimentacao"):
        if types:
            self.add("tipo_movimentacao", [code], F.col(code).isin([str(t) for t in types]))
        if only == "admissions":
            self.add("admissoes", [saldo], F.col(saldo) > 0)
        elif only == "separations":
            self.add("desligamentos", [saldo], F.col(saldo) < 0)
        return self

    def geo(self, ufs=None, regions=None, municipalities=None, ceps=None, uf_col="uf", region_col="regiao",
            municipality_col="municipio", cep_col="cep"):
        if ufs:
            self.add("uf", [uf_col], F.col(uf_col).isin(_upper_vals(ufs)))
        if regions:
            self.add("regiao", [region_col], F.col(region_col).isin(list(regions)))
        if municipalities:
            self.add("municipio", [municipality_col], F.col(municipality_col).isin(list(municipalities)))
        if ceps:
            self.add("cep", [cep_col], cep_predicate(ceps, cep_col))
        return self

    def ranges(self, rules: dict) -> "FilterChain":
        """One step per ``{col: {min, max}}`` rule."""
        for c, r in rules.items():
            p = range_predicate({c: r})
            if p is not None:
                self.add(f"faixa_{c}", [c], p)
        return self

    def _plan(self, df: DataFrame):
        """The frame with its table marks, and (name, predicate or None where skipped) per step."""
        steps = []
        for name, cols, pred in self.steps:
            absent = [c for c in cols if c not in df.columns]
            if absent and not self.skip_absent:
                raise ValueError(f"filter step '{name}' needs column(s) {', '.join(absent)}")
            steps.append((name, None if absent else pred()))
        for mark, col, codes in self.tables:
            if col in df.columns:
                known = codes.select(F.col("code").alias(f"{mark}_code")).distinct().withColumn(mark, F.lit(True))
                df = df.join(known, F.col(col) == F.col(f"{mark}_code"), "left")
        return df, steps

    def apply(self, df: DataFrame) -> DataFrame:
        cols = df.columns
        marked, steps = self._plan(df)
        preds = [p for _, p in steps if p is not None]
        return df if not preds else marked.where(_all(preds)).select(*cols)

    def report(self, df: DataFrame) -> DataFrame:
        """Rows (passo, filtro, linhas_antes, linhas_depois, situacao, removidas, pct_removidas).

        One aggregate computes the running conjunction counts of every step.
        """
        marked, steps = self._plan(df)
        aggs = [F.count(F.lit(1)).alias("c0")]
        running = F.lit(True)
        for i, (_, p) in enumerate(steps, start=1):
            running = running if p is None else running & p
            aggs.append(F.count_if(running).alias(f"c{i}"))
        counts = marked.agg(*aggs)
        if not steps:
            return counts.select(F.lit(0).alias("passo"), F.lit(None).cast("string").alias("filtro"),
                                 F.col("c0").alias("linhas_antes"), F.col("c0").alias("linhas_depois"),
                                 F.lit("vazio").alias("situacao"), F.lit(0).cast("bigint").alias("removidas"),
                                 F.lit(0.0).alias("pct_removidas"))
        rows = F.array(*[F.struct(F.lit(i).alias("passo"), F.lit(n).alias("filtro"),
                                  F.col(f"c{i - 1}").alias("linhas_antes"), F.col(f"c{i}").alias("linhas_depois"),
                                  F.lit("ignorado" if p is None else "aplicado").alias("situacao"))
                         for i, (n, p) in enumerate(steps, start=1)])
        return (counts.select(F.inline(rows))
                .withColumn("removidas", F.col("linhas_antes") - F.col("linhas_depois"))
                .withColumn("pct_removidas", F.round(F.when(F.col("linhas_antes") > 0,
                            F.col("removidas") / F.col("linhas_antes") * 100.0).otherwise(0.0), 6)))


def load_cnae(spark, path: str, *, sep: str = ";", code_col: str = "CLASSE_CNAE",
              status_col: str = "SITUACAO", situacao=1) -> DataFrame:
    """Read the industry classification (delimited, header) and keep the codes with the
    wanted status, as a one-column frame ``code`` for :func:`filter_cnae_table`-style joins."""
    t = spark.read.option("header", True).option("sep", sep).csv(path)
    return (t.where(F.trim(F.col(status_col)) == str(situacao))
            .select(F.trim(F.col(code_col)).alias("code")).distinct())
