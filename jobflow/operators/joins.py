"""Matching steps as joins.

No broadcast is hinted: AQE broadcasts a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobflow.functions.codes import SEPARATION, direction
from jobflow.sources.catalog import match_keys


def decode(df: DataFrame, col: str, dim: DataFrame, *, code: str = "code", label: str = "label",
           out: str | None = None) -> DataFrame:
    """Add the label of a coded column from a dictionary (left join; an unknown code gets null)."""
    out = out or f"{col}_label"
    d = dim.select(F.col(code).alias("__code"), F.col(label).alias(out))
    return df.join(d, df[col] == d["__code"], "left").drop("__code")


def stale_files(inputs: DataFrame, outputs: DataFrame, *, key: str = "file_id", in_mtime: str = "mtime",
                out_mtime: str = "out_mtime", out_rows: str = "out_rows") -> DataFrame:
    """D3: inputs needing (re)processing with the reason: no output, output older, output empty."""
    o = outputs.select(F.col(key).alias("__k"), F.col(out_mtime).alias("__om"), F.col(out_rows).alias("__or"))
    j = inputs.join(o, inputs[key] == o["__k"], "left")
    reason = (F.when(F.col("__k").isNull(), F.lit("sem_saida"))
              .when(F.col("__om") < F.col(in_mtime), F.lit("desatualizada"))
              .when(F.col("__or") <= 0, F.lit("vazia")))
    return j.withColumn("motivo", reason).where(F.col("motivo").isNotNull()).drop("__k", "__om", "__or")


def _served(k: Column, has_month: Column, has_uf: Column, other_month: bool, other_uf: bool) -> Column:
    """Key of the parts that a name shares with a partner that states a month and a state, or not."""
    return F.struct(F.lit(other_month).alias("om"), F.lit(other_uf).alias("ou"), has_month.alias("m"), has_uf.alias("u"),
                    k["ano"].alias("ano"), k["tipo"].alias("tipo"), F.when(has_month & F.lit(other_month), k["mes"]).alias("mes"),
                    F.when(has_uf & F.lit(other_uf), k["uf"]).alias("uf"))


def _class_keys(classes: DataFrame, *, asks: bool) -> DataFrame:
    """Every class (ano, tipo, mes, uf; null where not stated) with its (key, rank) pairs: one for each way a partner may state month and state."""
    k = F.struct("ano", "tipo", "mes", "uf")
    m, u = k["mes"].isNotNull(), k["uf"].isNotNull()
    keys = []
    for om in (True, False):
        for ou in (True, False):
            # both sides name a pair of states in the same order: who asks first
            own = _served(k, m, u, om, ou)
            a, b = [own["m"], own["u"]], [own["om"], own["ou"]]
            ask, give = (a, b) if asks else (b, a)
            key = F.to_json(F.struct(ask[0].alias("am"), ask[1].alias("au"), give[0].alias("gm"), give[1].alias("gu"),
                                     own["ano"].alias("ano"), own["tipo"].alias("tipo"), own["mes"].alias("mes"), own["uf"].alias("uf")))
            keys.append(F.struct((5 - 2 * (m & F.lit(om)).cast("int") - (u & F.lit(ou)).cast("int")).alias("rank"), key.alias("key")))
    return classes.where("ano IS NOT NULL").select("*", F.inline(F.array(*keys)))


_CLASS = ["ano", "tipo", "mes", "uf"]


def match_outputs(inputs: DataFrame, outputs: DataFrame, *, name: str = "file_name", out_name: str = "out_name",
                  out_mtime: str = "out_mtime", out_rows: str = "out_rows") -> DataFrame:
    """D3: every input with its best output: ``__rank``, ``__name``, ``__mtime``, ``__rows`` (null where none matches).

    Ranks: 1 the same base name; then the same year and equivalent type with the same month and state (2), the same month (3),
    the same state (4), neither (5).  A month or state that one side does not state agrees with any.  Outputs with
    rows come before empty ones, then the lowest rank, the newest, the last name.

    All files that state the same year, type, month and state are one class, of which there are few whatever the number of
    files.  Outputs shrink to the best of a class and of a base name (partial aggregates), classes are matched with each other, and
    an input meets two rows: its class's best and its base name's.  Pairs are never listed.
    """
    def stated(c: str):
        k = match_keys(F.col(c))
        return [k[x].alias(f"__{x}") for x in ("base", *_CLASS)]

    best = F.max(F.struct((F.col("__rows") > 0).alias("full"), F.col("__mtime").alias("mtime"), F.col("__name").alias("name"),
                          F.col("__rows").alias("rows"))).alias("best")
    renamed = [F.col(f"__{x}").alias(x) for x in _CLASS]

    def ranked(rank):
        return F.struct(F.col("best.full").alias("full"), (-rank).alias("rank"), F.col("best.mtime").alias("mtime"),
                        F.col("best.name").alias("name"), F.col("best.rows").alias("rows"))

    o = outputs.select(F.col(out_name).alias("__name"), F.col(out_mtime).alias("__mtime"), F.col(out_rows).alias("__rows"), *stated(out_name))
    same = o.groupBy(F.col("__base").alias("__of")).agg(best).select("__of", ranked(F.lit(1)).alias("__same"))
    given = _class_keys(o.groupBy(*renamed).agg(best), asks=False).groupBy(F.col("key").alias("__key"), F.col("rank").alias("__r")).agg(
        F.max("best").alias("best"))
    i = inputs.select("*", *stated(name))
    asked = _class_keys(i.select(*renamed).distinct(), asks=True)
    alike = asked.join(given, (F.col("key") == F.col("__key")) & (F.col("rank") == F.col("__r"))).groupBy(
        *[F.col(x).alias(f"__of_{x}") for x in _CLASS]).agg(F.max(ranked(F.col("rank"))).alias("__alike"))
    found = i.join(same, F.col("__base") == F.col("__of"), "left").join(
        alike, (F.col("__ano") == F.col("__of_ano")) & (F.col("__tipo") == F.col("__of_tipo")) & F.col("__mes").eqNullSafe(F.col("__of_mes"))
        & F.col("__uf").eqNullSafe(F.col("__of_uf")), "left").withColumn("__b", F.greatest("__same", "__alike"))
    return found.select(*inputs.columns, (-F.col("__b.rank")).alias("__rank"), F.col("__b.name").alias("__name"),
                        F.col("__b.mtime").alias("__mtime"), F.col("__b.rows").alias("__rows"))


def stale_by_match(inputs: DataFrame, outputs: DataFrame, *, in_mtime: str = "mtime", **names) -> DataFrame:
    """D3 by the match rule: the inputs that need (re)processing, with the reason, the rank and the name of the output that was looked at."""
    reason = (F.when(F.col("__rank").isNull(), F.lit("sem_saida")).when(F.col("__rows") <= 0, F.lit("vazia"))
              .when(F.col("__mtime") < F.col(in_mtime), F.lit("desatualizada")))
    return (match_outputs(inputs, outputs, **names).withColumn("motivo", reason).where("motivo IS NOT NULL")
            .withColumnsRenamed({"__rank": "nivel", "__name": "saida"}).drop("__mtime", "__rows"))


def new_periods(requested: DataFrame, done: DataFrame, *, month: str = "competencia") -> DataFrame:
    """Requested months not yet processed (left anti join)."""
    return requested.join(done.select(F.col(month).alias("__m")), requested[month] == F.col("__m"), "left_anti")


def available(requested: DataFrame, present: DataFrame, *, month: str = "competencia") -> DataFrame:
    """H7: requested months that exist in the data (set intersection, distinct)."""
    return requested.select(month).intersect(present.select(month))


def prefer_source(df: DataFrame, key: list[str], *, rank: str = "origem_informacao",
                  tiebreak: list[str] | None = None) -> DataFrame:
    """Keep one row per key: lowest source rank, then the tie-break columns, then the others.

    ``row_number() = 1`` keeps at most one row per key and task before the shuffle (window group limit), so a
    key holding a third of all rows reaches its task as a few rows.
    """
    rest = [c for c in df.columns if c not in key]
    order = [rank] + [c for c in (tiebreak or []) if c != rank]
    order += [c for c in rest if c not in order]
    best = Window.partitionBy(*key).orderBy(*[F.col(c).asc() for c in order])
    return df.withColumn("__n", F.row_number().over(best)).where(F.col("__n") == 1).drop("__n")


def impute_separations(main: DataFrame, ew: DataFrame, *, key: list[str], code: str = "tipo_movimentacao") -> DataFrame:
    """Employer-Web separations added only where no main-source row has the key."""
    seps = ew.where(direction(F.col(code)) == SEPARATION)
    missing = seps.join(main.select(*key), key, "left_anti")
    return main.unionByName(missing)


def impute_separations_in(df: DataFrame, *, key: list[str], is_main, code: str = "tipo_movimentacao") -> DataFrame:
    """D6 when both sources are rows of one table (``is_main`` marks the main sources).

    Main rows pass through unshuffled; only the other source's separations are
    compared with the distinct keys of the main rows, which shrink to one row per key and task before
    the shuffle.  Rows with a null in the key match nothing and stay.
    """
    main = df.where(is_main)
    covered = main.select(*key).distinct()
    other = df.where(~F.coalesce(is_main, F.lit(False)) & (direction(F.col(code)) == SEPARATION))
    return main.unionByName(other.join(covered, key, "left_anti").select(*df.columns))
