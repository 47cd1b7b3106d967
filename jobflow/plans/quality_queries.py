"""Data-quality checks (family J) over derived views with rule-made defects."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from jobflow.functions.codes import SEX_CODES, SEX_TEXT_ALIASES, UF_CODES
from jobflow.operators import quality as Q
from jobflow.plans.registry import query
from jobflow.plans.sql import ESTAB, MOV, dir_of, with_views
from jobflow.sources.tables import estab, mov

AS_OF = _dt.date(2025, 12, 31)
AS_OF_WINDOW = _dt.date(2024, 6, 30)

MOVQ_SQL = """movq AS (SELECT id, competencia_mov, competencia_dec, tipo, tipo_movimentacao, saldo_movimentacao, cnpj, cpf,
  idade, salario, horas_contratuais,
  CASE id % 4 WHEN 0 THEN competencia_mov WHEN 1 THEN substr(competencia_mov,1,4) || '-' || substr(competencia_mov,5,2)
   WHEN 2 THEN substr(competencia_mov,1,4) || '/' || substr(competencia_mov,5,2)
   ELSE substr(competencia_mov,1,4) || '.' || substr(competencia_mov,5,2) END AS periodo,
  CASE WHEN regiao = 3 THEN NULL ELSE uf + 11 END AS uf,
  CASE WHEN municipio = 0 THEN NULL ELSE municipio END AS municipio,
  CASE cpf % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN 'M' WHEN 3 THEN 'F' ELSE '7' END AS sexo,
  CASE WHEN cnpj % 17 = 0 THEN substr(lpad(CAST(cnpj AS STRING), 5, '0'), 1, 4)
   ELSE lpad(CAST(cnpj % 100000 AS STRING), 5, '0') END AS classe,
  CASE WHEN cpf % 10 = 0 THEN lpad(CAST(cpf AS STRING), 7, '9')
   ELSE (CASE WHEN cnpj % 17 = 0 THEN substr(lpad(CAST(cnpj AS STRING), 5, '0'), 1, 4)
         ELSE lpad(CAST(cnpj % 100000 AS STRING), 5, '0') END) || lpad(CAST(cpf % 100 AS STRING), 2, '0') END AS subclasse_cnae,
  CAST(cpf * 1000 + idade AS STRING) AS cbo,
  CASE WHEN id % 50 = 0 THEN 'n/a' ELSE CAST(CAST(horas_contratuais AS BIGINT) AS STRING) END AS horas_txt,
  CASE WHEN id % 29 = 0 THEN '13' ELSE substr(competencia_mov,5,2) END AS mes_txt,
  CASE WHEN id % 5 < 3 THEN NULL ELSE 'x' END AS telefone
 FROM mov)"""


MOVQ_COLUMNS = ["id", "competencia_mov", "competencia_dec", "tipo", "tipo_movimentacao", "saldo_movimentacao", "cnpj", "cpf", "idade",
                "salario", "horas_contratuais", "periodo", "uf", "municipio", "sexo", "classe", "subclasse_cnae", "cbo", "horas_txt",
                "mes_txt", "telefone"]
_NEEDS = {"periodo": ["id", "competencia_mov"], "uf": ["regiao", "uf"], "sexo": ["cpf"], "classe": ["cnpj"],
          "subclasse_cnae": ["cnpj", "cpf"], "cbo": ["cpf", "idade"], "horas_txt": ["id", "horas_contratuais"],
          "mes_txt": ["id", "competencia_mov"], "telefone": ["id"]}


def movq(spark, sf_dir, cols=None):
    """The movement view with rule-made defects, restricted to ``cols``: joins whose columns nobody asks for are not made."""
    cols = list(cols or MOVQ_COLUMNS)
    m = mov(spark, sf_dir, sorted({n for c in cols for n in _NEEDS.get(c, [c])}))
    c, cnpj, cpf, i = F.col("competencia_mov"), F.col("cnpj"), F.col("cpf"), F.col("id")
    y, mo = F.substring(c, 1, 4), F.substring(c, 5, 2)
    classe = (F.when(cnpj % 17 == 0, F.substring(F.lpad(cnpj.cast("string"), 5, "0"), 1, 4))
              .otherwise(F.lpad((cnpj % 100000).cast("string"), 5, "0")))
    made = {
        "periodo": F.when(i % 4 == 0, c).when(i % 4 == 1, F.concat(y, F.lit("-"), mo)).when(i % 4 == 2, F.concat(y, F.lit("/"), mo))
        .otherwise(F.concat(y, F.lit("."), mo)),
        "uf": F.when(F.col("regiao") != 3, F.col("uf") + 11),
        "municipio": F.when(F.col("municipio") != 0, F.col("municipio")),
        "sexo": F.when(cpf % 5 == 0, "1").when(cpf % 5 == 1, "2").when(cpf % 5 == 2, "M").when(cpf % 5 == 3, "F").otherwise("7"),
        "classe": classe,
        "subclasse_cnae": F.when(cpf % 10 == 0, F.lpad(cpf.cast("string"), 7, "9"))
        .otherwise(F.concat(classe, F.lpad((cpf % 100).cast("string"), 2, "0"))),
        "cbo": (cpf * 1000 + F.col("idade")).cast("string"),
        "horas_txt": F.when(i % 50 == 0, F.lit("n/a")).otherwise(F.col("horas_contratuais").cast("bigint").cast("string")),
        "mes_txt": F.when(i % 29 == 0, F.lit("13")).otherwise(mo),
        "telefone": F.when(i % 5 >= 3, F.lit("x")),
    }
    return m.select(*[made[x].alias(x) if x in made else F.col(x) for x in cols])


# --- SQL side of the checks -------------------------------------------------------------------

def _fin(inner: str) -> str:
    return f"""SELECT check_name, column_name, bad_rows, total_rows,
 round(CASE WHEN total_rows > 0 THEN bad_rows / total_rows * 100.0 ELSE 0.0 END, 6) AS pct, tolerance,
 CASE WHEN round(CASE WHEN total_rows > 0 THEN bad_rows / total_rows * 100.0 ELSE 0.0 END, 6) <= tolerance THEN 'ok' ELSE 'falha' END AS status
FROM ({inner})"""


def chk(name, column, bad, elig="TRUE", tol=0.0, src="movq"):
    return _fin(f"SELECT '{name}' AS check_name, '{column}' AS column_name, CAST(count_if(({elig}) AND ({bad})) AS BIGINT) AS bad_rows, "
                f"CAST(count_if({elig}) AS BIGINT) AS total_rows, CAST({tol} AS DOUBLE) AS tolerance FROM {src}")


def union(*parts):
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


def nn(c):
    return f"{c} IS NOT NULL"


QV = with_views(MOV, MOVQ_SQL)
EV = with_views(MOV, ESTAB)
_IN = lambda vals: ", ".join(f"'{v}'" for v in vals)

S_J1 = chk("saldo_formula", "saldo", "saldo <> admitidos - desligados",
           "admitidos IS NOT NULL AND desligados IS NOT NULL AND saldo IS NOT NULL", 5.0, "estab")
S_J2 = chk("formato_periodo", "periodo", r"NOT regexp_matches(periodo, '^\d{4}-\d{2}$|^\d{6}$|^\d{4}/\d{2}$')", nn("periodo"))
_NORM = "CASE WHEN length(periodo) = 6 THEN substr(periodo,1,4) || '-' || substr(periodo,5,2) ELSE periodo END"
S_J3 = chk("intervalo_periodo", "periodo", f"({_NORM}) < '2020-01' OR ({_NORM}) > '{AS_OF.year}-{AS_OF.month:02d}'", nn("periodo"))
S_J5 = [chk("dominio_uf", "uf", f"uf NOT IN ({', '.join(UF_CODES)})", nn("uf")),
        chk("dominio_sexo", "sexo", f"sexo NOT IN ({_IN(SEX_CODES + SEX_TEXT_ALIASES)})", nn("sexo")),
        chk("dominio_tipo_movimentacao", "tipo_movimentacao", f"tipo_movimentacao NOT IN ({_IN(Q.MOVEMENT_DOMAIN)})",
            nn("tipo_movimentacao"))]
S_J8 = [chk("tipo_numerico", c, f"TRY_CAST({c} AS DOUBLE) IS NULL", nn(c)) for c in ("horas_txt", "mes_txt")]
S_J11 = [chk("municipio_sem_uf", "municipio", "uf IS NULL AND municipio IS NOT NULL", "TRUE", 2.0),
         chk("uf_sem_municipio", "uf", "uf IS NOT NULL AND municipio IS NULL", "TRUE", 2.0)]
S_J12 = chk("cnae_hierarquia", "subclasse_cnae", "NOT starts_with(subclasse_cnae, classe)",
            "classe IS NOT NULL AND subclasse_cnae IS NOT NULL", 2.0)
S_J13 = [chk("cnae_tamanho", "classe", "length(classe) <> 5", nn("classe"), 2.0),
         chk("cnae_tamanho", "subclasse_cnae", "length(subclasse_cnae) <> 7", nn("subclasse_cnae"), 2.0)]
S_J14 = chk("cbo_formato", "cbo", r"NOT regexp_matches(cbo, '^\d{6}$')", nn("cbo"), 2.0)
S_J15 = chk("competencia_futura", "competencia_dec", f"competencia_dec > '{AS_OF.year}{AS_OF.month:02d}'", nn("competencia_dec"))
S_J17 = chk("exclusao_positiva", "saldo_movimentacao",
            "(tipo = 'EXC' OR tipo_movimentacao IN ('99','EXC','EXCLUSAO')) AND saldo_movimentacao > 0")
S_J18 = chk("fora_janela_declaracao", "competencia_mov",
            "competencia_mov < strftime(DATE '2024-06-30' - INTERVAL 180 DAY, '%Y%m') OR "
            "competencia_mov > strftime(DATE '2024-06-30' + INTERVAL 30 DAY, '%Y%m')", nn("competencia_mov"))
S_J20 = [chk("valores_negativos", c, f"{c} < 0", nn(c)) for c in ("saldo_movimentacao", "idade", "salario")]
S_J21 = chk("tipos_movimentacao", "tipo_movimentacao", f"tipo_movimentacao NOT IN ({_IN(Q.MOVEMENT_DOMAIN)})", nn("tipo_movimentacao"))
S_J22 = [chk("entidade_nulos", "cnpj", "cnpj IS NULL", "TRUE", 80.0),
         chk("entidade_nulos", "cpf", "cpf IS NULL", "TRUE", 80.0),
         chk("tipo_entidade", "tipo_movimentacao", f"CAST(tipo_movimentacao AS STRING) NOT IN ({_IN(Q.ENTITY_TYPE_SHORT_LIST)})",
             nn("tipo_movimentacao"))]
S_J23 = chk("entidade_valida", "id",
            f"NOT coalesce(id > 0 AND length(competencia_mov) > 0 AND ({dir_of()}) IS NOT NULL, FALSE)")
S_J24 = chk("saldo_registro_valido", "saldo", "abs(admitidos - desligados - saldo) > 1 OR admitidos < 0 OR desligados < 0",
            "TRUE", 0.0, "estab")
S_J25_MONTH = chk("mes_valido", "mes_txt", "TRY_CAST(mes_txt AS INTEGER) IS NULL OR NOT (TRY_CAST(mes_txt AS INTEGER) BETWEEN 1 AND 12)",
                  nn("mes_txt"))

COMPLETE_COLS = ["uf", "municipio", "telefone", "sexo", "cbo"]


def s_completeness(cols):
    return union(*[_fin(f"SELECT 'completude' AS check_name, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS bad_rows, "
                        f"CAST(count(*) AS BIGINT) AS total_rows, CAST(50.0 AS DOUBLE) AS tolerance FROM movq") for c in cols])


S_J7 = _fin("""SELECT 'duplicatas' AS check_name, '*' AS column_name, CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM movq)) AS BIGINT) AS bad_rows,
 CAST(count(*) AS BIGINT) AS total_rows, CAST(0.0 AS DOUBLE) AS tolerance FROM movq""")
S_J16 = _fin("""SELECT 'chaves_duplicadas' AS check_name, 'cnpj,cpf,competencia_mov' AS column_name, CAST(sum(n - 1) AS BIGINT) AS bad_rows,
 CAST(sum(n) AS BIGINT) AS total_rows, CAST(0.0 AS DOUBLE) AS tolerance FROM (SELECT cnpj, cpf, competencia_mov, count(*) AS n FROM movq GROUP BY ALL)""")
S_J19 = _fin("""SELECT 'consistencia_mensal' AS check_name, 'saldo' AS column_name, CAST(count_if(s <> a - d) AS BIGINT) AS bad_rows,
 CAST(count(*) AS BIGINT) AS total_rows, CAST(0.0 AS DOUBLE) AS tolerance FROM
 (SELECT competencia, sum(admitidos) AS a, sum(desligados) AS d, sum(saldo) AS s FROM estab GROUP BY competencia)""")
OUT_COLS = ["idade", "horas_contratuais", "salario"]
DUP_KEYS = ["cnpj", "cpf", "competencia_mov"]
BALANCE_COLS = ["cnpj", "competencia", "admitidos", "desligados", "saldo"]


def s_outliers(cols):
    parts = []
    for c in cols:
        q1 = f"(SELECT quantile_cont({c}, 0.25) FROM movq)"
        q3 = f"(SELECT quantile_cont({c}, 0.75) FROM movq)"
        parts.append(_fin(f"""SELECT 'outliers' AS check_name, '{c}' AS column_name,
 CAST(count_if({c} < {q1} - 1.5*({q3}-{q1}) OR {c} > {q3} + 1.5*({q3}-{q1})) AS BIGINT) AS bad_rows,
 CAST(count(*) AS BIGINT) AS total_rows, CAST(5.0 AS DOUBLE) AS tolerance FROM movq"""))
    return union(*parts)


def s_structure(cols, src):
    """Structure rows counted from the column names ``cols`` and the rows of ``src``."""
    names = f"SELECT unnest([{', '.join(repr(c) for c in cols)}]) AS nome"
    def row(check, column, bad, total):
        return _fin(f"SELECT '{check}' AS check_name, '{column}' AS column_name, CAST({bad} AS BIGINT) AS bad_rows, "
                    f"CAST({total} AS BIGINT) AS total_rows, CAST(0.0 AS DOUBLE) AS tolerance")
    missing = {g: f"(SELECT CASE WHEN count_if(upper(nome) IN ({_IN(v)})) = 0 THEN 1 ELSE 0 END FROM ({names}))"
               for g, v in Q.ESSENTIAL_GROUPS.items()}
    return union(*[row("campo_essencial", g, bad, 1) for g, bad in missing.items()],
                 row("colunas_minimas", "*", f"(SELECT CASE WHEN count(*) < 5 THEN 1 ELSE 0 END FROM ({names}))", 1),
                 row("nomes_invalidos", "*", f"(SELECT count_if(NOT regexp_matches(nome, '^[A-Z_][A-Z0-9_]*$')) FROM ({names}))",
                     f"(SELECT count(*) FROM ({names}))"),
                 row("cobertura_essencial", "*", " + ".join(missing.values()), len(missing)),
                 row("nao_vazio", "*", f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {src})", 1))


S_J10 = s_structure(MOVQ_COLUMNS, "movq")
# a frame that breaks every structure rule: too few columns, bad names, missing groups, no rows
BROKEN = ["COMPETENCIA_MOV", "2_SALDO", "uf"]

# --- Spark side: the same batteries --------------------------------------------------------------


def row_checks():
    return [Q.period_format("periodo"), Q.period_range("periodo", as_of=AS_OF),
            Q.domain("uf", [int(u) for u in UF_CODES], "dominio_uf"),
            Q.domain("sexo", SEX_CODES + SEX_TEXT_ALIASES, "dominio_sexo"),
            Q.domain("tipo_movimentacao", Q.MOVEMENT_DOMAIN, "dominio_tipo_movimentacao"),
            Q.castable("horas_txt"), Q.castable("mes_txt"),
            *Q.uf_municipality(), Q.cnae_prefix("classe", "subclasse_cnae"),
            Q.cnae_length("classe", 5), Q.cnae_length("subclasse_cnae", 7), Q.cbo("cbo"),
            Q.future("competencia_dec", as_of=AS_OF), Q.bad_exclusions(),
            Q.late_window("competencia_mov", as_of=AS_OF_WINDOW),
            Q.negatives("saldo_movimentacao"), Q.negatives("idade"), Q.negatives("salario"),
            Q.domain("tipo_movimentacao", Q.MOVEMENT_DOMAIN, "tipos_movimentacao"),
            Q.entity_nulls("cnpj"), Q.entity_nulls("cpf"), Q.entity_type(), Q.entity_valid(),
            Q.month_in_range("mes_txt")]


ROW_SQL = [S_J2, S_J3, *S_J5, *S_J8, *S_J11, S_J12, *S_J13, S_J14, S_J15, S_J17, S_J18, *S_J20, S_J21, *S_J22, S_J23,
           S_J25_MONTH]


def _run(spark, sf_dir, checks, *cols):
    return Q.run_checks(movq(spark, sf_dir, cols), checks)


def _reg(key, sql, fn):
    query(key, sql)(fn)


_reg("j1_balance_formula", EV + S_J1, lambda s, d: Q.run_checks(estab(s, d, BALANCE_COLS), [Q.balance_formula()]))
_reg("j2_period_format", QV + S_J2, lambda s, d: _run(s, d, [Q.period_format("periodo")], "periodo"))
_reg("j3_period_range", QV + S_J3, lambda s, d: _run(s, d, [Q.period_range("periodo", as_of=AS_OF)], "periodo"))
_reg("j5_domains", QV + union(*S_J5), lambda s, d: _run(s, d, row_checks()[2:5], "uf", "sexo", "tipo_movimentacao"))
_reg("j6_completeness", QV + s_completeness(COMPLETE_COLS), lambda s, d: Q.completeness(movq(s, d, COMPLETE_COLS), COMPLETE_COLS))
_reg("j7_duplicates", QV + S_J7, lambda s, d: Q.duplicates(movq(s, d)))
_reg("j8_castable", QV + union(*S_J8), lambda s, d: _run(s, d, [Q.castable("horas_txt"), Q.castable("mes_txt")], "horas_txt", "mes_txt"))
_reg("j9_outlier_share", QV + s_outliers(OUT_COLS), lambda s, d: Q.outlier_share(movq(s, d, OUT_COLS), OUT_COLS))
_reg("j10_structure", QV + S_J10, lambda s, d: Q.structure(movq(s, d)))


def _broken(spark, sf_dir):
    m = movq(spark, sf_dir, ["id", "competencia_mov", "saldo_movimentacao", "uf"]).where("id < 0")
    return m.select(F.col("competencia_mov").alias(BROKEN[0]), F.col("saldo_movimentacao").alias(BROKEN[1]), F.col("uf").alias(BROKEN[2]))


_reg("j10_structure_broken", QV + s_structure(BROKEN, "movq WHERE id < 0"), lambda s, d: Q.structure(_broken(s, d)))
_reg("j11_uf_municipality", QV + union(*S_J11), lambda s, d: _run(s, d, Q.uf_municipality(), "uf", "municipio"))
_reg("j12_cnae_prefix", QV + S_J12, lambda s, d: _run(s, d, [Q.cnae_prefix("classe", "subclasse_cnae")], "classe", "subclasse_cnae"))
_reg("j13_cnae_length", QV + union(*S_J13),
     lambda s, d: _run(s, d, [Q.cnae_length("classe", 5), Q.cnae_length("subclasse_cnae", 7)], "classe", "subclasse_cnae"))
_reg("j14_cbo", QV + S_J14, lambda s, d: _run(s, d, [Q.cbo("cbo")], "cbo"))
_reg("j15_future", QV + S_J15, lambda s, d: _run(s, d, [Q.future("competencia_dec", as_of=AS_OF)], "competencia_dec"))
_reg("j16_dup_keys", QV + S_J16, lambda s, d: Q.duplicate_key_check(movq(s, d, DUP_KEYS), DUP_KEYS))
_reg("j17_bad_exclusions", QV + S_J17, lambda s, d: _run(s, d, [Q.bad_exclusions()], "tipo", "tipo_movimentacao", "saldo_movimentacao"))
_reg("j18_late_window", QV + S_J18, lambda s, d: _run(s, d, [Q.late_window("competencia_mov", as_of=AS_OF_WINDOW)], "competencia_mov"))
_reg("j19_monthly_consistency", EV + S_J19, lambda s, d: Q.monthly_consistency(estab(s, d, BALANCE_COLS)))
_reg("j20_negatives", QV + union(*S_J20),
     lambda s, d: _run(s, d, [Q.negatives("saldo_movimentacao"), Q.negatives("idade"), Q.negatives("salario")],
                       "saldo_movimentacao", "idade", "salario"))
_reg("j21_movement_types", QV + S_J21,
     lambda s, d: _run(s, d, [Q.domain("tipo_movimentacao", Q.MOVEMENT_DOMAIN, "tipos_movimentacao")], "tipo_movimentacao"))
_reg("j22_entity_types", QV + union(*S_J22),
     lambda s, d: _run(s, d, [Q.entity_nulls("cnpj"), Q.entity_nulls("cpf"), Q.entity_type()], "cnpj", "cpf", "tipo_movimentacao"))
_reg("j23_entity_valid", QV + S_J23, lambda s, d: _run(s, d, [Q.entity_valid()], "id", "competencia_mov", "tipo_movimentacao"))
_reg("j24_balance_valid", EV + S_J24, lambda s, d: Q.run_checks(estab(s, d, BALANCE_COLS), [Q.balance_row_valid()]))

FILE_COLS = ["uf", "municipio", "telefone", "horas_txt", "mes_txt"]


def _j25(spark, sf_dir):
    q = movq(spark, sf_dir, FILE_COLS)
    return Q.run_checks(q, Q.completeness_checks(FILE_COLS) +
                        [Q.castable("horas_txt"), Q.castable("mes_txt"), Q.month_in_range("mes_txt")])


_reg("j25_file_quality", QV + union(s_completeness(FILE_COLS), *S_J8, S_J25_MONTH), _j25)


def _j26(spark, sf_dir):
    q = movq(spark, sf_dir)
    return Q.QualityReport(q, row_checks(), completeness_cols=COMPLETE_COLS, outlier_cols=OUT_COLS,
                           duplicate_keys=["cnpj", "cpf", "competencia_mov"], structure=True,
                           # movq is a 5-table join with ~20 derived columns: write it once and
                           # run the report's passes over that table
                           materialize=True).run()


_J26_BODY = union(*ROW_SQL, s_completeness(COMPLETE_COLS), S_J7, S_J16, s_outliers(OUT_COLS), S_J10)
_reg("j26_report", QV + f", rep AS ({_J26_BODY})\n" + union(
    "SELECT * FROM rep",
    _fin("SELECT 'geral' AS check_name, '*' AS column_name, CAST(count_if(status = 'falha') AS BIGINT) AS bad_rows, "
         "CAST(count(*) AS BIGINT) AS total_rows, CAST(0.0 AS DOUBLE) AS tolerance FROM rep")), _j26)

QUAR_CHECKS_SQL = [("formato_periodo:periodo", r"periodo IS NOT NULL AND NOT regexp_matches(periodo, '^\d{4}-\d{2}$|^\d{6}$|^\d{4}/\d{2}$')"),
                   ("dominio_sexo:sexo", f"sexo IS NOT NULL AND sexo NOT IN ({_IN(SEX_CODES + SEX_TEXT_ALIASES)})"),
                   ("tipo_numerico:horas_txt", "horas_txt IS NOT NULL AND TRY_CAST(horas_txt AS DOUBLE) IS NULL"),
                   ("cnae_hierarquia:subclasse_cnae", "classe IS NOT NULL AND subclasse_cnae IS NOT NULL AND NOT starts_with(subclasse_cnae, classe)")]


def _j27(spark, sf_dir):
    checks = [Q.period_format("periodo"), Q.domain("sexo", SEX_CODES + SEX_TEXT_ALIASES, "dominio_sexo"),
              Q.castable("horas_txt"), Q.cnae_prefix("classe", "subclasse_cnae")]
    cols = ["id", "competencia_mov", "periodo", "sexo", "horas_txt", "classe", "subclasse_cnae"]
    return Q.quarantine(movq(spark, sf_dir, cols), checks).select("id", "competencia_mov", "valido", "motivos")


_reg("j27_quarantine", QV + "SELECT id, competencia_mov, motivos = '' AS valido, motivos FROM (SELECT id, competencia_mov, concat_ws(',', " +
     ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in QUAR_CHECKS_SQL) + ") AS motivos FROM movq)", _j27)
