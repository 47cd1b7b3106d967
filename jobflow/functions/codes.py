"""Official code sets of the movement microdata, and dimension frames built from them.

The lists below are fixed values of the published data layout; results only
match when they are exactly these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: movement-type codes -------------------------------------
# Official admissions and separations (layout dictionary).
OFFICIAL_ADMISSION_CODES = ["10", "20", "25", "35", "70", "97"]
OFFICIAL_SEPARATION_CODES = ["31", "32", "33", "40", "43", "45", "50", "60", "80", "90", "98"]
NOT_IDENTIFIED_CODE = "99"
# The balance computation widens both lists (legacy one-digit codes, 99 as a separation).
ADMISSION_CODES = ["10", "20", "25", "35", "70", "97", "1", "2", "3", "5", "7"]
SEPARATION_CODES = ["31", "32", "33", "40", "43", "45", "50", "60", "80", "90", "98", "99", "4", "6", "8", "9"]
# Text aliases accepted after upper-casing.
ADMISSION_ALIASES = ["ADMISSAO", "ADMISSÃO", "ADMIT", "A"]
SEPARATION_ALIASES = ["DESLIGAMENTO", "DEMISSAO", "DEMISSÃO", "DESLIG", "D"]

# --- fixed values: other domains -------------------------------------------
SEX_CODES = ["1", "2", "9"]
SEX_TEXT_ALIASES = ["M", "F", "MASCULINO", "FEMININO"]
REGION_CODES = ["1", "2", "3", "4", "5"]
SCHOOLING_CODES = ["1", "2", "3", "4", "5", "6", "7", "8", "9", "99"]
RACE_CODES = ["1", "2", "3", "4", "5", "9"]
ESTABLISHMENT_SIZE_CODES = ["0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "99"]
UF_CODES = ["11", "12", "13", "14", "15", "16", "17", "21", "22", "23", "24", "25", "26", "27",
            "28", "29", "31", "32", "33", "35", "41", "42", "43", "50", "51", "52", "53", "99"]
# Two letters of each state, by code.
UF_LETTERS = {11: "RO", 12: "AC", 13: "AM", 14: "RR", 15: "PA", 16: "AP", 17: "TO", 21: "MA", 22: "PI", 23: "CE", 24: "RN",
              25: "PB", 26: "PE", 27: "AL", 28: "SE", 29: "BA", 31: "MG", 32: "ES", 33: "RJ", 35: "SP", 41: "PR", 42: "SC",
              43: "RS", 50: "MS", 51: "MT", 52: "GO", 53: "DF"}
# Source-of-information precedence: 1 = eSocial, 2 = legacy declaration, 3 = Employer Web.
SOURCE_PRECEDENCE = {1: 1, 2: 2, 3: 3}

# Labels in plain words, ours; the codes are the layout's.
MOVEMENT_TYPE_LABELS = [
    ("10", "admissao primeiro emprego", "A"),
    ("20", "admissao reemprego", "A"),
    ("25", "admissao contrato prazo determinado", "A"),
    ("31", "desligamento sem justa causa", "D"),
    ("32", "desligamento com justa causa", "D"),
    ("33", "culpa reciproca", "D"),
    ("35", "admissao reintegracao", "A"),
    ("40", "desligamento a pedido", "D"),
    ("43", "termino contrato prazo determinado", "D"),
    ("45", "termino de contrato", "D"),
    ("50", "aposentadoria", "D"),
    ("60", "morte", "D"),
    ("70", "admissao transferencia", "A"),
    ("80", "desligamento transferencia", "D"),
    ("90", "acordo empregado empregador", "D"),
    ("97", "admissao tipo ignorado", "A"),
    ("98", "desligamento tipo ignorado", "D"),
    ("99", "nao identificado", "D"),
]
REGION_LABELS = [(1, "Norte"), (2, "Nordeste"), (3, "Sudeste"), (4, "Sul"), (5, "Centro-Oeste")]
SEX_LABELS = [(1, "Homem"), (2, "Mulher"), (9, "Nao identificado")]
SOURCE_LABELS = [(1, "eSocial"), (2, "Declaracao legada"), (3, "Empregador Web")]

_YES_NO = [(1, "Sim"), (2, "Nao")]
_YES_NO_UNKNOWN = [*_YES_NO, (9, "Nao identificado")]
#: The coded columns of the layout and their codes (fixed values; two more, movement type and region, are above).
DICTIONARIES = {
    "regiao": REGION_LABELS,
    "sexo": SEX_LABELS,
    "origem_informacao": SOURCE_LABELS,
    "uf": [(11, "Rondonia"), (12, "Acre"), (13, "Amazonas"), (14, "Roraima"), (15, "Para"), (16, "Amapa"), (17, "Tocantins"),
           (21, "Maranhao"), (22, "Piaui"), (23, "Ceara"), (24, "Rio Grande do Norte"), (25, "Paraiba"), (26, "Pernambuco"),
           (27, "Alagoas"), (28, "Sergipe"), (29, "Bahia"), (31, "Minas Gerais"), (32, "Espirito Santo"), (33, "Rio de Janeiro"),
           (35, "Sao Paulo"), (41, "Parana"), (42, "Santa Catarina"), (43, "Rio Grande do Sul"), (50, "Mato Grosso do Sul"),
           (51, "Mato Grosso"), (52, "Goias"), (53, "Distrito Federal"), (99, "Nao identificado")],
    "grau_instrucao": [(1, "Analfabeto"), (2, "Ate 5 incompleto"), (3, "Ate 5 completo"), (4, "De 6 a 9 incompleto"),
                       (5, "Fundamental completo"), (6, "Medio incompleto"), (7, "Medio completo"), (8, "Superior incompleto"),
                       (9, "Superior completo"), (99, "Nao identificado")],
    "raca_cor": [(1, "Branca"), (2, "Preta"), (3, "Amarela"), (4, "Parda"), (5, "Indigena"), (9, "Nao identificado")],
    "categoria": [(101, "Empregado geral"), (102, "Empregado domestico"), (103, "Empregado rural"), (104, "Aprendiz"),
                  (106, "Temporario"), (111, "Intermitente"), (999, "Nao identificado")],
    "tipo_empregador": [(1, "CNPJ raiz"), (2, "CPF"), (9, "Nao identificado")],
    "tipo_estabelecimento": [(1, "CNPJ"), (2, "CAEPF"), (3, "CNO"), (4, "CEI"), (9, "Nao identificado")],
    "tamanho_estabelecimento": [(0, "Zero"), (1, "1 a 4"), (2, "5 a 9"), (3, "10 a 19"), (4, "20 a 49"), (5, "50 a 99"),
                                (6, "100 a 249"), (7, "250 a 499"), (8, "500 a 999"), (9, "1000 ou mais"), (99, "Nao identificado")],
    "tipo_deficiencia": [(0, "Nao deficiente"), (1, "Fisica"), (2, "Auditiva"), (3, "Visual"), (4, "Intelectual"), (5, "Multipla"),
                         (6, "Reabilitado"), (9, "Nao identificado")],
    "unidade_salario": [(1, "Hora"), (2, "Dia"), (3, "Semana"), (4, "Quinzena"), (5, "Mes"), (6, "Tarefa"), (9, "Nao identificado")],
    "indicador_aprendiz": _YES_NO_UNKNOWN,
    "indicador_exclusao": _YES_NO,
    "indicador_fora_prazo": _YES_NO,
    "indicador_trabalho_intermitente": _YES_NO_UNKNOWN,
    "indicador_trabalho_parcial": _YES_NO_UNKNOWN,
}

ADMISSION = "A"
SEPARATION = "D"


def direction(code: Column) -> Column:
    """Movement direction of a code column: 'A', 'D' or null (unrecognised).

    The code is compared as text, and also upper-cased against the aliases.
    """
    txt = code.cast("string")
    up = F.upper(txt)
    return (F.when(txt.isin(ADMISSION_CODES) | up.isin(ADMISSION_ALIASES), F.lit(ADMISSION))
            .when(txt.isin(SEPARATION_CODES) | up.isin(SEPARATION_ALIASES), F.lit(SEPARATION)))


def movement_type_dim(spark: SparkSession) -> DataFrame:
    """Dimension (code, label, direction): 18 rows, fixed size, safe to broadcast."""
    return spark.createDataFrame(MOVEMENT_TYPE_LABELS, "code string, label string, direction string")


def dictionary(spark: SparkSession, name: str) -> DataFrame:
    """Dimension (code, label) of one coded column."""
    return spark.createDataFrame(DICTIONARIES[name], "code int, label string")


def region_dim(spark: SparkSession) -> DataFrame:
    return dictionary(spark, "regiao")
