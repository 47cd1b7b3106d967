"""SQL text of the derived views, for the DuckDB oracle (and Spark SQL users).

The same text runs in Spark SQL and DuckDB: STRING casts, year()/month(),
CASE, count_if.  Each oracle query is ``WITH <views> SELECT ...``.
"""

MOV = """mov AS (
SELECT l.l_orderkey*10 + l.l_linenumber AS id,
 CAST((year(o.o_orderdate)+25)*100 + month(o.o_orderdate) AS STRING) AS competencia_mov,
 CAST((year(l.l_shipdate)+25)*100 + month(l.l_shipdate) AS STRING) AS competencia_dec,
 CASE WHEN l.l_returnflag='R' THEN 'EXC'
      WHEN year(l.l_shipdate)*100+month(l.l_shipdate) > year(o.o_orderdate)*100+month(o.o_orderdate) THEN 'FOR'
      ELSE 'MOV' END AS tipo,
 CASE WHEN l.l_linestatus='F' THEN
   CASE l.l_partkey % 7 WHEN 0 THEN '10' WHEN 1 THEN '20' WHEN 2 THEN '25' WHEN 3 THEN '35' WHEN 4 THEN '70' WHEN 5 THEN '97' ELSE 'XX' END
 ELSE
   CASE l.l_suppkey % 11 WHEN 0 THEN '31' WHEN 1 THEN '32' WHEN 2 THEN '33' WHEN 3 THEN '40' WHEN 4 THEN '43' WHEN 5 THEN '45' WHEN 6 THEN '50' WHEN 7 THEN '60' WHEN 8 THEN '80' WHEN 9 THEN '90' ELSE '98' END
 END AS tipo_movimentacao,
 CASE WHEN l.l_linestatus='F' THEN 1 ELSE -1 END AS saldo_movimentacao,
 n.n_regionkey+1 AS regiao, n.n_nationkey AS uf, o.o_custkey AS cnpj, l.l_suppkey AS cpf, o.o_custkey % 97 AS municipio,
 p.p_type AS secao, p.p_brand AS subclasse, p.p_size AS idade, l.l_quantity AS horas_contratuais, l.l_extendedprice AS salario,
 (o.o_custkey + l.l_suppkey) % 3 + 1 AS origem_informacao
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey
 JOIN nation n ON c.c_nationkey=n.n_nationkey JOIN part p ON l.l_partkey=p.p_partkey)"""

# direction of a movement code (balance lists + aliases)
DIR = """CASE WHEN {c} IN ('10','20','25','35','70','97','1','2','3','5','7')
            OR upper({c}) IN ('ADMISSAO','ADMISSÃO','ADMIT','A') THEN 'A'
       WHEN {c} IN ('31','32','33','40','43','45','50','60','80','90','98','99','4','6','8','9')
            OR upper({c}) IN ('DESLIGAMENTO','DEMISSAO','DEMISSÃO','DESLIG','D') THEN 'D' END"""


def dir_of(c: str = "tipo_movimentacao") -> str:
    return DIR.format(c=c)


# classified, sign-adjusted movements
K = f"""k AS (SELECT competencia_mov AS competencia, {dir_of()} AS m,
  CASE WHEN tipo='EXC' THEN -saldo_movimentacao ELSE saldo_movimentacao END AS s FROM mov)"""

# monthly balance E3
BAL = """bal AS (SELECT competencia, admissoes, desligamentos, admissoes-desligamentos AS saldo_mensal FROM (
 SELECT competencia, CAST(coalesce(sum(CASE WHEN m='A' THEN s END),0) AS BIGINT) AS admissoes,
  CAST(abs(coalesce(sum(CASE WHEN m='D' THEN s END),0)) AS BIGINT) AS desligamentos
 FROM k WHERE m IS NOT NULL GROUP BY competencia) g)"""

# anchored running stock F1
STOCK = """stock AS (SELECT competencia, admissoes, desligamentos, saldo_mensal,
  CAST(sum(saldo_mensal + CASE WHEN competencia='202001' THEN 39054507 ELSE 0 END)
       OVER (ORDER BY competencia ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS estoque FROM bal)"""

ESTAB = """estab AS (SELECT CAST(cnpj AS STRING) AS cnpj, competencia_mov AS competencia, min(uf) AS uf, min(secao) AS secao,
  CAST(count_if(saldo_movimentacao=1) AS BIGINT) AS admitidos, CAST(count_if(saldo_movimentacao=-1) AS BIGINT) AS desligados,
  CAST(sum(CASE WHEN tipo='EXC' THEN -saldo_movimentacao ELSE saldo_movimentacao END) AS BIGINT) AS saldo
 FROM mov GROUP BY cnpj, competencia_mov)"""

CATALOG = """catalog AS (SELECT
  concat(CASE WHEN o_orderstatus='F' THEN 'MOV' WHEN o_orderstatus='O' THEN 'FOR' ELSE 'EXC' END,
         CAST((year(o_orderdate)+25)*100 + month(o_orderdate) AS STRING), '_', CAST(o_orderkey AS STRING),
         CASE WHEN o_orderkey % 3 = 0 THEN '.7z' WHEN o_orderkey % 3 = 1 THEN '.txt' ELSE '.parquet' END) AS file_name,
  o_orderkey AS file_id, CAST(round(o_totalprice*100) AS BIGINT) AS size_bytes, o_orderdate AS mtime,
  CAST(o_custkey % 27 AS INTEGER) AS uf, o_orderpriority IN ('1-URGENT','2-HIGH') AS processed
 FROM orders)"""

OPLOG = """oplog AS (SELECT event_id AS op_id, event_type AS operation, (event_id % 5) <> 0 AS success,
  value AS duration, ts, user_id AS item_id, props AS details FROM events)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
