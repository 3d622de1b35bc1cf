"""DuckDB SQL of the store queries, written from the definitions."""

from __future__ import annotations

_LOADS = """
lines AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         month(l_shipdate) % 3 = 0 AS third, l_partkey, l_linestatus, l_quantity
  FROM lineitem),
before AS (
  SELECT * REPLACE (CASE WHEN third AND l_orderkey % 13 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
  FROM lines WHERE NOT (third AND l_orderkey % 17 = 0)),
after AS (SELECT * FROM lines WHERE NOT (third AND l_orderkey % 19 = 0))"""

_KEYED = "month, l_orderkey, l_linenumber, list_sort(list((l_partkey, l_linestatus, l_quantity))) AS rows"

ORACLES: dict[str, str] = {
    "landing_changes": f"""WITH {_LOADS},
a AS (SELECT {_KEYED} FROM before GROUP BY ALL),
b AS (SELECT {_KEYED} FROM after GROUP BY ALL)
SELECT CAST(month AS VARCHAR) AS month, count(*) FILTER (a.rows IS NULL) AS inserted, count(*) FILTER (a.rows <> b.rows) AS changed,
       count(*) FILTER (b.rows IS NULL) AS removed, count(*) FILTER (a.rows = b.rows) AS same
FROM a FULL JOIN b USING (month, l_orderkey, l_linenumber) GROUP BY month""",
    "table_after_changes": f"""WITH {_LOADS}
SELECT l_orderkey, l_linenumber, CAST(month AS VARCHAR) AS month, l_partkey, l_linestatus, l_quantity FROM after""",
    "table_by_name": f"""WITH {_LOADS}
SELECT l_orderkey, l_linenumber, CAST(month AS VARCHAR) AS month, l_partkey, l_linestatus, 2 * l_quantity AS l_quantity
FROM lines WHERE l_linestatus <> 'O'""",
    "land_unknown_kind": """SELECT '2024-01-31' AS updated_on, l_orderkey AS pedido, CAST(l_linenumber AS BIGINT) AS parcela,
       round(l_extendedprice, 2) AS valor_bruto, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS data_da_venda,
       CASE WHEN l_linenumber = 2 THEN 's/n' ELSE CAST(l_suppkey AS VARCHAR) END AS loja, '00' || l_partkey AS codigo,
       CASE WHEN l_tax > 0 THEN l_partkey END AS terminal,
       'updated_on:date,pedido:bigint,parcela:bigint,valor_bruto:double,data_da_venda:date,loja:string,codigo:string,terminal:bigint' AS types
FROM lineitem""",
    "read_split_members": """SELECT CAST(l_orderkey AS VARCHAR) AS pedido, CAST(l_linenumber AS VARCHAR) AS parcela,
       'linha 1' || chr(10) || '"linha" 2; ' || l_partkey AS nota FROM lineitem""",
}
