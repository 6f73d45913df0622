"""DuckDB SQL of the raw feeds (mirror of ``sources/feeds.py``)."""

from __future__ import annotations

from ..sources.feeds import (CITIES, MONTH_WORDS, PAYMENT_MODES, PRIORITY_EMPLOYEE,
                             PTYPE_SERVICE, STATUS_ORDER, STATUS_RAW, STATUS_RAW_LOWER,
                             service_misspellings)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(xs) -> str:
    return "[" + ", ".join(q(x) for x in xs) + "]"


def case(col: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {col} = {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {arms} ELSE {default} END)"


def hash_seq(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15))::BIGINT"


def date_text(d: str, m: str) -> str:
    return f"""(CASE WHEN {m} < 70 THEN strftime({d}, '%-d/%-m/%Y')
      WHEN {m} < 85 THEN strftime({d}, '%Y-%m-%d')
      WHEN {m} < 93 THEN strftime({d}, '%d-%m-%Y')
      WHEN {m} < 98 THEN 'Début ' || list_extract({lst(MONTH_WORDS)}, month({d})) || ' ' || CAST(year({d}) AS VARCHAR)
      WHEN {m} = 98 THEN 'pas une date' END)"""


def service_text(service: str, m: str, k: str) -> str:
    arms = " ".join(
        f"WHEN {service} = {q(canon)} THEN list_extract({lst(names)}, CAST({k} % {len(names)} + 1 AS INTEGER))"
        for canon, names in service_misspellings().items())
    alias = f"(CASE {arms} ELSE {service} END)"
    return f"""(CASE WHEN {m} % 15 = 1 THEN {alias}
      WHEN {m} % 15 = 2 THEN '  ' || upper({service}) || ' ' ELSE {service} END)"""


def unit_price(ep: str, qty: str) -> str:
    return f"(CAST(round({ep} * 100) AS BIGINT) // ({qty} * 100))"


SALES_FEED = f"""
SELECT
  {hash_seq('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')} AS seq,
  {date_text('CAST(o_orderdate AS DATE)', 'm')} AS date,
  'F' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS facture_id,
  CASE WHEN m = 44 THEN NULL WHEN m % 10 = 3 THEN upper(c_name) ELSE c_name END AS client,
  CASE WHEN m % 12 = 0 THEN NULL ELSE '06' || CAST(c_custkey AS VARCHAR) END AS telephone,
  {service_text('svc', 'm', 'l_linenumber')} AS service_type,
  p_name AS description,
  CASE WHEN m = 13 THEN '2.5' WHEN m = 14 THEN 'abc' ELSE CAST(qty AS VARCHAR) END AS quantite,
  CASE WHEN m % 33 = 5 THEN NULL ELSE CAST(unit AS VARCHAR) END AS prix_unitaire,
  CASE WHEN m IN (20, 21, 22, 23) THEN '0' WHEN m = 24 THEN '999' WHEN m = 25 THEN NULL
       WHEN m = 26 THEN 'nan' ELSE CAST(qty * unit AS VARCHAR) END AS total,
  CASE WHEN o_orderkey % 25 = 0 THEN NULL WHEN m % 10 = 4 THEN upper(emp) ELSE emp END AS employe_en_charge,
  CASE WHEN m = 77 THEN NULL WHEN m % 9 = 1 THEN {case('o_orderstatus', STATUS_RAW_LOWER)}
       ELSE {case('o_orderstatus', STATUS_RAW)} END AS statut_paiement
FROM (
  SELECT *, {unit_price('l_extendedprice', 'qty')} AS unit
  FROM (
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
           o_orderkey, o_custkey, o_orderstatus, o_orderdate, p_name, c_custkey, c_name,
           (l_orderkey * 31 + l_linenumber * 7 + l_partkey) % 100 AS m,
           CAST(l_quantity AS BIGINT) AS qty,
           {case('p_type', PTYPE_SERVICE, 'p_type')} AS svc,
           {case('o_orderpriority', PRIORITY_EMPLOYEE)} AS emp
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey
  ) b
) x
"""

PURCHASES_FEED = f"""
SELECT
  {hash_seq("'p'", 'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')} AS seq,
  CASE WHEN m = 0 THEN NULL ELSE {date_text('CAST(l_shipdate AS DATE)', 'm')} END AS date,
  CASE WHEN m = 0 OR m = 1 THEN NULL WHEN m % 10 = 2 THEN ' ' || s_name || ' ' ELSE s_name END AS fournisseur,
  CASE WHEN m = 0 OR m = 2 THEN NULL ELSE p_name END AS article,
  CASE WHEN m = 0 OR m = 3 THEN NULL ELSE p_brand END AS categorie,
  CASE WHEN m = 0 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantite,
  CASE WHEN m = 0 THEN NULL WHEN m % 50 = 7 THEN '-' || CAST(cost AS VARCHAR)
       ELSE CAST(cost AS VARCHAR) END AS prix_achat_total,
  CASE WHEN m = 0 OR m % 20 = 9 THEN NULL
       ELSE list_extract({lst(PAYMENT_MODES)}, CAST(m % 4 + 1 AS INTEGER)) END AS mode_paiement
FROM (
  SELECT *, (CAST(round(l_extendedprice * 100) AS BIGINT)
             * (100 - CAST(round(l_discount * 100) AS BIGINT))) // 10000 AS cost,
         (l_orderkey * 17 + l_linenumber * 3 + l_suppkey) % 100 AS m
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
) x
"""

CLIENTS_FEED = f"""
SELECT
  c_custkey * 2 + CASE WHEN is_copy = (c_custkey % 20 = 0) THEN 0 ELSE 1 END AS seq,
  CASE WHEN c_custkey % 13 = 0 THEN '  ' || name ELSE name END AS nom_client,
  CASE WHEN c_custkey % 9 = 0 THEN '' ELSE c_mktsegment END AS entreprise,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '06' || CAST(c_custkey AS VARCHAR) END AS telephone,
  CASE WHEN c_custkey % 11 = 0 THEN 'nan' ELSE lower(c_name) || '@mail.cg' END AS email,
  list_extract({lst(CITIES)}, CAST(c_nationkey % 8 + 1 AS INTEGER)) AS ville,
  CAST(NULL AS VARCHAR) AS notes
FROM (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, false AS is_copy, c_name AS name FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, true AS is_copy, upper(c_name) AS name
  FROM customer WHERE c_custkey % 10 = 0
) u
"""

ORDER_FEED = f"""
SELECT
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_key,
  {hash_seq("'o'", 'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')} AS seq,
  CASE WHEN m = 1 THEN '' WHEN m = 2 THEN repeat('x', 151) WHEN m % 10 = 6 THEN upper(c_name)
       ELSE c_name END AS client,
  CASE WHEN m = 3 THEN repeat('9', 21) WHEN m % 8 = 0 THEN ''
       ELSE '06' || CAST(c_custkey AS VARCHAR) END AS telephone,
  CAST(o_orderdate AS DATE) AS date_facture,
  CASE WHEN m = 4 THEN 'Jardinage' ELSE {case('p_type', PTYPE_SERVICE, 'p_type')} END AS service,
  CASE WHEN m = 5 THEN '' ELSE {case('o_orderpriority', PRIORITY_EMPLOYEE)} END AS employe,
  CASE WHEN m = 6 THEN 'En attente' ELSE {case('o_orderstatus', STATUS_ORDER)} END AS statut_paiement,
  CASE WHEN m = 7 THEN repeat('d', 256) ELSE p_name END AS description,
  CASE WHEN m = 8 THEN CAST(0 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS quantite,
  CASE WHEN m = 9 THEN CAST(0 AS BIGINT) WHEN m = 10 THEN CAST(NULL AS BIGINT)
       ELSE {unit_price('l_extendedprice', 'CAST(l_quantity AS BIGINT)')} END AS prix_unitaire
FROM (
  SELECT *, (l_orderkey * 13 + l_linenumber * 5 + l_partkey) % 100 AS m
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
) x
"""


FEEDS = {"sales": SALES_FEED, "purchases": PURCHASES_FEED, "clients": CLIENTS_FEED,
         "orderfeed": ORDER_FEED}


def with_ctes(body: str, feeds=(), ctes=()) -> str:
    """Prefix a query with the feed CTEs it names, then its own CTEs."""
    parts = [f"{n} AS ({FEEDS[n]})" for n in feeds] + [f"{n} AS ({s})" for n, s in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
