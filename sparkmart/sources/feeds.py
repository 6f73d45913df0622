"""Raw order-data feeds derived from the star-schema tables.

The cleaning jobs expect untyped files with the anomalies of hand-kept
spreadsheets.  These functions derive such feeds from the parquet tables, one
row per source row (whole tables, nothing sampled).  Anomalies are placed by
deterministic arithmetic on the keys so the DuckDB oracle
(``plans/oracle_feeds.py``) rebuilds byte-identical feeds.

* sales     – one row per ``lineitem`` (invoice id = order key + line number,
              which repeats: the duplicate invoices of the spreadsheets)
* purchases – one row per ``lineitem`` (supplier, part brand as category)
* clients   – ``customer`` plus upper-cased copies of every tenth customer
* orders    – one order-entry event per ``lineitem``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import hash_seq
from ..functions.money import cents, idiv
from ..functions.vocab import MONTHS_FR, SERVICE_ALIASES
from .tables import read_table

# Generator constants (not source-system values): how the feeds are dressed.
PTYPE_SERVICE = {
    "ECONOMY": "Imprimerie", "LARGE": "Sérigraphie", "MEDIUM": "Maintenance",
    "PROMO": "Vidéosurveillance", "SMALL": "Imprimerie", "STANDARD": "Sérigraphie",
}
PRIORITY_EMPLOYEE = {
    "1-URGENT": "Alice Mbemba", "2-HIGH": "Bruno Ngoma", "3-MEDIUM": "Chantal Okemba",
    "4-NOT SPECIFIED": "David Itoua", "5-LOW": "Eva Loemba",
}
STATUS_RAW = {"F": "Payé", "O": "En attente", "P": "Partiel"}
STATUS_RAW_LOWER = {"F": "paye", "O": "non payé", "P": "partiel"}
STATUS_ORDER = {"F": "Payé", "O": "Non payé", "P": "Partiel"}
PAYMENT_MODES = ["Espèces", "Virement", "Mobile Money", "Chèque"]
CITIES = ["Brazzaville", "Pointe-Noire", "pointe noire", "PN", " pte-noire ", "Dolisie",
          "Nkayi", "None"]
MONTH_WORDS = [m[0].upper() + m[1:] for m in MONTHS_FR]


def service_misspellings() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for alias, canon in SERVICE_ALIASES.items():
        if alias != canon.lower():
            out.setdefault(canon, []).append(alias)
    return out


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(default if default is not None else F.lit(None).cast("string"))


def date_text(d: Column, m: Column) -> Column:
    """Render a date in one of the spreadsheet spellings, chosen by ``m`` (0..99)."""
    month_word = F.element_at(F.array(*[F.lit(w) for w in MONTH_WORDS]), F.month(d))
    return (
        F.when(m < 70, F.date_format(d, "d/M/yyyy"))
        .when(m < 85, F.date_format(d, "yyyy-MM-dd"))
        .when(m < 93, F.date_format(d, "dd-MM-yyyy"))
        .when(m < 98, F.concat(F.lit("Début "), month_word, F.lit(" "), F.year(d).cast("string")))
        .when(m == 98, F.lit("pas une date"))
    )


def _service_text(service: Column, m: Column, k: Column) -> Column:
    variants = service_misspellings()
    alias = None
    for canon, names in variants.items():
        pick = F.element_at(F.array(*[F.lit(n) for n in names]), (k % len(names) + 1).cast("int"))
        alias = F.when(service == canon, pick) if alias is None else alias.when(service == canon, pick)
    alias = alias.otherwise(service)
    return (F.when(m % 15 == 1, alias)
            .when(m % 15 == 2, F.concat(F.lit("  "), F.upper(service), F.lit(" ")))
            .otherwise(service))


def _unit_price(ep: Column, qty: Column) -> Column:
    return idiv(cents(ep), qty * 100)


def _dressed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their part, order and customer.

    Customers join the orders first, and the lines' part comes before their order, so what the
    exchanges carry stays narrow.  Lines and orders meet in a merge at any size, which keeps
    the lines of one order as they follow each other in the file.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_orderdate", "o_orderpriority").withColumn("o_orderdate", F.to_date("o_orderdate"))
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    return li.join(p, li.l_partkey == p.p_partkey).hint("merge").join(oc, F.col("l_orderkey") == F.col("o_orderkey"))


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _dressed_lines(spark, sf_dir)
    m = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 7 + F.col("l_partkey")) % 100
    qty = F.col("l_quantity").cast("bigint")
    # what several columns are made of is a column of its own first: computed once, and in small methods that the JIT compiles
    j = j.select("*", m.alias("_m"), qty.alias("_qty"), _unit_price(F.col("l_extendedprice"), qty).alias("_unit"),
                 _case(F.col("p_type"), PTYPE_SERVICE, F.col("p_type")).alias("_service"),
                 _case(F.col("o_orderpriority"), PRIORITY_EMPLOYEE).alias("_employee"))
    m, qty, unit, service, employee = (F.col(c) for c in ("_m", "_qty", "_unit", "_service", "_employee"))
    return j.select(
        hash_seq("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("seq"),
        date_text(F.to_date("o_orderdate"), m).alias("date"),
        F.concat(F.lit("F"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("facture_id"),
        F.when(m == 44, F.lit(None).cast("string"))
        .when(m % 10 == 3, F.upper("c_name")).otherwise(F.col("c_name")).alias("client"),
        F.when(m % 12 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("06"), F.col("c_custkey").cast("string"))).alias("telephone"),
        _service_text(service, m, F.col("l_linenumber")).alias("service_type"),
        F.col("p_name").alias("description"),
        F.when(m == 13, F.lit("2.5")).when(m == 14, F.lit("abc"))
        .otherwise(qty.cast("string")).alias("quantite"),
        F.when(m % 33 == 5, F.lit(None).cast("string")).otherwise(unit.cast("string")).alias("prix_unitaire"),
        F.when(m.isin(20, 21, 22, 23), F.lit("0")).when(m == 24, F.lit("999"))
        .when(m == 25, F.lit(None).cast("string")).when(m == 26, F.lit("nan"))
        .otherwise((qty * unit).cast("string")).alias("total"),
        F.when(F.col("o_orderkey") % 25 == 0, F.lit(None).cast("string"))
        .when(m % 10 == 4, F.upper(employee)).otherwise(employee).alias("employe_en_charge"),
        F.when(m == 77, F.lit(None).cast("string"))
        .when(m % 9 == 1, _case(F.col("o_orderstatus"), STATUS_RAW_LOWER))
        .otherwise(_case(F.col("o_orderstatus"), STATUS_RAW)).alias("statut_paiement"),
    )


def purchases_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand")
    li = li.withColumn("l_shipdate", F.to_date("l_shipdate"))  # narrower in the exchange
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)
    m = (F.col("l_orderkey") * 17 + F.col("l_linenumber") * 3 + F.col("l_suppkey")) % 100
    empty = m == 0
    null = F.lit(None).cast("string")
    disc = F.round(F.col("l_discount") * 100).cast("bigint")
    cost = idiv(cents(F.col("l_extendedprice")) * (100 - disc), F.lit(10000))
    return j.select(
        hash_seq(F.lit("p"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("seq"),
        F.when(empty, null).otherwise(date_text(F.to_date("l_shipdate"), m)).alias("date"),
        F.when(empty | (m == 1), null)
        .when(m % 10 == 2, F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")))
        .otherwise(F.col("s_name")).alias("fournisseur"),
        F.when(empty | (m == 2), null).otherwise(F.col("p_name")).alias("article"),
        F.when(empty | (m == 3), null).otherwise(F.col("p_brand")).alias("categorie"),
        F.when(empty, null).otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("quantite"),
        F.when(empty, null).when(m % 50 == 7, F.concat(F.lit("-"), cost.cast("string")))
        .otherwise(cost.cast("string")).alias("prix_achat_total"),
        F.when(empty | (m % 20 == 9), null)
        .otherwise(F.element_at(F.array(*[F.lit(x) for x in PAYMENT_MODES]), (m % 4 + 1).cast("int")))
        .alias("mode_paiement"),
    )


def clients_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    base = c.withColumn("is_copy", F.lit(False)).withColumn("name", F.col("c_name"))
    copies = (c.filter(F.col("c_custkey") % 10 == 0)
              .withColumn("is_copy", F.lit(True)).withColumn("name", F.upper("c_name")))
    u = base.unionByName(copies)
    k = F.col("c_custkey")
    return u.select(
        (k * 2 + F.when(F.col("is_copy") == (k % 20 == 0), 0).otherwise(1)).alias("seq"),
        F.when(k % 13 == 0, F.concat(F.lit("  "), F.col("name"))).otherwise(F.col("name")).alias("nom_client"),
        F.when(k % 9 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("entreprise"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("06"), k.cast("string"))).alias("telephone"),
        F.when(k % 11 == 0, F.lit("nan"))
        .otherwise(F.concat(F.lower("c_name"), F.lit("@mail.cg"))).alias("email"),
        F.element_at(F.array(*[F.lit(x) for x in CITIES]), (F.col("c_nationkey") % 8 + 1).cast("int")).alias("ville"),
        F.lit(None).cast("string").alias("notes"),
    )


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-entry events (typed like a JSON payload), some with broken fields."""
    j = _dressed_lines(spark, sf_dir)
    m = (F.col("l_orderkey") * 13 + F.col("l_linenumber") * 5 + F.col("l_partkey")) % 100
    qty = F.col("l_quantity").cast("bigint")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return j.select(
        F.concat_ws("-", *[F.col(x).cast("string") for x in keys]).alias("event_key"),
        hash_seq(F.lit("o"), *keys).alias("seq"),
        F.when(m == 1, F.lit("")).when(m == 2, F.repeat(F.lit("x"), 151))
        .when(m % 10 == 6, F.upper("c_name")).otherwise(F.col("c_name")).alias("client"),
        F.when(m == 3, F.repeat(F.lit("9"), 21)).when(m % 8 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("06"), F.col("c_custkey").cast("string"))).alias("telephone"),
        F.to_date("o_orderdate").alias("date_facture"),
        F.when(m == 4, F.lit("Jardinage"))
        .otherwise(_case(F.col("p_type"), PTYPE_SERVICE, F.col("p_type"))).alias("service"),
        F.when(m == 5, F.lit("")).otherwise(_case(F.col("o_orderpriority"), PRIORITY_EMPLOYEE)).alias("employe"),
        F.when(m == 6, F.lit("En attente"))
        .otherwise(_case(F.col("o_orderstatus"), STATUS_ORDER)).alias("statut_paiement"),
        F.when(m == 7, F.repeat(F.lit("d"), 256)).otherwise(F.col("p_name")).alias("description"),
        F.when(m == 8, F.lit(0).cast("bigint")).otherwise(qty).alias("quantite"),
        F.when(m == 9, F.lit(0).cast("bigint")).when(m == 10, F.lit(None).cast("bigint"))
        .otherwise(_unit_price(F.col("l_extendedprice"), qty)).alias("prix_unitaire"),
    )
