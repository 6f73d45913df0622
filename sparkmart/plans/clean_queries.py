"""Source scans, scalar cleaning, dedup and the three cleaning jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import labels as L
from ..functions import money as M
from ..functions import text as T
from ..operators import clean as C
from ..operators.dedup import keep_first
from ..sources import files
from ..sources import store as ST
from . import oracle_exprs as X
from .mart_store import Store
from .oracle_feeds import with_ctes
from .registry import query

# ----------------------------------------------------------------- SQL parts

SALES_PARSED = f"""SELECT *, {X.parse_date('date')} AS date_facture,
  {X.norm_service('service_type')} AS service, {X.norm_status('statut_paiement')} AS statut
FROM sales"""

_BAD = f"({X.safe_number('total')} IS NULL OR {X.safe_number('total')} IN (0, 999))"

SALES_FIRST = """SELECT * FROM sales_parsed WHERE date_facture IS NOT NULL AND client IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY facture_id ORDER BY seq) = 1"""
_FRACTION = f"({X.safe_number('quantite')} IS NOT NULL AND {X.integral(X.safe_number('quantite'))} IS NULL)"

SALES_CLEAN = f"""SELECT seq, facture_id, date_facture, statut AS statut_paiement,
  client AS nom_client, telephone, employe_en_charge AS nom_employe, service, description,
  {X.integral(X.safe_number('quantite'))} AS quantite,
  {X.money_int(X.safe_number('prix_unitaire'))} AS prix_unitaire,
  {X.money_int(f"CASE WHEN {_BAD} THEN {X.safe_number('quantite')} * {X.safe_number('prix_unitaire')} ELSE {X.safe_number('total')} END")} AS total_ligne,
  {_BAD} AS recomputed
FROM sales_first WHERE NOT {_FRACTION}"""

_PNUM = X.safe_number("prix_achat_total")
PURCH_CLEAN = f"""SELECT seq, date_achat, {X.strip('fournisseur')} AS nom_fournisseur,
  {X.strip('article')} AS libelle_article, {X.strip('categorie')} AS libelle_categorie,
  {X.integral(X.safe_number('quantite'))} AS quantite,
  {X.money_int(f"CASE WHEN COALESCE({_PNUM} < 0, false) THEN abs({_PNUM}) ELSE {_PNUM} END")} AS prix_achat_total,
  {X.strip('mode_paiement')} AS mode_paiement
FROM (SELECT *, {X.parse_date('date')} AS date_achat FROM purchases
      WHERE NOT (date IS NULL AND fournisseur IS NULL AND article IS NULL AND categorie IS NULL
                 AND quantite IS NULL AND prix_achat_total IS NULL AND mode_paiement IS NULL)
        AND fournisseur IS NOT NULL AND article IS NOT NULL) p
WHERE date_achat IS NOT NULL AND NOT {_FRACTION}"""

_CT = ["nom_client", "entreprise", "telephone", "email", "ville"]
CLIENTS_CLEAN = f"""SELECT seq, nom_client, entreprise, telephone, email, {X.norm_city('ville')} AS ville
FROM (SELECT seq, {', '.join(f"{X.clean_text(c)} AS {c}" for c in _CT)} FROM clients) c
QUALIFY row_number() OVER (PARTITION BY {X.lower_key('nom_client')}
                           ORDER BY {X.is_upper('nom_client')}, seq) = 1"""

SALES_CTES = [("sales_parsed", SALES_PARSED), ("sales_first", SALES_FIRST), ("sales_clean", SALES_CLEAN)]
PURCH_CTES = [("purch_clean", PURCH_CLEAN)]
_PURCH_REJECTS = f"""SELECT seq, {X.parse_date('date')} AS date_achat, fournisseur, article, quantite, prix_achat_total,
  'quantite:not_whole' AS reason FROM purchases
WHERE fournisseur IS NOT NULL AND article IS NOT NULL AND {X.parse_date('date')} IS NOT NULL AND {_FRACTION}"""
CLIENT_CTES = [("clients_clean", CLIENTS_CLEAN)]

# ---------------------------------------------------------------- raw scans




def _scanned(spark, sf, name):
    """The landed source files, scanned as text."""
    df = files.scan_source(spark, name, *Store.of(spark, sf).landed(name))
    return df.withColumn("seq", F.col("seq").cast("bigint"))


@query("raw_scan_orders", with_ctes("SELECT * FROM sales", feeds=["sales"]))
def raw_scan_orders(spark, sf):
    return _scanned(spark, sf, "sales")


@query("raw_scan_purchases", with_ctes("SELECT * FROM purchases", feeds=["purchases"]))
def raw_scan_purchases(spark, sf):
    return _scanned(spark, sf, "purchases")


@query("raw_scan_clients", with_ctes("SELECT * FROM clients", feeds=["clients"]))
def raw_scan_clients(spark, sf):
    return _scanned(spark, sf, "clients")


@query("raw_archive", with_ctes("SELECT *, true AS stamped FROM sales", feeds=["sales"]))
def raw_archive(spark, sf):
    """The archived sales, as the current version of the raw tables has them."""
    df = ST.read_published(spark, Store.of(spark, sf).raw_set("sales"), "sales")
    return df.withColumn("seq", F.col("seq").cast("bigint")).withColumn("stamped", F.col("charge_le").isNotNull()).drop("charge_le")


# ------------------------------------------------------------------ scalars


@query("parse_dates", with_ctes(f"SELECT seq, date, {X.parse_date('date')} AS date_facture FROM sales",
                                feeds=["sales"]))
def parse_dates(spark, sf):
    return Store.of(spark, sf).raw("sales").select("seq", "date", D.parse_date("date").alias("date_facture"))


@query("normalise_labels", with_ctes(f"""
SELECT 'service' AS kind, service_type AS raw_value, {X.norm_service('service_type')} AS canonical,
       COUNT(*) AS n FROM sales GROUP BY 2
UNION ALL
SELECT 'status', statut_paiement, {X.norm_status('statut_paiement')}, COUNT(*) FROM sales GROUP BY 2
UNION ALL
SELECT 'city', ville, {X.norm_city('ville')}, COUNT(*) FROM clients GROUP BY 2""",
                                     feeds=["sales", "clients"]))
def normalise_labels(spark, sf):
    """One scan of each source: its labels as (kind, value) pairs, counted, then normalised once per distinct value."""
    store = Store.of(spark, sf)
    pair = lambda kind, col: F.struct(F.lit(kind).alias("kind"), F.col(col).alias("raw_value"))
    sales = store.raw("sales").select(F.explode(F.array(pair("service", "service_type"), pair("status", "statut_paiement"))).alias("p"))
    pairs = sales.select("p.*").unionByName(store.raw("clients").select(F.lit("city").alias("kind"), F.col("ville").alias("raw_value")))
    kind, value = F.col("kind"), "raw_value"
    canonical = (F.when(kind == "service", L.normalise_service(value)).when(kind == "status", L.normalise_status(value))
                 .otherwise(L.normalise_city(value)))
    return (pairs.groupBy("kind", "raw_value").agg(F.count(F.lit(1)).alias("n"))
            .select("kind", "raw_value", canonical.alias("canonical"), "n"))


@query("safe_numeric", with_ctes(f"""
SELECT seq, {X.safe_number('quantite')} AS quantite_num, {X.safe_number('prix_unitaire')} AS prix_num,
       {X.safe_number('total')} AS total_num FROM sales""", feeds=["sales"]))
def safe_numeric(spark, sf):
    s = Store.of(spark, sf).raw("sales")
    return s.select("seq", M.safe_number("quantite").alias("quantite_num"),
                    M.safe_number("prix_unitaire").alias("prix_num"),
                    M.safe_number("total").alias("total_num"))


@query("recompute_totals", with_ctes(f"""
SELECT seq, facture_id,
  CAST(CASE WHEN {_BAD} THEN {X.safe_number('quantite')} * {X.safe_number('prix_unitaire')}
       ELSE {X.safe_number('total')} END AS DECIMAL(18,2)) AS total_ligne,
  {_BAD} AS recomputed FROM sales""", feeds=["sales"]))
def recompute_totals(spark, sf):
    r = C.recompute_totals(Store.of(spark, sf).raw("sales"))
    return r.select("seq", "facture_id", F.col("total_num").cast("decimal(18,2)").alias("total_ligne"),
                    "recomputed")


@query("round_money", with_ctes(f"""
SELECT seq, {X.safe_number('prix_achat_total')} / 4 AS quarter,
  CAST(round_even({X.safe_number('prix_achat_total')} / 4, 0) AS BIGINT) AS r0,
  CAST(round_even({X.safe_number('prix_achat_total')} / 4, 2) AS DECIMAL(18,2)) AS r2
FROM purchases""", feeds=["purchases"]))
def round_money(spark, sf):
    p = Store.of(spark, sf).raw("purchases")
    x = M.safe_number("prix_achat_total") / 4
    return p.select("seq", x.alias("quarter"), M.round_even(x, 0).cast("bigint").alias("r0"),
                    M.round_even(x, 2).cast("decimal(18,2)").alias("r2"))


@query("fix_negatives", with_ctes(f"""
SELECT seq, {_PNUM} AS amount_raw,
  CASE WHEN COALESCE({_PNUM} < 0, false) THEN abs({_PNUM}) ELSE {_PNUM} END AS amount,
  COALESCE({_PNUM} < 0, false) AS was_negative FROM purchases""", feeds=["purchases"]))
def fix_negatives(spark, sf):
    return C.fix_negatives(Store.of(spark, sf).raw("purchases")).select("seq", "amount_raw", "amount", "was_negative")


@query("drop_empty_rows", with_ctes("""
SELECT * FROM purchases WHERE NOT (date IS NULL AND fournisseur IS NULL AND article IS NULL
  AND categorie IS NULL AND quantite IS NULL AND prix_achat_total IS NULL AND mode_paiement IS NULL)""",
                                    feeds=["purchases"]))
def drop_empty_rows(spark, sf):
    return C.drop_empty_rows(Store.of(spark, sf).raw("purchases"))


@query("slugify", with_ctes(f"""
SELECT DISTINCT {X.norm_service('service_type')} AS label, {X.slugify(X.norm_service('service_type'))} AS slug
FROM sales""", feeds=["sales"]))
def slugify(spark, sf):
    s = Store.of(spark, sf).raw("sales").select(L.normalise_service("service_type").alias("label")).distinct()
    return s.select("label", T.slugify("label").alias("slug"))


# ---------------------------------------------------------------- dedup


@query("dedup_keep_first", with_ctes("""
SELECT facture_id, seq, client FROM sales
QUALIFY row_number() OVER (PARTITION BY facture_id ORDER BY seq) = 1""", feeds=["sales"]))
def dedup_keep_first(spark, sf):
    return keep_first(Store.of(spark, sf).raw("sales"), ["facture_id"], ["seq"]).select("facture_id", "seq", "client")


@query("dedup_clients", with_ctes(f"""
SELECT {X.lower_key('nom_client')} AS nom_key,
       arg_min({X.strip('nom_client')}, ({X.is_upper('nom_client')}, seq)) AS nom_client,
       COUNT(*) AS n_rows
FROM clients GROUP BY 1""", feeds=["clients"]))
def dedup_clients(spark, sf):
    c = Store.of(spark, sf).raw("clients")
    key = T.lower_key("nom_client")
    # one aggregate: survivor by (ALL CAPS last, then file order) and group size
    return c.groupBy(key.alias("nom_key")).agg(
        F.min_by(T.strip("nom_client"), F.struct(T.is_all_upper("nom_client"), F.col("seq"))).alias("nom_client"),
        F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------ cleaning jobs


@query("clean_sales", with_ctes("SELECT * FROM sales_clean", feeds=["sales"], ctes=SALES_CTES))
def clean_sales(spark, sf):
    return C.clean_sales(Store.of(spark, sf).raw("sales"))


@query("sales_rejects", with_ctes(f"""SELECT seq, facture_id, quantite, 'quantite:not_whole' AS reason
FROM sales_first WHERE {_FRACTION}""", feeds=["sales"], ctes=SALES_CTES))
def sales_rejects(spark, sf):
    return C.sales_rejects(Store.of(spark, sf).raw("sales"))


@query("clean_purchases", with_ctes("SELECT * FROM purch_clean", feeds=["purchases"], ctes=PURCH_CTES))
def clean_purchases(spark, sf):
    return C.clean_purchases(Store.of(spark, sf).raw("purchases"))


@query("purchases_rejects", with_ctes(_PURCH_REJECTS, feeds=["purchases"]))
def purchases_rejects(spark, sf):
    return C.purchases_rejects(Store.of(spark, sf).raw("purchases"))


@query("clean_clients", with_ctes("SELECT * FROM clients_clean", feeds=["clients"], ctes=CLIENT_CTES))
def clean_clients(spark, sf):
    return C.clean_clients(Store.of(spark, sf).raw("clients"))


@query("clean_report", with_ctes("""
SELECT COUNT(*) AS n_input,
  SUM(CASE WHEN date_facture IS NULL OR client IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_dropped_missing,
  (COUNT(*) - SUM(CASE WHEN date_facture IS NULL OR client IS NULL THEN 1 ELSE 0 END)
     - (SELECT COUNT(*) FROM sales_first))::BIGINT AS n_duplicates,
  ((SELECT COUNT(*) FROM sales_first) - (SELECT COUNT(*) FROM sales_clean))::BIGINT AS n_rejected,
  (SELECT SUM(CASE WHEN recomputed THEN 1 ELSE 0 END) FROM sales_clean)::BIGINT AS n_recomputed,
  (SELECT COUNT(*) FROM sales_clean) AS n_kept,
  (SELECT SUM(CASE WHEN nom_employe IS NULL THEN 1 ELSE 0 END) FROM sales_clean)::BIGINT AS n_without_employee
FROM sales_parsed""", feeds=["sales"], ctes=SALES_CTES))
def clean_report(spark, sf):
    """The step counters that the job itself observed."""
    return Store.of(spark, sf).counters("sales")


@query("clean_report_purchases", with_ctes("""
SELECT COUNT(*) AS n_input, SUM(CASE WHEN empty THEN 1 ELSE 0 END)::BIGINT AS n_empty,
  SUM(CASE WHEN NOT empty AND partial THEN 1 ELSE 0 END)::BIGINT AS n_incomplete,
  SUM(CASE WHEN NOT empty AND NOT partial AND d IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_undated,
  (SELECT COUNT(*) FROM purch_rejects) AS n_rejected,
  SUM(CASE WHEN NOT empty AND NOT partial AND d IS NOT NULL AND neg THEN 1 ELSE 0 END)::BIGINT AS n_sign_fixed,
  (SELECT COUNT(*) FROM purch_clean) AS n_kept
FROM (SELECT date IS NULL AND fournisseur IS NULL AND article IS NULL AND categorie IS NULL AND quantite IS NULL
        AND prix_achat_total IS NULL AND mode_paiement IS NULL AS empty, fournisseur IS NULL OR article IS NULL AS partial,
        """ + X.parse_date("date") + """ AS d, COALESCE(""" + X.safe_number("prix_achat_total") + """ < 0, false) AS neg
      FROM purchases) p""",
                                           feeds=["purchases"], ctes=[*PURCH_CTES, ("purch_rejects", _PURCH_REJECTS)]))
def clean_report_purchases(spark, sf):
    return Store.of(spark, sf).counters("purchases")


@query("purchases_balance", with_ctes("""
SELECT COUNT(*) AS n_input, SUM(CASE WHEN empty THEN 1 ELSE 0 END)::BIGINT AS n_empty,
  SUM(CASE WHEN NOT empty AND partial THEN 1 ELSE 0 END)::BIGINT AS n_incomplete,
  SUM(CASE WHEN NOT empty AND NOT partial AND d IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_undated,
  (SELECT COUNT(*) FROM purch_rejects) AS n_rejected, (SELECT COUNT(*) FROM purch_clean) AS n_kept
FROM (SELECT date IS NULL AND fournisseur IS NULL AND article IS NULL AND categorie IS NULL AND quantite IS NULL
        AND prix_achat_total IS NULL AND mode_paiement IS NULL AS empty, fournisseur IS NULL OR article IS NULL AS partial,
        """ + X.parse_date("date") + """ AS d FROM purchases) p""",
                                      feeds=["purchases"], ctes=[*PURCH_CTES, ("purch_rejects", _PURCH_REJECTS)]))
def purchases_balance(spark, sf):
    """Where each input row went: the other counters add up to n_input."""
    r = C.purchases_report(Store.of(spark, sf).raw("purchases"))
    return r.select("n_input", "n_empty", "n_incomplete", "n_undated", "n_rejected", "n_kept")


@query("clean_report_clients", with_ctes(f"""
SELECT COUNT(*) AS n_input, (COUNT(*) - (SELECT COUNT(*) FROM clients_clean))::BIGINT AS n_duplicates,
  SUM(CASE WHEN COALESCE({X.norm_city('v')} <> v, false) THEN 1 ELSE 0 END)::BIGINT AS n_city_normalised,
  (SELECT COUNT(*) FROM clients_clean) AS n_kept
FROM (SELECT {X.clean_text('ville')} AS v FROM clients) c""", feeds=["clients"], ctes=CLIENT_CTES))
def clean_report_clients(spark, sf):
    return Store.of(spark, sf).counters("clients")
