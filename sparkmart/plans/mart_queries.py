"""Dimension, fact and data-quality queries over the mart built from the feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.vocab import LENGTH_BOUNDS, PAYMENT_STATUSES, SERVICES
from ..operators import mart as MT
from ..operators import quality as Q
from ..operators import serving as SV
from ..operators import series as S
from ..operators.constraints import violations
from . import oracle_exprs as X
from .clean_queries import CLIENT_CTES, PURCH_CTES, SALES_CTES
from .mart_store import RULES, Store
from .oracle_feeds import q, with_ctes
from .registry import query


class Mart:
    """The mart's published tables: scans of the session's store, columns pruned."""

    def __init__(self, spark, sf):
        self.store = Store.of(spark, sf)

    of = classmethod(lambda cls, spark, sf: cls(spark, sf))

    clients = property(lambda self: self.store.mart("client"))
    employees = property(lambda self: self.store.mart("employe"))
    services = property(lambda self: self.store.mart("service"))
    suppliers = property(lambda self: self.store.mart("fournisseur"))
    categories = property(lambda self: self.store.mart("categorie_achat"))
    invoices = property(lambda self: self.store.mart("facture"))
    lines = property(lambda self: self.store.mart("ligne_facture"))
    purchase_facts = property(lambda self: self.store.mart("achat"))

    def daily(self):
        return self.store.mart_series().where(F.col("series") == S.GLOBAL).drop("series")

    def by_service(self):
        return self.store.mart_series().where(F.col("series") != S.GLOBAL).withColumnRenamed("series", "service")


# ----------------------------------------------------------------- SQL parts

_LK = X.lower_key
CLIENTS_MERGED = f"""SELECT md5({_LK('n')}) AS id_client, n AS nom_client, entreprise, telephone, email, ville
FROM (
  SELECT {X.strip('nom_client')} AS n, entreprise, telephone, email, ville, seq, src FROM (
    SELECT seq, nom_client, entreprise, telephone, email, ville, 0 AS src FROM clients_clean
    UNION ALL
    SELECT seq, nom_client, NULL, telephone, NULL, NULL, 1 FROM (
      SELECT seq, nom_client, telephone FROM sales_clean
      QUALIFY row_number() OVER (PARTITION BY nom_client ORDER BY seq) = 1) s) u) v
QUALIFY row_number() OVER (PARTITION BY {_LK('n')} ORDER BY src, {X.is_upper('n')}, seq) = 1"""

EMPLOYEES = f"""SELECT md5({_LK('e')}) AS id_employe, e AS nom_employe FROM (
  SELECT seq, {X.strip('nom_employe')} AS e FROM sales_clean) s WHERE e IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {_LK('e')} ORDER BY {X.is_upper('e')}, seq) = 1"""

_SEED = ", ".join(f"({q(s)})" for s in SERVICES)
SERVICES_SQL = f"""SELECT md5(libelle) AS id_service, libelle FROM (
  SELECT DISTINCT service AS libelle FROM sales_clean WHERE service IS NOT NULL
  UNION SELECT * FROM (VALUES {_SEED}) v(libelle)) t"""

SUPPLIERS = """SELECT DISTINCT md5(nom_fournisseur) AS id_fournisseur, nom_fournisseur AS nom
FROM purch_clean WHERE nom_fournisseur IS NOT NULL"""
CATEGORIES = """SELECT DISTINCT md5(libelle_categorie) AS id_categorie, libelle_categorie AS libelle
FROM purch_clean WHERE libelle_categorie IS NOT NULL"""

INVOICES = f"""SELECT s.facture_id AS id_facture, s.date_facture, s.statut_paiement, c.id_client, e.id_employe
FROM sales_clean s
LEFT JOIN clients_merged c ON {_LK('s.nom_client')} = {_LK('c.nom_client')}
LEFT JOIN employees e ON {_LK('s.nom_employe')} = {_LK('e.nom_employe')}"""

LINES = """SELECT s.facture_id AS id_facture, s.description, s.quantite, s.prix_unitaire, s.total_ligne,
  v.id_service FROM sales_clean s LEFT JOIN services v ON s.service = v.libelle"""

PURCHASE_FACTS = """SELECT p.date_achat, p.libelle_article, p.quantite, p.prix_achat_total, p.mode_paiement,
  f.id_fournisseur, c.id_categorie FROM purch_clean p
LEFT JOIN suppliers f ON p.nom_fournisseur = f.nom
LEFT JOIN categories c ON p.libelle_categorie = c.libelle"""

MART_DAILY = """SELECT i.date_facture AS ds, CAST(SUM(CAST(l.total_ligne AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS y,
  COUNT(DISTINCT i.id_facture) AS n_orders
FROM invoices i JOIN lines l ON i.id_facture = l.id_facture GROUP BY 1"""
MART_BY_SERVICE = """SELECT i.date_facture AS ds, v.libelle AS service,
  CAST(SUM(CAST(l.total_ligne AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS y, COUNT(DISTINCT i.id_facture) AS n_orders
FROM invoices i JOIN lines l ON i.id_facture = l.id_facture JOIN services v ON l.id_service = v.id_service
GROUP BY 1, 2"""

MART_CTES = SALES_CTES + PURCH_CTES + CLIENT_CTES + [
    ("clients_merged", CLIENTS_MERGED), ("employees", EMPLOYEES), ("services", SERVICES_SQL),
    ("suppliers", SUPPLIERS), ("categories", CATEGORIES), ("invoices", INVOICES),
    ("lines", LINES), ("purchase_facts", PURCHASE_FACTS),
    ("mart_daily", MART_DAILY), ("mart_by_service", MART_BY_SERVICE)]


def _sql(body):
    return with_ctes(body, feeds=["sales", "purchases", "clients"], ctes=MART_CTES)


# ------------------------------------------------------------- dimensions


@query("dim_clients_from_sales", _sql("""
SELECT nom_client, telephone FROM sales_clean
QUALIFY row_number() OVER (PARTITION BY nom_client ORDER BY seq) = 1"""))
def dim_clients_from_sales(spark, sf):
    return MT.clients_from_sales(Store.of(spark, sf).clean("sales")).select("nom_client", "telephone")


@query("merge_client_sources", _sql("SELECT * FROM clients_merged"))
def merge_client_sources(spark, sf):
    return Mart.of(spark, sf).clients


@query("dim_employees", _sql("SELECT * FROM employees"))
def dim_employees(spark, sf):
    return Mart.of(spark, sf).employees


@query("dim_suppliers", _sql("SELECT * FROM suppliers"))
def dim_suppliers(spark, sf):
    return Mart.of(spark, sf).suppliers


@query("dim_categories", _sql("SELECT * FROM categories"))
def dim_categories(spark, sf):
    return Mart.of(spark, sf).categories


@query("seed_dimension", _sql("SELECT * FROM services"))
def seed_dimension(spark, sf):
    return Mart.of(spark, sf).services


@query("dim_keys", _sql("""
SELECT 'client' AS dimension, id_client AS id, nom_client AS name FROM clients_merged
UNION ALL SELECT 'employe', id_employe, nom_employe FROM employees
UNION ALL SELECT 'service', id_service, libelle FROM services
UNION ALL SELECT 'fournisseur', id_fournisseur, nom FROM suppliers
UNION ALL SELECT 'categorie_achat', id_categorie, libelle FROM categories"""))
def dim_keys(spark, sf):
    m = Mart.of(spark, sf)

    def k(df, dim, idc, name):
        return df.select(F.lit(dim).alias("dimension"), F.col(idc).alias("id"), F.col(name).alias("name"))
    return (k(m.clients, "client", "id_client", "nom_client")
            .unionByName(k(m.employees, "employe", "id_employe", "nom_employe"))
            .unionByName(k(m.services, "service", "id_service", "libelle"))
            .unionByName(k(m.suppliers, "fournisseur", "id_fournisseur", "nom"))
            .unionByName(k(m.categories, "categorie_achat", "id_categorie", "libelle")))


# ------------------------------------------------------------------- facts


@query("fact_invoice", _sql("SELECT * FROM invoices"))
def fact_invoice(spark, sf):
    return Mart.of(spark, sf).invoices


@query("fact_line", _sql("SELECT * FROM lines"))
def fact_line(spark, sf):
    return Mart.of(spark, sf).lines


@query("fact_purchase", _sql("SELECT * FROM purchase_facts"))
def fact_purchase(spark, sf):
    return Mart.of(spark, sf).purchase_facts


@query("merge_duplicate_clients", _sql(f"""
SELECT s.facture_id AS id_facture, COALESCE(r.kept_id, md5({X.strip('s.nom_client')})) AS id_client
FROM sales_clean s LEFT JOIN (
  SELECT id_client, first_value(id_client) OVER (
    PARTITION BY {_LK('nom_client')} ORDER BY {X.is_upper('nom_client')}, seq) AS kept_id
  FROM (SELECT md5(n) AS id_client, n AS nom_client, min(seq) AS seq FROM (
    SELECT {X.clean_text('nom_client')} AS n, seq FROM clients) c WHERE n IS NOT NULL GROUP BY n) d
) r ON md5({X.strip('s.nom_client')}) = r.id_client"""))
def merge_duplicate_clients(spark, sf):
    raw = Store.of(spark, sf).raw("clients").select(T.clean_text("nom_client").alias("nom_client"), "seq")
    dim = (raw.filter(F.col("nom_client").isNotNull()).groupBy("nom_client").agg(F.min("seq").alias("seq"))
           .withColumn("id_client", F.md5("nom_client")))
    sales = Store.of(spark, sf).clean("sales")
    inv = sales.select(F.col("facture_id").alias("id_facture"), F.md5(T.strip("nom_client")).alias("id_client"))
    return MT.merge_duplicate_clients(dim, inv)


@query("merge_duplicate_clients_kept", _sql(f"""
SELECT md5(n) AS id_client, n AS nom_client, seq FROM (
  SELECT n, min(seq) AS seq FROM (SELECT {X.clean_text('nom_client')} AS n, seq FROM clients) c WHERE n IS NOT NULL GROUP BY n) d
QUALIFY row_number() OVER (PARTITION BY {_LK('n')} ORDER BY {X.is_upper('n')}, seq) = 1"""))
def merge_duplicate_clients_kept(spark, sf):
    raw = Store.of(spark, sf).raw("clients").select(T.clean_text("nom_client").alias("nom_client"), "seq")
    dim = (raw.filter(F.col("nom_client").isNotNull()).groupBy("nom_client").agg(F.min("seq").alias("seq"))
           .select(F.md5("nom_client").alias("id_client"), "nom_client", "seq"))
    return MT.without_duplicate_clients(dim)


# ------------------------------------------------------------ data quality


@query("dq_duplicates", _sql(f"""
SELECT 'client.nom_client' AS check_name, (SELECT COUNT(*) FROM (SELECT {_LK('nom_client')} FROM clients_merged GROUP BY 1 HAVING COUNT(*) > 1) t) AS n_dup_keys
UNION ALL SELECT 'employe.nom_employe', (SELECT COUNT(*) FROM (SELECT {_LK('nom_employe')} FROM employees GROUP BY 1 HAVING COUNT(*) > 1) t)
UNION ALL SELECT 'service.libelle', (SELECT COUNT(*) FROM (SELECT libelle FROM services GROUP BY 1 HAVING COUNT(*) > 1) t)
UNION ALL SELECT 'fournisseur.nom', (SELECT COUNT(*) FROM (SELECT nom FROM suppliers GROUP BY 1 HAVING COUNT(*) > 1) t)
UNION ALL SELECT 'categorie_achat.libelle', (SELECT COUNT(*) FROM (SELECT libelle FROM categories GROUP BY 1 HAVING COUNT(*) > 1) t)
UNION ALL SELECT 'facture.id_facture', (SELECT COUNT(*) FROM (SELECT id_facture FROM invoices GROUP BY 1 HAVING COUNT(*) > 1) t)
UNION ALL SELECT 'series.ds', (SELECT COUNT(*) FROM (SELECT ds FROM mart_daily GROUP BY 1 HAVING COUNT(*) > 1) t)
UNION ALL SELECT 'series_service.ds_service', (SELECT COUNT(*) FROM (SELECT ds, service FROM mart_by_service GROUP BY 1, 2 HAVING COUNT(*) > 1) t)"""))
def dq_duplicates(spark, sf):
    m = Mart.of(spark, sf)
    checks = [
        ("client.nom_client", m.clients, [T.lower_key("nom_client")]),
        ("employe.nom_employe", m.employees, [T.lower_key("nom_employe")]),
        ("service.libelle", m.services, [F.col("libelle")]),
        ("fournisseur.nom", m.suppliers, [F.col("nom")]),
        ("categorie_achat.libelle", m.categories, [F.col("libelle")]),
        ("facture.id_facture", m.invoices, [F.col("id_facture")]),
        ("series.ds", m.daily(), [F.col("ds")]),
        ("series_service.ds_service", m.by_service(), [F.col("ds"), F.col("service")]),
    ]
    out = None
    for name, df, keys in checks:
        r = Q.duplicate_keys(df, keys).select(F.lit(name).alias("check_name"), "n_dup_keys")
        out = r if out is None else out.unionByName(r)
    return out


NOT_NULL = {
    "client": ["nom_client"], "employe": ["nom_employe"], "service": ["libelle"],
    "facture": ["id_facture", "date_facture", "statut_paiement", "id_client"],
    "ligne_facture": ["description", "quantite", "total_ligne", "id_facture", "id_service"],
    "fournisseur": ["nom"], "categorie_achat": ["libelle"],
    "achat": ["date_achat", "libelle_article", "quantite", "prix_achat_total", "id_fournisseur", "id_categorie"],
    "serie": ["series", "ds", "y", "n_orders"],
    "prevision": ["series", "ds", "yhat", "yhat_lower", "yhat_upper"],
}
_TABLE_SQL = {"client": "clients_merged", "employe": "employees", "service": "services",
              "facture": "invoices", "ligne_facture": "lines", "fournisseur": "suppliers",
              "categorie_achat": "categories", "achat": "purchase_facts",
              "serie": "(SELECT 'global' AS series, ds, y, n_orders FROM mart_daily UNION ALL SELECT service, ds, y, n_orders FROM mart_by_service)",
              # the weekly forecast's rows: 180 days for each series, every value set
              "prevision": "(SELECT s AS series, s AS ds, s AS yhat, s AS yhat_lower, s AS yhat_upper FROM (SELECT 'x' AS s FROM services LIMIT 1))"}


def _mart_tables(m: Mart):
    return {"client": m.clients, "employe": m.employees, "service": m.services, "facture": m.invoices,
            "ligne_facture": m.lines, "fournisseur": m.suppliers, "categorie_achat": m.categories,
            "achat": m.purchase_facts, "serie": m.store.mart_series(),
            "prevision": SV.weekly_repeat_forecast(m.store.mart_series())}


@query("dq_not_null", _sql("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
    f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_null FROM {_TABLE_SQL[t]}"
    for t, cols in NOT_NULL.items() for c in cols)))
def dq_not_null(spark, sf):
    tabs = _mart_tables(Mart.of(spark, sf))
    out = None
    for t, cols in NOT_NULL.items():
        r = Q.null_counts(tabs[t], t, cols)
        out = r if out is None else out.unionByName(r)
    return out


def _bounds_by_table():
    b: dict[str, list] = {}
    for t, c, n in LENGTH_BOUNDS:
        b.setdefault(t, []).append((c, n))
    return b


@query("dq_lengths", _sql("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{n}' AS max_len, "
    f"SUM(CASE WHEN length({c}) > {n} THEN 1 ELSE 0 END)::BIGINT AS n_too_long FROM {_TABLE_SQL[t]}"
    for t, c, n in LENGTH_BOUNDS)))
def dq_lengths(spark, sf):
    m = Mart.of(spark, sf)
    tabs = _mart_tables(m)
    tabs["achat"] = m.purchase_facts
    out = None
    for t, bounds in _bounds_by_table().items():
        r = Q.length_violations(tabs[t], t, bounds)
        out = r if out is None else out.unionByName(r)
    return out


_ALLOWED = ", ".join(q(s) for s in PAYMENT_STATUSES)
_SEEDED = ", ".join(q(s) for s in SERVICES)


@query("dq_domain", _sql(f"""
SELECT 'facture.statut_paiement' AS check_name,
  COALESCE(SUM(CASE WHEN statut_paiement NOT IN ({_ALLOWED}) THEN 1 ELSE 0 END), 0)::BIGINT AS n FROM invoices
UNION ALL
SELECT 'service.libelle', COUNT(*)::BIGINT FROM services WHERE libelle NOT IN ({_SEEDED})"""))
def dq_domain(spark, sf):
    m = Mart.of(spark, sf)
    a = Q.count_where(m.invoices, ~F.col("statut_paiement").isin(PAYMENT_STATUSES), "facture.statut_paiement")
    seed = spark.createDataFrame([(s,) for s in SERVICES], ["libelle"])
    extra = m.services.select("libelle").join(seed, "libelle", "left_anti")
    b = extra.agg(F.count(F.lit(1)).alias("n")).select(F.lit("service.libelle").alias("check_name"), "n")
    return a.unionByName(b)


@query("dq_orphans", _sql("""
SELECT 'facture.id_client' AS check_name, COUNT(*) FILTER (WHERE id_client IS NULL) AS n FROM invoices
UNION ALL SELECT 'facture.id_employe', COUNT(*) FILTER (WHERE i.id_employe IS NULL AND s.nom_employe IS NOT NULL)
  FROM invoices i JOIN sales_clean s ON i.id_facture = s.facture_id
UNION ALL SELECT 'ligne_facture.id_facture', COUNT(*) FROM lines l ANTI JOIN invoices i ON l.id_facture = i.id_facture
UNION ALL SELECT 'ligne_facture.id_service', COUNT(*) FILTER (WHERE id_service IS NULL) FROM lines
UNION ALL SELECT 'achat.id_fournisseur', COUNT(*) FILTER (WHERE id_fournisseur IS NULL) FROM purchase_facts
UNION ALL SELECT 'achat.id_categorie', COUNT(*) FILTER (WHERE id_categorie IS NULL) FROM purchase_facts"""))
def dq_orphans(spark, sf):
    """One aggregate per stored table; the only join is the lines' anti-join to the invoices."""
    m = Mart.of(spark, sf)
    lost = F.col("id_employe").isNull() & F.col("nom_employe").isNotNull()
    parts = [
        Q.counts_where(m.store.mart_invoices_with_source(), {"facture.id_client": F.col("id_client").isNull(), "facture.id_employe": lost}),
        Q.orphans(m.lines, "id_facture", m.invoices, "id_facture", "ligne_facture.id_facture"),
        Q.counts_where(m.lines, {"ligne_facture.id_service": F.col("id_service").isNull()}),
        Q.counts_where(m.purchase_facts, {"achat.id_fournisseur": F.col("id_fournisseur").isNull(),
                                          "achat.id_categorie": F.col("id_categorie").isNull()}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("dq_revenue_conserved", _sql("""
SELECT a.t AS mart_total, b.t AS series_total, c.t AS service_total,
  (a.t = b.t AND b.t = c.t) AS conserved FROM
  (SELECT CAST(SUM(CAST(l.total_ligne AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS t
     FROM lines l JOIN invoices i ON l.id_facture = i.id_facture) a,
  (SELECT CAST(SUM(y) AS DECIMAL(38,2)) AS t FROM mart_daily) b,
  (SELECT CAST(SUM(y) AS DECIMAL(38,2)) AS t FROM mart_by_service) c"""))
def dq_revenue_conserved(spark, sf):
    m = Mart.of(spark, sf)
    mart = (m.lines.join(m.invoices.select("id_facture"), "id_facture")
            .select(F.lit("mart").alias("k"), F.col("total_ligne").cast("decimal(18,2)").alias("v")))
    ser = m.daily().select(F.lit("series").alias("k"), F.col("y").alias("v"))
    svc = m.by_service().select(F.lit("service").alias("k"), F.col("y").alias("v"))
    u = mart.unionByName(ser, allowMissingColumns=True).unionByName(svc, allowMissingColumns=True)
    a = u.agg(*[F.sum(F.when(F.col("k") == k, F.col("v"))).cast("decimal(38,2)").alias(n)
                for k, n in (("mart", "mart_total"), ("series", "series_total"), ("service", "service_total"))])
    return a.select("*", ((F.col("mart_total") == F.col("series_total"))
                          & (F.col("series_total") == F.col("service_total"))).alias("conserved"))


@query("dq_orders_conserved", _sql("""
SELECT a.n AS mart_orders, b.n AS series_orders, (a.n = b.n) AS conserved FROM
  (SELECT COUNT(DISTINCT i.id_facture) AS n FROM invoices i JOIN lines l ON i.id_facture = l.id_facture) a,
  (SELECT SUM(n_orders)::BIGINT AS n FROM mart_daily) b"""))
def dq_orders_conserved(spark, sf):
    m = Mart.of(spark, sf)
    with_lines = m.invoices.select("id_facture").join(m.lines.select("id_facture"), "id_facture", "left_semi")
    a = with_lines.select(F.lit(1).alias("kind"), F.lit(1).cast("bigint").alias("v"))
    b = m.daily().select(F.lit(2).alias("kind"), F.col("n_orders").cast("bigint").alias("v"))
    g = a.unionByName(b).agg(F.sum(F.when(F.col("kind") == 1, F.col("v"))).alias("mart_orders"),
                             F.sum(F.when(F.col("kind") == 2, F.col("v"))).alias("series_orders"))
    return g.select(F.col("mart_orders").cast("bigint"), F.col("series_orders").cast("bigint"),
                    (F.col("mart_orders") == F.col("series_orders")).alias("conserved"))


@query("dq_zero_totals", _sql("""
SELECT 'ligne_facture.total_ligne' AS check_name,
  COUNT(*) FILTER (WHERE total_ligne = 0 AND quantite > 0 AND prix_unitaire > 0) AS n FROM lines"""))
def dq_zero_totals(spark, sf):
    m = Mart.of(spark, sf)
    cond = (F.col("total_ligne") == 0) & (F.col("quantite") > 0) & (F.col("prix_unitaire") > 0)
    return Q.count_where(m.lines, cond, "ligne_facture.total_ligne")


@query("dq_null_employee", _sql("""
SELECT a.n AS n_fact_null, b.n AS n_source_null, (a.n <= b.n) AS ok FROM
  (SELECT COUNT(*) FILTER (WHERE id_employe IS NULL) AS n FROM invoices) a,
  (SELECT COUNT(*) FILTER (WHERE nom_employe IS NULL) AS n FROM sales_clean) b"""))
def dq_null_employee(spark, sf):
    m = Mart.of(spark, sf)
    a = m.store.mart_invoices_with_source().agg(  # one pass: the stored invoices carry the source's name beside the resolved key
        F.sum(F.when(F.col("id_employe").isNull(), 1).otherwise(0)).cast("bigint").alias("n_fact_null"),
        F.sum(F.when(F.col("nom_employe").isNull(), 1).otherwise(0)).cast("bigint").alias("n_source_null"))
    return a.select("*", (F.col("n_fact_null") <= F.col("n_source_null")).alias("ok"))


def _rule_sql(r) -> str:
    t, c = _TABLE_SQL[r.table], r.columns[0]
    if r.kind == "unique":
        key = _LK(c) if r.any_case else c
        return f"SELECT '{r.name}' AS rule, (COUNT(*) - COUNT(DISTINCT COALESCE({key}, '')))::BIGINT AS n FROM {t}"
    if r.kind == "foreign":
        return f"SELECT '{r.name}' AS rule, COUNT(*) AS n FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {r.key} FROM {_TABLE_SQL[r.parent]} WHERE {r.key} IS NOT NULL)"
    broken = {"not_null": f"{c} IS NULL", "length": f"length({c}) > {r.limit}", "domain": f"{c} NOT IN ({', '.join(q(v) for v in r.values)})"}[r.kind]
    return f"SELECT '{r.name}' AS rule, COUNT(*) FILTER (WHERE {broken}) AS n FROM {t}"


@query("gate_report", _sql("\nUNION ALL ".join(_rule_sql(r) for r in RULES)))
def gate_report(spark, sf):
    """Every constraint that the publishing job holds the staged mart against, with its offending rows."""
    m = Mart.of(spark, sf)
    return violations({t: m.store.mart(t) for t in dict.fromkeys(r.table for r in RULES)}, RULES)
