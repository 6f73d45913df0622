"""Mart building: dimensions with derived keys, facts with resolved keys.

Surrogate keys are ``md5`` of the normalised natural key (see
``functions.ids``), so keys need no round trip through a database; foreign
keys are still *resolved* by a left join on the natural key, so a value with
no parent row yields a NULL key that the data-quality checks report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import name_key
from ..functions.text import is_all_upper, lower_key, strip
from ..functions.vocab import SERVICES
from .dedup import dedup_case_insensitive, keep_first

CLIENT_COLS = ["nom_client", "entreprise", "telephone", "email", "ville"]


def clients_from_sales(sales: DataFrame) -> DataFrame:
    """First (name, phone) per exact client name, in file order."""
    return keep_first(sales.select("seq", "nom_client", "telephone"), ["nom_client"], ["seq"])


def merge_client_sources(clients: DataFrame, sales: DataFrame) -> DataFrame:
    """Client dimension from the client file (rank 0) and the sales (rank 1).

    Survivor per lower-cased name: richest source first, then mixed case,
    then file order.
    """
    a = clients.select("seq", *CLIENT_COLS).withColumn("_src", F.lit(0))
    b = clients_from_sales(sales).withColumn("_src", F.lit(1))
    u = a.unionByName(b, allowMissingColumns=True)
    u = u.withColumn("nom_client", strip("nom_client"))
    kept = dedup_case_insensitive(u, "nom_client", order=["seq"], prefix=["_src"])
    return kept.select(name_key("nom_client").alias("id_client"), *CLIENT_COLS)


def employees(sales: DataFrame) -> DataFrame:
    """Employee dimension, case-insensitive like its unique index."""
    e = sales.select("seq", strip("nom_employe").alias("nom_employe")).filter(F.col("nom_employe").isNotNull())
    kept = dedup_case_insensitive(e, "nom_employe", order=["seq"])
    return kept.select(name_key("nom_employe").alias("id_employe"), "nom_employe")


def distinct_dimension(df: DataFrame, col: str, id_name: str, out_name: str) -> DataFrame:
    """Distinct non-NULL labels of one column, keyed."""
    d = df.select(F.col(col).alias(out_name)).filter(F.col(out_name).isNotNull()).distinct()
    return d.select(F.md5(F.col(out_name)).alias(id_name), out_name)


def seed_dimension(existing: DataFrame, seed_labels=SERVICES, col: str = "libelle",
                   id_name: str = "id_service") -> DataFrame:
    """Insert the fixed labels that are missing; existing rows are kept as they are."""
    spark = existing.sparkSession
    seed = spark.createDataFrame([(x,) for x in seed_labels], [col])
    new = seed.join(existing.select(col), col, "left_anti")
    out = existing.select(col).unionByName(new)
    return out.select(F.md5(F.col(col)).alias(id_name), col)


def services(sales: DataFrame) -> DataFrame:
    observed = sales.select(F.col("service").alias("libelle")).filter(F.col("libelle").isNotNull()).distinct()
    return seed_dimension(observed)


def _resolve(facts: DataFrame, fact_col: str, dim: DataFrame, dim_col: str, id_col: str,
             case_insensitive: bool) -> DataFrame:
    """Left lookup of a dimension key by natural key; a miss gives NULL."""
    if case_insensitive:
        fk, dk = lower_key(fact_col), lower_key(dim_col)
    else:
        fk, dk = F.col(fact_col), F.col(dim_col)
    d = dim.select(dk.alias("_k"), F.col(id_col))
    return facts.withColumn("_k", fk).join(d, "_k", "left").drop("_k")


def fact_invoice(sales: DataFrame, clients: DataFrame, emps: DataFrame, with_source: bool = False) -> DataFrame:
    """Invoices with resolved keys; ``with_source`` carries the employee's name along for the checks."""
    f = sales.select(F.col("facture_id").alias("id_facture"), "date_facture", "statut_paiement",
                     "nom_client", "nom_employe")
    f = _resolve(f, "nom_client", clients, "nom_client", "id_client", True)
    f = _resolve(f, "nom_employe", emps, "nom_employe", "id_employe", True)
    return f.select("id_facture", "date_facture", "statut_paiement", "id_client", "id_employe", *(["nom_employe"] * with_source))


def fact_line(sales: DataFrame, svc: DataFrame) -> DataFrame:
    f = sales.select(F.col("facture_id").alias("id_facture"), "description", "quantite",
                     "prix_unitaire", "total_ligne", "service")
    # a plain join: AQE broadcasts the service dimension from its measured size
    d = svc.select(F.col("libelle").alias("service"), "id_service")
    f = f.join(d, "service", "left")
    return f.select("id_facture", "description", "quantite", "prix_unitaire", "total_ligne", "id_service")


def fact_purchase(purchases: DataFrame, suppliers: DataFrame, categories: DataFrame) -> DataFrame:
    f = _resolve(purchases, "nom_fournisseur", suppliers, "nom", "id_fournisseur", False)
    f = _resolve(f, "libelle_categorie", categories, "libelle", "id_categorie", False)
    return f.select("date_achat", "libelle_article", "quantite", "prix_achat_total",
                    "mode_paiement", "id_fournisseur", "id_categorie")


def merge_duplicate_clients(dim: DataFrame, invoices: DataFrame) -> DataFrame:
    """Repoint invoices from case-duplicate client rows to the kept row.

    ``dim``: (id_client, nom_client, seq) with exact-case duplicates;
    ``invoices``: (id_facture, id_client).  Kept row per lower-cased name:
    mixed case first, then ``seq``.  Returns the remapped invoices; the rows that no
    invoice points to any more are removed by :func:`without_duplicate_clients`.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(lower_key("nom_client")).orderBy(is_all_upper("nom_client"), "seq")
    remap = dim.select("id_client", F.first("id_client").over(w).alias("kept_id"))
    j = invoices.join(remap, "id_client", "left")
    return j.select("id_facture", F.coalesce("kept_id", "id_client").alias("id_client"))


def without_duplicate_clients(dim: DataFrame) -> DataFrame:
    """The client rows that :func:`merge_duplicate_clients` keeps, one per lower-cased name."""
    kept = dedup_case_insensitive(dim, "nom_client", order=["seq"])
    return kept.select(*dim.columns)
