"""Untyped source scans (every column read as text, header trimmed).

Raw files must keep their anomalies, so nothing is inferred: the schema is
all ``string`` and cleaning happens later with explicit, NULL-safe casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Logical source name -> expected header (as it appears in the files).
SOURCE_HEADERS = {
    "sales": ["Date", "Facture_ID", "Client", "Telephone", "Service_Type", "Description",
              "Quantite", "Prix_Unitaire", "Total", "Employe_En_Charge", "Statut_Paiement"],
    "purchases": ["Date", "Fournisseur", "Article", "Categorie", "Quantite",
                  "Prix_Achat_Total", "Mode_Paiement"],
    "clients": ["Nom_Client", "Entreprise", "Telephone", "Email", "Ville", "Notes"],
}


def scan_text(spark: SparkSession, path: str, fmt: str = "csv",
              columns: list[str] | None = None, **options) -> DataFrame:
    """Read a CSV / JSON / Parquet source with every column as text.

    Columns are matched by their trimmed, lower-case header name, so files with
    reordered or additional columns read right; a missing column is an error.
    Nothing is inferred: a CSV scan reads the header line only to name the columns.
    """
    reader = spark.read.options(**options)
    if fmt == "csv":
        df = reader.option("header", True).option("inferSchema", False).csv(path)
    elif fmt == "json":
        df = reader.option("primitivesAsString", True).json(path)
    elif fmt == "parquet":
        df = reader.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt}")
    by_name = {c.strip().lower(): c for c in df.columns}
    wanted = [c.strip().lower() for c in columns] if columns else list(by_name)
    missing = [c for c in wanted if c not in by_name]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df.select([F.col(f"`{by_name[c]}`").cast("string").alias(c) for c in wanted])


def scan_source(spark: SparkSession, name: str, path: str, fmt: str = "csv") -> DataFrame:
    """One registered source; ``seq`` (arrival order) is kept where the files have it."""
    df = scan_text(spark, path, fmt)
    wanted = [c.lower() for c in SOURCE_HEADERS[name]]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df.select(*(["seq"] if "seq" in df.columns else []), *wanted)


def scan_all(spark: SparkSession, registry: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """``{name: (path, fmt)}`` -> dict of lazy all-text DataFrames."""
    return {name: scan_source(spark, name, path, fmt) for name, (path, fmt) in registry.items()}
