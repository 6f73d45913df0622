"""Cleaning jobs for the three raw sources.

Each job is one lazy plan; with a :class:`Counters` it counts its steps while it runs, and
``*_counts`` turns these into the job's report.  ``*_report`` computes the same report from
the raw rows (an executor lost in mid-job can make observed counters run too high, which
shows, as they then do not match the rows stored).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.labels import normalise_city, normalise_service, normalise_status
from ..functions.money import integral, round_even, safe_number
from ..functions.text import clean_text, strip, text_or_nan
from ..functions.vocab import TOTAL_SENTINELS
from .counters import Counters, watched
from .dedup import dedup_case_insensitive, keep_first


def _bigint_money(c):
    """Round to 2 digits, then half-even to a whole unit (as the mart stores it)."""
    return round_even(round_even(c, 2), 0).cast("bigint")


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are worked out once a row (a plain column's text would be parsed again in each filter and expression above it)."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


# --------------------------------------------------------------------- sales

def sales_parsed(raw: DataFrame) -> DataFrame:
    """Dates parsed, service and status labels canonicalised."""
    return _once(raw, date_facture=parse_date("date")).select(
        "*",
        normalise_service("service_type").alias("service"),
        normalise_status("statut_paiement").alias("statut"),
    )


def recompute_totals(df: DataFrame) -> DataFrame:
    """Numbers from text; total = qty x price when missing or a sentinel."""
    numbers = _once(df, qty_num=safe_number("quantite"), price_num=safe_number("prix_unitaire"), _total=safe_number("total"))
    qty, price, total = F.col("qty_num"), F.col("price_num"), F.col("_total")
    bad = total.isNull() | total.isin(TOTAL_SENTINELS)
    return numbers.select(
        *df.columns, "qty_num", "price_num",
        F.when(bad, qty * price).otherwise(total).alias("total_num"),
        bad.alias("recomputed"),
    )


def _fractional(qty) -> Column:
    """A quantity that is a number but not a whole one."""
    return qty.isNotNull() & integral(qty).isNull()


def _first_sales(raw: DataFrame, counters: Counters | None = None) -> DataFrame:
    p = sales_parsed(watched(counters, raw, "input")).filter(F.col("date_facture").isNotNull() & F.col("client").isNotNull())
    # dealt by invoice before they are sorted: a sort of a whole scan task would hold its split
    dealt = watched(counters, p, "usable").repartition("facture_id")
    first = keep_first(dealt, ["facture_id"], ["seq"])
    return recompute_totals(watched(counters, first, "first"))


def sales_rejects(raw: DataFrame) -> DataFrame:
    """Invoices that :func:`clean_sales` does not take, with the reason."""
    r = _first_sales(raw).filter(_fractional(F.col("qty_num")))
    return r.select("seq", "facture_id", "quantite", F.lit("quantite:not_whole").alias("reason"))


def clean_sales(raw: DataFrame, counters: Counters | None = None) -> DataFrame:
    """Flat cleaned sales, one row per kept invoice.

    Order matters (it decides which duplicate survives): drop rows lacking a
    date or client, then keep the first row per invoice id, then repair totals;
    invoices with a fractional quantity are rejected (:func:`sales_rejects`).
    """
    r = _first_sales(raw, counters).filter(~_fractional(F.col("qty_num")))
    r = watched(counters, r, "kept", recomputed=F.col("recomputed"), no_employee=F.col("employe_en_charge").isNull())
    return r.select(
        "seq", "facture_id", "date_facture",
        F.col("statut").alias("statut_paiement"),
        F.col("client").alias("nom_client"), "telephone",
        F.col("employe_en_charge").alias("nom_employe"),
        "service", "description",
        integral(F.col("qty_num")).alias("quantite"),
        _bigint_money(F.col("price_num")).alias("prix_unitaire"),
        _bigint_money(F.col("total_num")).alias("total_ligne"),
        "recomputed",
    )


def sales_counts(c: Counters) -> dict[str, int]:
    """:func:`sales_report` from the counters of a run."""
    n = {p: c.value(p) for p in ("input", "usable", "first", "kept")}
    return {"n_input": n["input"], "n_dropped_missing": n["input"] - n["usable"], "n_duplicates": n["usable"] - n["first"], "n_rejected": n["first"] - n["kept"],
            "n_recomputed": c.value("kept", "recomputed"), "n_kept": n["kept"], "n_without_employee": c.value("kept", "no_employee")}


def _n(cond) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def sales_report(raw: DataFrame) -> DataFrame:
    """Step counters of :func:`clean_sales`, from one pass over the raw rows.

    The first row of each (invoice id, usable) is found by ``min_by``, so rows are
    combined before the exchange and a frequent or missing id meets no single task.
    """
    usable = F.col("date_facture").isNotNull() & F.col("client").isNotNull()
    r = recompute_totals(sales_parsed(raw)).select("facture_id", "seq", usable.alias("usable"), "recomputed",
                                                   F.col("employe_en_charge").isNull().alias("no_employee"),
                                                   _fractional(F.col("qty_num")).alias("fractional"))
    g = r.groupBy("facture_id", "usable").agg(F.count(F.lit(1)).alias("n"),
                                              F.min_by(F.struct("recomputed", "no_employee", "fractional"), "seq").alias("first"))
    kept = F.col("usable") & ~F.col("first.fractional")
    return g.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_input"),
        F.sum(F.when(~F.col("usable"), F.col("n")).otherwise(0)).cast("bigint").alias("n_dropped_missing"),
        F.sum(F.when(F.col("usable"), F.col("n") - 1).otherwise(0)).cast("bigint").alias("n_duplicates"),
        _n(F.col("usable") & F.col("first.fractional")).alias("n_rejected"),
        _n(kept & F.col("first.recomputed")).alias("n_recomputed"), _n(kept).alias("n_kept"),
        _n(kept & F.col("first.no_employee")).alias("n_without_employee"))


# ----------------------------------------------------------------- purchases

PURCHASE_COLS = ["date", "fournisseur", "article", "categorie", "quantite",
                 "prix_achat_total", "mode_paiement"]


def drop_empty_rows(raw: DataFrame, cols=PURCHASE_COLS) -> DataFrame:
    return raw.na.drop("all", subset=list(cols))


def fix_negatives(df: DataFrame, col: str = "prix_achat_total") -> DataFrame:
    x = F.col("amount_raw")
    neg = F.coalesce(x < 0, F.lit(False))
    return _once(df, amount_raw=safe_number(col)).select("*", F.when(neg, F.abs(x)).otherwise(x).alias("amount"), neg.alias("was_negative"))


def _usable_purchases(raw: DataFrame, counters: Counters | None = None) -> DataFrame:
    d = watched(counters, drop_empty_rows(watched(counters, raw, "input")), "some")
    d = watched(counters, d.na.drop("any", subset=["fournisseur", "article"]), "complete")
    d = _once(d, date_achat=parse_date("date")).filter(F.col("date_achat").isNotNull())
    return fix_negatives(_once(watched(counters, d, "dated"), qty_num=safe_number("quantite")))


def purchases_rejects(raw: DataFrame) -> DataFrame:
    """Purchases that :func:`clean_purchases` does not take, with the reason and their amount."""
    r = _usable_purchases(raw).filter(_fractional(F.col("qty_num")))
    return r.select("seq", "date_achat", "fournisseur", "article", "quantite", "prix_achat_total", F.lit("quantite:not_whole").alias("reason"))


def clean_purchases(raw: DataFrame, compat_nan: bool = False, counters: Counters | None = None) -> DataFrame:
    """Drop empty / incomplete / undated rows, fix signs, type, trim.

    Purchases with a fractional quantity are rejected (:func:`purchases_rejects`).
    ``compat_nan`` reproduces the source behaviour of turning NULL text into
    the string ``nan``; by default NULL stays NULL (and is reported by DQ).
    """
    d = _usable_purchases(raw, counters).filter(~_fractional(F.col("qty_num")))
    d = watched(counters, d, "kept", negative=F.col("was_negative"))
    txt = text_or_nan if compat_nan else strip
    return d.select(
        "seq", "date_achat",
        txt("fournisseur").alias("nom_fournisseur"),
        txt("article").alias("libelle_article"),
        txt("categorie").alias("libelle_categorie"),
        integral(F.col("qty_num")).alias("quantite"),
        _bigint_money(F.col("amount")).alias("prix_achat_total"),
        txt("mode_paiement").alias("mode_paiement"),
    )


def purchases_counts(c: Counters) -> dict[str, int]:
    """:func:`purchases_report` from the counters of a run."""
    n = {p: c.value(p) for p in ("input", "some", "complete", "dated", "kept")}
    return {"n_input": n["input"], "n_empty": n["input"] - n["some"], "n_incomplete": n["some"] - n["complete"], "n_undated": n["complete"] - n["dated"],
            "n_rejected": n["dated"] - n["kept"], "n_sign_fixed": c.value("kept", "negative"), "n_kept": n["kept"]}


def purchases_report(raw: DataFrame) -> DataFrame:
    """Step counters of :func:`clean_purchases`: one aggregate over the raw rows."""
    empty = F.coalesce(*[F.col(c) for c in PURCHASE_COLS]).isNull()
    partial = ~empty & (F.col("fournisseur").isNull() | F.col("article").isNull())
    undated = ~empty & ~partial & parse_date("date").isNull()
    usable, fractional = ~empty & ~partial & ~undated, _fractional(safe_number("quantite"))
    kept = usable & ~fractional
    return fix_negatives(raw).agg(
        F.count(F.lit(1)).alias("n_input"), _n(empty).alias("n_empty"), _n(partial).alias("n_incomplete"), _n(undated).alias("n_undated"),
        _n(usable & fractional).alias("n_rejected"), _n(kept & F.col("was_negative")).alias("n_sign_fixed"), _n(kept).alias("n_kept"))


# ------------------------------------------------------------------- clients

CLIENT_TEXT = ["nom_client", "entreprise", "telephone", "email", "ville"]


def clean_clients(raw: DataFrame, counters: Counters | None = None) -> DataFrame:
    """Trim, fold missing spellings, normalise city, dedup case-insensitively."""
    c = raw.select("seq", *[clean_text(x).alias(x) for x in CLIENT_TEXT])
    c = watched(counters, c, "input", moved=F.coalesce(normalise_city("ville") != F.col("ville"), F.lit(False)))
    c = c.withColumn("ville", normalise_city("ville"))
    return watched(counters, dedup_case_insensitive(c, "nom_client", order=["seq"]), "kept").select("seq", *CLIENT_TEXT)


def clients_counts(c: Counters) -> dict[str, int]:
    """:func:`clients_report` from the counters of a run."""
    return {"n_input": c.value("input"), "n_duplicates": c.value("input") - c.value("kept"), "n_city_normalised": c.value("input", "moved"), "n_kept": c.value("kept")}


def clients_report(raw: DataFrame) -> DataFrame:
    """Step counters of :func:`clean_clients`; rows are combined per name before the exchange."""
    c = raw.select(clean_text("nom_client").alias("n"), clean_text("ville").alias("v"))
    moved = F.coalesce(normalise_city("v") != F.col("v"), F.lit(False))
    g = c.groupBy(F.lower("n").alias("k")).agg(F.count(F.lit(1)).alias("rows"), _n(moved).alias("moved"))
    return g.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("n_input"),
                 F.sum(F.col("rows") - 1).cast("bigint").alias("n_duplicates"),
                 F.sum("moved").cast("bigint").alias("n_city_normalised"), F.count(F.lit(1)).alias("n_kept"))


# ----------------------------------------------------------------------- all

def clean_all(raw: dict[str, DataFrame], compat_nan: bool = False, counters: dict[str, Counters] | None = None) -> dict[str, DataFrame]:
    """The three cleaning jobs over a dict of raw sources, one lazy plan each (counted where ``counters`` has the job)."""
    out: dict[str, DataFrame] = {}
    c = counters or {}
    if "sales" in raw:
        out["sales"] = clean_sales(raw["sales"], c.get("sales"))
    if "purchases" in raw:
        out["purchases"] = clean_purchases(raw["purchases"], compat_nan, c.get("purchases"))
    if "clients" in raw:
        out["clients"] = clean_clients(raw["clients"], c.get("clients"))
    return out


def job_counts(raw: dict[str, DataFrame], counters: dict[str, Counters], stored: dict[str, DataFrame]) -> dict[str, dict[str, int]]:
    """The reports of jobs that have run: the observed counters where they match the rows stored, else counted from the raw rows."""
    of = {"sales": (sales_counts, sales_report), "purchases": (purchases_counts, purchases_report), "clients": (clients_counts, clients_report)}
    out = {}
    for name, (observed, counted) in of.items():
        if name in counters:
            r = observed(counters[name])
            exact = r["n_kept"] == stored[name].count() and min(r.values()) >= 0 and r["n_input"] == raw[name].count()
            out[name] = r if exact else {k: int(v) for k, v in counted(raw[name]).first().asDict().items()}
    return out
