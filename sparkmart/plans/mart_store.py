"""The batch job: source files -> raw archive -> cleaned feeds -> mart -> series, each a published table set.

``run_pipeline`` runs all of it into a folder.  ``Store`` is how the registered
queries read it: each table set is built by the first query that needs it, under the
session's shared folder, and read back with its columns pruned; nothing is pinned in
executors.  A store belongs to one session and input folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vocab import LENGTH_BOUNDS, PAYMENT_STATUSES, SERVICES
from ..operators import clean as C
from ..operators import forecaster as FM
from ..operators import ingest as G
from ..operators import mart as MT
from ..operators import series as S
from ..operators.constraints import Rule, enforce
from ..operators.counters import Counters
from ..session import shared_dir, shuffles_removed
from ..sources import feeds, files
from ..sources import store as ST
from ..sources import versions as V
from ..sources.tables import tasks_for
from ..streaming import orders as OS
from . import inputs as I

#: Each source's file format (every scan of the library is used).
FORMATS = {"sales": "csv", "purchases": "json", "clients": "parquet"}
_FEEDS = {"sales": feeds.sales_feed, "purchases": feeds.purchases_feed, "clients": feeds.clients_feed}
#: Landed order files that one micro-batch takes.
FILES_A_BATCH = 4
_CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: Landed files are compressed; as compressed text is read whole, a file holds so many rows at most.
_LANDED = {"maxRecordsPerFile": 500_000}
#: CSV files take 40 % less with gzip than with snappy.
_CODECS = {"csv": "gzip", "json": "snappy", "parquet": ST.CODEC}


def land(spark: SparkSession, sf: str, folder: str, names: Iterable[str] = tuple(FORMATS)) -> dict[str, tuple[str, str]]:
    """Write the feeds as source files; the registry for ``scan_all``."""
    out = {}
    for name in names:
        fmt = FORMATS[name]
        w = _FEEDS[name](spark, sf).write.mode("overwrite").options(compression=_CODECS[fmt], **_LANDED)
        with shuffles_removed(spark):
            (w.options(**_CSV) if fmt == "csv" else w).format(fmt).save(f"{folder}/{name}")
        out[name] = (f"{folder}/{name}", fmt)
    return out


def build_raw(spark: SparkSession, sf: str, root: str, landed: dict[str, tuple[str, str]] | None = None) -> None:
    """Source files (by default all three, landed now), scanned as text and archived as they are."""
    scanned = files.scan_all(spark, landed or land(spark, sf, f"{root}/landing"))
    ST.write_raw_archive(scanned, f"{root}/raw")


def raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    df = ST.read_published(spark, f"{root}/raw", name).drop("charge_le")
    return df.withColumn("seq", F.col("seq").cast("bigint"))


def build_clean(spark: SparkSession, root: str, names: Iterable[str] = tuple(FORMATS)) -> None:
    """The cleaned feeds; the manifest has each job's step counters."""
    source = {n: raw(spark, root, n) for n in names}
    counters = {n: Counters() for n in source}
    ST.publish_all(C.clean_all(source, counters=counters), f"{root}/clean", counters=lambda stored: C.job_counts(source, counters, stored))


def _rules() -> list[Rule]:
    not_null = {"client": ["id_client", "nom_client"], "employe": ["id_employe", "nom_employe"], "service": ["id_service", "libelle"],
                "facture": ["id_facture", "date_facture", "statut_paiement", "id_client"],
                "ligne_facture": ["description", "quantite", "total_ligne", "id_facture", "id_service"], "fournisseur": ["id_fournisseur", "nom"],
                "categorie_achat": ["id_categorie", "libelle"],
                "achat": ["date_achat", "libelle_article", "quantite", "prix_achat_total", "id_fournisseur", "id_categorie"]}
    unique = [("client", "id_client"), ("employe", "id_employe"), ("service", "id_service"), ("service", "libelle"), ("facture", "id_facture"),
              ("fournisseur", "id_fournisseur"), ("fournisseur", "nom"), ("categorie_achat", "id_categorie"), ("categorie_achat", "libelle")]
    foreign = [("facture", "id_client", "client"), ("facture", "id_employe", "employe"), ("ligne_facture", "id_facture", "facture"),
               ("ligne_facture", "id_service", "service"), ("achat", "id_fournisseur", "fournisseur"), ("achat", "id_categorie", "categorie_achat")]
    return [*[Rule(t, (c,), "not_null") for t, cols in not_null.items() for c in cols], *[Rule(t, (c,), "length", limit=n) for t, c, n in LENGTH_BOUNDS],
            Rule("facture", ("statut_paiement",), "domain", values=tuple(PAYMENT_STATUSES)), Rule("service", ("libelle",), "domain", values=tuple(SERVICES)),
            *[Rule(t, (c,), "unique") for t, c in unique],
            *[Rule(t, (c,), "unique", any_case=True) for t, c in (("client", "nom_client"), ("employe", "nom_employe"))],
            *[Rule(t, (c,), "foreign", parent=p, key=c) for t, c, p in foreign]]


#: What every published mart holds, and what the source files break and the mart only reports.
RULES = _rules()
#: (a sentinel total on a line without a price cannot be computed again, so the line has no total)
REPORTED = frozenset({"facture.statut_paiement:not_null", "ligne_facture.quantite:not_null", "ligne_facture.total_ligne:not_null",
                      "achat.quantite:not_null", "achat.id_categorie:not_null"})
#: The queries report what breaks any rule (``dq_*`` and ``gate_report`` count it), so none stops them.
ALL_REPORTED = frozenset(r.name for r in RULES)


#: The mart's two stars: no rule and no key goes from one to the other.
STARS = {"ventes": ("client", "employe", "service", "facture", "ligne_facture"), "achats": ("fournisseur", "categorie_achat", "achat")}
STAR_OF = {t: star for star, tables in STARS.items() for t in tables}


def build_mart(spark: SparkSession, root: str, clean: Callable[[str], DataFrame] | None = None, reported: frozenset[str] = REPORTED,
               stars: Iterable[str] = tuple(STARS)) -> None:
    """Dimensions first (facts resolve their keys against the stored rows), then facts: one manifest.

    The staged set is held against the constraints before it is published; what breaks a rule of
    ``reported`` is only counted.  ``clean`` reads a cleaned feed, by default from the set under ``root``.
    """
    clean = clean or (lambda n: ST.read_published(spark, f"{root}/clean", n))
    stars, dims, facts = tuple(stars), {}, {}
    dim = lambda n: ST.read_published(spark, f"{root}/dimensions", n)
    if "ventes" in stars:
        sales = clean("sales")
        dims |= {"client": MT.merge_client_sources(clean("clients"), sales), "employe": MT.employees(sales), "service": MT.services(sales)}
    if "achats" in stars:
        purchases = clean("purchases")
        dims |= {"fournisseur": MT.distinct_dimension(purchases, "nom_fournisseur", "id_fournisseur", "nom"),
                 "categorie_achat": MT.distinct_dimension(purchases, "libelle_categorie", "id_categorie", "libelle")}
    ST.publish_all(dims, f"{root}/dimensions")
    if "ventes" in stars:
        facts |= {"facture": MT.fact_invoice(sales, dim("client"), dim("employe"), with_source=True), "ligne_facture": MT.fact_line(sales, dim("service"))}
    if "achats" in stars:
        facts |= {"achat": MT.fact_purchase(purchases, dim("fournisseur"), dim("categorie_achat"))}
    rules = [r for r in RULES if STAR_OF[r.table] in stars]
    check = lambda staged, quarantine: enforce(staged, rules, quarantine, reported)
    ST.publish_all({n: dim(n) for n in dims} | facts, f"{root}/mart", check=check)


def build_mart_series(spark: SparkSession, root: str, of: str | None = None) -> None:
    """The mart's own series: per day, and per day and service, with the time of the refresh (``of``: the folder over the mart)."""
    of = of or root
    mart = lambda n: ST.read_published(spark, f"{of}/mart", n)
    lines = mart("ligne_facture").join(mart("service"), "id_service", "left").select("id_facture", "total_ligne", F.col("libelle").alias("service"))
    long = S.series_one_pass(mart("facture"), lines, inv_key="id_facture", inv_date="date_facture", line_key="id_facture",
                             amount="total_ligne", label="service", tasks=tasks_for(spark, ST.folder(spark, f"{of}/mart", "ligne_facture")))
    ST.publish_all({"serie": long.withColumn("rafraichi_le", F.current_timestamp())}, f"{root}/mart_series", partition_by={"serie": ["series"]})


def build_series(spark: SparkSession, sf: str, root: str) -> None:
    """The series of the star tables, partitioned by series, with the time of the refresh."""
    long = I.series(spark, sf).withColumn("rafraichi_le", F.current_timestamp())
    ST.publish_all({"serie": long}, f"{root}/series", partition_by={"serie": ["series"]})


def build_models(spark: SparkSession, root: str) -> None:
    """Fit every series of the published series once; the parameters replace each series' former ones."""
    series = ST.read_published(spark, f"{root}/series", "serie").select("series", "ds", "y")
    V.replace_part(FM.model_params(series), f"{root}/models", "parametres", "series")


def build_cv(spark: SparkSession, root: str) -> None:
    """Rolling-origin forecasts of every series, which the evaluation jobs read."""
    series = ST.read_published(spark, f"{root}/series", "serie").select("series", "ds", "y")
    ST.publish_all({"previsions": FM.cv_forecasts(series)}, f"{root}/cv")


def build_orders(spark: SparkSession, sf: str, root: str) -> None:
    """The order feed with each event's reasons, computed once."""
    ST.publish_all({"commandes": G.validate_orders(feeds.order_feed(spark, sf))}, f"{root}/orders")


def build_ingested(spark: SparkSession, root: str, of: str | None = None) -> None:
    """The order feed landed as files, every tenth event twice, and drained by the streaming job into its own tables (``of``: the folder over the mart)."""
    landing, base = f"{root}/order_landing", f"{root}/ingested"
    feed = ST.read_published(spark, f"{root}/orders", "commandes").drop("reject_reasons", "is_valid", "statut", "date_cmd", "total")
    feed.write.mode("overwrite").option("compression", ST.CODEC).parquet(landing)
    feed.where("seq % 10 = 0").write.mode("append").option("compression", ST.CODEC).parquet(landing)  # delivered again, in other files
    mart = lambda n: ST.read_published(spark, f"{of or root}/mart", n)
    OS.seed_dimensions(mart("client"), mart("employe"), base)
    OS.run_order_stream(spark, landing, base, f"{root}/order_checkpoint", feed.schema, mart("service"), files_per_batch=FILES_A_BATCH)


def steps(spark: SparkSession, sf: str, root: str) -> dict[str, Callable[[], None]]:
    """The steps of the whole job, in order."""
    return {"raw": lambda: build_raw(spark, sf, root), "clean": lambda: build_clean(spark, root), "mart": lambda: build_mart(spark, root),
            "mart_series": lambda: build_mart_series(spark, root), "series": lambda: build_series(spark, sf, root),
            "models": lambda: build_models(spark, root)}


def run_pipeline(spark: SparkSession, sf: str, root: str) -> None:
    """The whole job, in order; every set is switched to its new version when it is complete."""
    for step in steps(spark, sf, root).values():
        step()



class Store:
    """A session's published tables of one input folder.

    Where the whole job has not run under its folder, each source is landed, archived and
    cleaned in a folder of its own when a query needs it, and each star of the mart built and
    checked in its own, so a query does the work of its sources and stars.
    """

    _open: dict[tuple[str, str], Store] = {}

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf, self.root = spark, sf, shared_dir(spark, "mart")
        self._ingested: str | None = None
        self._landed: dict[str, tuple[str, str]] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf: str) -> Store:
        key = (spark.sparkContext.applicationId, sf)
        if key not in cls._open:
            cls._open[key] = cls(spark, sf)
        return cls._open[key]

    @classmethod
    def forget(cls) -> None:
        """Later queries build anew (cold measurements)."""
        cls._open.clear()

    def _read(self, group: str, name: str) -> DataFrame:
        self._ensure(group)
        return ST.read_published(self.spark, f"{self.root}/{group}", name)

    def _ensure(self, group: str) -> None:
        if ST.manifest(self.spark, f"{self.root}/{group}") is not None:
            return
        if group == "orders":
            build_orders(self.spark, self.sf, self.root)
        elif group == "cv":
            self._ensure("series")
            build_cv(self.spark, self.root)
        elif group == "mart_series":
            build_mart_series(self.spark, self.root, self._mart("facture"))
        else:
            build_series(self.spark, self.sf, self.root)

    def _source(self, group: str, name: str) -> str:
        """The folder over a source's ``raw`` or ``clean`` set: the whole job's, else the source's own (built now if it is not there)."""
        if ST.manifest(self.spark, f"{self.root}/{group}") is not None:
            return self.root
        own = f"{self.root}/sources/{name}"
        if ST.manifest(self.spark, f"{own}/{group}") is None:
            if group == "raw":
                build_raw(self.spark, self.sf, own, {name: self.landed(name)})
            else:
                self._source("raw", name)
                build_clean(self.spark, own, [name])
        return own

    def _mart(self, table: str) -> str:
        """The folder over the mart that holds a table: the whole job's, else that of the table's star (built now if it is not there)."""
        if ST.manifest(self.spark, f"{self.root}/mart") is not None:
            return self.root
        own = f"{self.root}/stars/{STAR_OF[table]}"
        if ST.manifest(self.spark, f"{own}/mart") is None:
            build_mart(self.spark, own, self.clean, ALL_REPORTED, [STAR_OF[table]])
        return own

    def landed(self, name: str) -> tuple[str, str]:
        """A source's landed files: (folder, format)."""
        if name not in self._landed:
            if ST.manifest(self.spark, f"{self.root}/raw") is not None:
                self._landed[name] = (f"{self.root}/landing/{name}", FORMATS[name])
            else:
                self._landed |= land(self.spark, self.sf, f"{self.root}/sources/{name}/landing", [name])
        return self._landed[name]

    def raw_set(self, name: str) -> str:
        """The folder of the published set that holds a source's raw archive."""
        return f"{self._source('raw', name)}/raw"

    def raw(self, name: str) -> DataFrame:
        return raw(self.spark, self._source("raw", name), name)

    def models(self) -> DataFrame:
        """The parameters that forecasts are made from, one row per series."""
        root = f"{self.root}/models"
        if V.snapshot(self.spark, root)["number"] < 0:
            self._ensure("series")
            build_models(self.spark, self.root)
        return V.read_current(self.spark, root, "parametres")

    def cv(self) -> DataFrame:
        """(series, cutoff, ds, y, yhat, yhat_lower, yhat_upper) of the rolling-origin refits."""
        return self._read("cv", "previsions")

    def orders(self) -> DataFrame:
        """The order feed's events with their reasons."""
        return self._read("orders", "commandes")

    def ingested(self) -> str:
        """The root of the tables that the streaming job stored."""
        root = f"{self.root}/ingested"
        if self._ingested is None:
            self._ensure("orders")
            build_ingested(self.spark, self.root, self._mart("client"))
            self._ingested = root
        return self._ingested

    def clean(self, name: str) -> DataFrame:
        return ST.read_published(self.spark, f"{self._source('clean', name)}/clean", name)

    def counters(self, job: str) -> DataFrame:
        """The step counters that the cleaning job left in its manifest, as one row."""
        counts = ST.manifest(self.spark, f"{self._source('clean', job)}/clean")["counters"][job]
        return self.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))

    def mart(self, name: str) -> DataFrame:
        df = ST.read_published(self.spark, f"{self._mart(name)}/mart", name)
        return df.drop("nom_employe") if name == "facture" else df

    def mart_invoices_with_source(self) -> DataFrame:
        """Invoices with the employee's name as the source had it."""
        return ST.read_published(self.spark, f"{self._mart('facture')}/mart", "facture")

    def mart_series(self) -> DataFrame:
        """(series, ds, y, n_orders) of the mart's facts."""
        return self._read("mart_series", "serie").select("series", "ds", "y", "n_orders")

    def series(self) -> DataFrame:
        """(series, ds, y, n_orders) of the star tables; a filter on ``series`` prunes partitions."""
        return self._read("series", "serie").select("series", "ds", "y", "n_orders")
