"""Order ingestion as a Structured Streaming job.

``readStream`` over a landing folder of order files -> ``foreachBatch``:

1. repeated deliveries are dropped, inside the batch and against the ledger: the keys of
   all events that earlier batches took or rejected, in hashed buckets.  A batch reads the
   buckets of its own keys only, and of these what passes a Bloom filter of the batch's
   keys, so neither side of the anti-join grows with the history;
2. accepted orders are appended to the day-partitioned facts (an order is one invoice with
   one line, so both tables are projections of one row), rejected ones to the reject table;
   the client and employee dimensions are merged by event number in the buckets that the
   batch touches, which gives the same table for any split and order of batches; revenue
   by day is computed again for the touched partitions, reading these partitions alone;
3. one commit of the log (``sources.versions``) adds all of it.  Until then nothing of the
   batch is visible; a batch that has a commit is not processed again, and of two writers
   of one number the second fails; so a replay after a crash at any point neither loses nor
   doubles an order, and no reader sees an invoice without its line or client.

Parts that have gathered many small folders are merged between batches.  The checkpoint
and every table live under folders the caller passes (the cluster's shared checkpoint
folder in the registered queries).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as G
from ..operators.bloom import bloom, might_be_in
from ..sources import versions as V

REJECT_COLS = ["event_key", "seq", "client", "service", "reject_reasons"]
#: Buckets of a dimension and of the ledger; a batch reads those that hold one of its names or keys.
BUCKETS, LEDGER_BUCKETS = 32, 64
#: Format of the facts' partitions: a day's orders (``yyyy-MM-dd``) where a day fills files, else a month's.
GRAIN = "yyyy-MM"
#: Folders of a part before it is merged.
MOST_LOTS = 8

_INVOICE = ["id_facture", "facture_no", "date_facture", "statut_paiement", "id_client", "id_employe", "event_key"]
_LINE = ["id_facture", "description", "quantite", "prix_unitaire", "total_ligne", "id_service"]


def _bucket(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _period(day: str, grain: str) -> Column:
    return F.date_format(day, grain)


def _values(df: DataFrame, column: str) -> list[str]:
    """The different values of a bucket or period: a fixed number of buckets, or a calendar's periods."""
    return [str(r[0]) for r in df.select(column).distinct().collect()]


def seed_dimensions(clients: DataFrame, employees: DataFrame, root: str, grain: str = GRAIN) -> None:
    """Commit the starting dimensions before the first batch."""
    spark = clients.sparkSession
    changes = [V.write_lot(state.withColumn("bucket", _bucket("cle", BUCKETS)), root, table, "bucket")
               for table, state in (("client", G.client_state(clients)), ("employe", G.employee_state(employees)))]
    V.commit(spark, root, V.snapshot(spark, root), V.merged(*changes, {"info": {"batch": -1, "grain": grain}}))


def read_table(spark: SparkSession, root: str, table: str, state: dict | None = None) -> DataFrame:
    """``facture``, ``ligne_facture``, ``rejets``, ``client``, ``employe`` or ``jours`` as the last commit left it."""
    state = state or V.snapshot(spark, root)
    if table in ("facture", "ligne_facture"):
        return V.read(spark, root, state, "commande").select(*(_INVOICE if table == "facture" else _LINE))
    df = V.read(spark, root, state, table)
    if table in ("client", "employe"):
        return (G.client_rows if table == "client" else G.employee_rows)(df.drop("bucket"))
    return df.drop("periode")


def read_days(spark: SparkSession, root: str) -> DataFrame:
    """(ds, y, n_orders, rafraichi_le): each day's revenue and orders."""
    return read_table(spark, root, "jours")


def delivered(spark: SparkSession, root: str, state: dict, batch: DataFrame) -> DataFrame:
    """(event_key) of the batch's events that earlier batches had; ``batch`` has event_key and its ledger bucket."""
    known = V.read(spark, root, state, "registre", _values(batch, "bucket"))
    maps, bits = bloom(batch, "event_key", batch.count())
    return might_be_in(known, "event_key", maps, bits).join(batch, "event_key", "left_semi").select("event_key")


def day_revenue(spark: SparkSession, root: str, state: dict, periods: Iterable[str]) -> DataFrame:
    """Revenue and orders by day, from the facts of these partitions alone."""
    facts = V.read(spark, root, state, "commande", periods)
    return (facts.groupBy("periode", F.col("date_facture").alias("ds"))
            .agg(F.sum(F.col("total_ligne").cast("decimal(18,2)")).cast("decimal(38,2)").alias("y"), F.count_distinct("id_facture").alias("n_orders"))
            .select("ds", "y", "n_orders", F.current_timestamp().alias("rafraichi_le"), "periode"))


def _merged_dimension(spark: SparkSession, root: str, state: dict, table: str, events: DataFrame, merge) -> dict:
    """The change that rewrites the buckets which hold one of the batch's names."""
    events = events.withColumn("bucket", _bucket("cle", BUCKETS))
    touched = _values(events, "bucket")
    old = V.read(spark, root, state, table, touched).drop("bucket")
    after = merge(old, events.drop("bucket")).withColumn("bucket", _bucket("cle", BUCKETS))
    return V.replacing(state, V.write_lot(after, root, table, "bucket"), table, touched)


def process_batch(batch: DataFrame, batch_id: int, root: str, services: DataFrame) -> None:
    spark = batch.sparkSession
    state = V.snapshot(spark, root)
    if state["info"]["batch"] >= batch_id:
        return  # committed before a crash
    grain = state["info"]["grain"]
    keyed = batch.withColumn("bucket", _bucket("event_key", LEDGER_BUCKETS))
    new = G.first_per_event(keyed)
    if "registre" in state["schemas"]:
        new = new.join(delivered(spark, root, state, keyed.select("event_key", "bucket")), "event_key", "left_anti")
    # each event's reasons are computed once; the steps below read them
    checked = V.write_lot(G.with_known_service(new, services), root, "_lots")
    checked = spark.read.parquet(f"{root}/{checked['add']['_lots'][''][0]}")

    facts = G.order_facts(checked.drop("id_service"), services).withColumn("periode", _period("date_facture", grain))
    taken = checked.where("is_valid")
    change = V.merged(
        V.write_lot(facts, root, "commande", "periode"),
        V.write_lot(checked.where("NOT is_valid").select(*REJECT_COLS), root, "rejets"),
        V.write_lot(checked.select("event_key", "bucket"), root, "registre", "bucket"),
        _merged_dimension(spark, root, state, "client", G.client_events(taken), G.merge_clients),
        _merged_dimension(spark, root, state, "employe", G.employee_events(taken), G.merge_employees))
    after = V.applied(state, change, state["number"] + 1)  # as readers will see it
    days = day_revenue(spark, root, after, list(change["add"]["commande"]))
    change = V.merged(change, V.replacing(state, V.write_lot(days, root, "jours", "periode"), "jours"), {"info": {"batch": batch_id}})
    V.commit(spark, root, state, change)
    V.remove(spark, f"{root}/_lots")  # what only this batch read


def tidy(spark: SparkSession, root: str) -> None:
    """Merge parts of many folders, and delete what has long been replaced."""
    for table in ("commande", "rejets", "registre"):
        V.compact(spark, root, table, MOST_LOTS)
    V.vacuum(spark, root)


def run_order_stream(spark: SparkSession, landing: str, root: str, checkpoint: str,
                     schema, services: DataFrame, files_per_batch: int = 1) -> None:
    """Drain the landing folder (``availableNow``) through :func:`process_batch`."""
    def step(df: DataFrame, batch_id: int) -> None:
        process_batch(df, batch_id, root, services)
        tidy(spark, root)

    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(landing))
    q = (stream.writeStream
         .foreachBatch(step)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
