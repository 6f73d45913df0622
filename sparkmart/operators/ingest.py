"""Order ingestion: validate, assign ids, upsert dimensions, append facts.

Every step is a set operation over a batch of order events, so the same code
serves a daily batch and a streaming micro-batch (``streaming.orders``).

* validation collects every failed rule of a row in one reason list;
* the invoice id is hashed from the event key, so a replayed event gets the
  same id (the source system drew a random one per request);
* client upsert: case-insensitive key, the first spelling ever seen is kept,
  the phone is replaced only by a supplied one (the last supplied in event
  order wins); employee upsert keeps the first spelling too.  A dimension's state
  has the event number of its spelling and phone, so merging is commutative,
  associative and idempotent: any split and order of batches gives the same table;
* invoice and line of one order are produced together from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import invoice_key, invoice_number, name_key
from ..functions.text import lower_key
from ..functions.vocab import (ORDER_CLIENT_MAX, ORDER_DESCRIPTION_MAX, ORDER_EMPLOYEE_MAX,
                               ORDER_PHONE_MAX, PAYMENT_STATUSES, SERVICES)
from .dedup import keep_first

DEFAULT_STATUS = "Non payé"


def _len_rule(c: str, lo: int | None, hi: int | None, required: bool) -> list[Column]:
    x = F.col(c)
    out = []
    if required:
        out.append(F.when(x.isNull(), F.lit(f"{c}:missing")))
    if lo is not None:
        out.append(F.when(F.length(x) < lo, F.lit(f"{c}:too_short")))
    if hi is not None:
        out.append(F.when(F.length(x) > hi, F.lit(f"{c}:too_long")))
    return out


def reasons(orders: DataFrame) -> Column:
    """Failed rules of a row, in a fixed order, joined by ``,`` (empty = valid)."""
    rules = [
        *_len_rule("client", 1, ORDER_CLIENT_MAX, True),
        *_len_rule("telephone", None, ORDER_PHONE_MAX, False),
        F.when(F.col("service").isNull(), F.lit("service:missing"))
        .when(~F.col("service").isin(SERVICES), F.lit("service:not_allowed")),
        *_len_rule("employe", 1, ORDER_EMPLOYEE_MAX, True),
        F.when(F.col("statut_paiement").isNotNull() & ~F.col("statut_paiement").isin(PAYMENT_STATUSES),
               F.lit("statut_paiement:not_allowed")),
        *_len_rule("description", 1, ORDER_DESCRIPTION_MAX, True),
        F.when(F.col("quantite").isNull(), F.lit("quantite:missing"))
        .when(F.col("quantite") < 1, F.lit("quantite:below_min")),
        F.when(F.col("prix_unitaire").isNull(), F.lit("prix_unitaire:missing"))
        .when(F.col("prix_unitaire") <= 0, F.lit("prix_unitaire:below_min")),
    ]
    return F.concat_ws(",", F.array_compact(F.array(*rules)))


def validate_orders(orders: DataFrame) -> DataFrame:
    """All events with ``reject_reasons``, ``is_valid``, defaults and total.

    An order without a date has the day of its arrival (``arrived_on`` of the event,
    where the feed has it), so a replay gives the same row on any day.
    """
    r = reasons(orders)
    arrived = F.col("arrived_on") if "arrived_on" in orders.columns else F.current_date()
    return orders.select(
        "*",
        r.alias("reject_reasons"), (r == "").alias("is_valid"),
        F.coalesce(F.col("statut_paiement"), F.lit(DEFAULT_STATUS)).alias("statut"),
        F.coalesce(F.col("date_facture"), arrived).alias("date_cmd"),
        F.when(r == "", F.col("quantite") * F.col("prix_unitaire")).alias("total"),
    )


def validated(orders: DataFrame) -> DataFrame:
    """``orders`` with their reasons, which stored events have already."""
    return orders if "reject_reasons" in orders.columns else validate_orders(orders)


def accepted(orders: DataFrame) -> DataFrame:
    """Valid events with their invoice key and display number (both hashed from the event key)."""
    v = validated(orders).filter("is_valid")
    return v.select("*", invoice_key("event_key").alias("facture_id"), invoice_number("date_cmd", "event_key").alias("facture_no"),
                    F.when(F.col("telephone") == "", None).otherwise(F.col("telephone")).alias("tel"))


def with_known_service(orders: DataFrame, services: DataFrame) -> DataFrame:
    """Validated events; one whose service is not in the dimension is rejected with ``service:unknown``."""
    svc = services.select(F.col("libelle").alias("service"), "id_service")
    v = validated(orders).join(svc, "service", "left")
    unknown = F.col("is_valid") & F.col("id_service").isNull()
    return (v.withColumn("reject_reasons", F.when(unknown, F.lit("service:unknown")).otherwise(F.col("reject_reasons")))
            .withColumn("is_valid", F.col("is_valid") & ~unknown))


def rejected(orders: DataFrame, services: DataFrame) -> DataFrame:
    """Events that are not taken, with their reasons."""
    return with_known_service(orders, services).filter(~F.col("is_valid"))


#: The event number of what a dimension had before any event: its spelling stays, its phone gives way.
BEFORE = -(1 << 62)


def client_state(dim: DataFrame) -> DataFrame:
    """A client dimension (id_client, nom_client, telephone, ...) as the state that batches merge into."""
    own = [c for c in dim.columns if c not in ("id_client", "nom_client", "telephone")]
    seq = F.lit(BEFORE).cast("bigint")
    phone = F.when(F.col("telephone").isNotNull(), F.struct(seq.alias("seq"), F.col("telephone").alias("text")))
    return dim.select(lower_key("nom_client").alias("cle"), "id_client", F.struct(seq.alias("seq"), F.col("nom_client").alias("text")).alias("nom"),
                      phone.alias("tel"), *own)


def client_events(orders: DataFrame) -> DataFrame:
    """One row per client of a batch: first spelling and last supplied phone, each with its event number."""
    a = accepted(orders)
    phone = F.when(F.col("tel").isNotNull(), F.struct("seq", F.col("tel").alias("text")))
    return a.groupBy(lower_key("client").alias("cle")).agg(F.min(F.struct("seq", F.col("client").alias("text"))).alias("nom"), F.max(phone).alias("tel"))


def merge_clients(state: DataFrame, events: DataFrame) -> DataFrame:
    """The state after a batch: least event for the spelling, greatest for the phone."""
    own = [c for c in state.columns if c not in ("cle", "id_client", "nom", "tel")]
    both = state.unionByName(events, allowMissingColumns=True)
    return both.groupBy("cle").agg(
        F.coalesce(F.max("id_client"), name_key(F.min("nom")["text"])).alias("id_client"), F.min("nom").alias("nom"), F.max("tel").alias("tel"),
        *[F.max(c).alias(c) for c in own])  # only a dimension's own row has them


def client_rows(state: DataFrame) -> DataFrame:
    """The client dimension that a state stands for."""
    own = [c for c in state.columns if c not in ("cle", "id_client", "nom", "tel")]
    return state.select("id_client", F.col("nom.text").alias("nom_client"), F.col("tel.text").alias("telephone"), *own)


def upsert_clients(dim: DataFrame, orders: DataFrame) -> DataFrame:
    """Client dimension after the batch (``dim``: id_client, nom_client, telephone, …); hot clients cost one row."""
    return client_rows(merge_clients(client_state(dim), client_events(orders))).select(*dim.columns)


def employee_state(dim: DataFrame) -> DataFrame:
    return dim.select(lower_key("nom_employe").alias("cle"), "id_employe",
                      F.struct(F.lit(BEFORE).cast("bigint").alias("seq"), F.col("nom_employe").alias("text")).alias("nom"))


def employee_events(orders: DataFrame) -> DataFrame:
    return accepted(orders).groupBy(lower_key("employe").alias("cle")).agg(F.min(F.struct("seq", F.col("employe").alias("text"))).alias("nom"))


def merge_employees(state: DataFrame, events: DataFrame) -> DataFrame:
    return state.unionByName(events, allowMissingColumns=True).groupBy("cle").agg(
        F.coalesce(F.max("id_employe"), name_key(F.min("nom")["text"])).alias("id_employe"), F.min("nom").alias("nom"))


def employee_rows(state: DataFrame) -> DataFrame:
    return state.select("id_employe", F.col("nom.text").alias("nom_employe"))


def upsert_employees(dim: DataFrame, orders: DataFrame) -> DataFrame:
    """Employee dimension after the batch: unknown names inserted, known ones untouched."""
    return employee_rows(merge_employees(employee_state(dim), employee_events(orders)))


def order_facts(orders: DataFrame, services: DataFrame) -> DataFrame:
    """Invoice + line of every accepted order (one row: both parts together).

    Client and employee keys are the derived keys of the upserted rows; the service is
    looked up in its dimension, and an order whose service is not there is rejected
    (see :func:`rejected`).  :func:`invoices_of` and :func:`lines_of` split the two tables.
    """
    a = accepted(orders)
    svc = services.select(F.col("libelle").alias("service"), "id_service")
    j = a.join(svc, "service")
    return j.select(
        F.col("facture_id").alias("id_facture"), "facture_no", F.col("date_cmd").alias("date_facture"),
        F.col("statut").alias("statut_paiement"),
        name_key(F.col("client")).alias("id_client"), name_key(F.col("employe")).alias("id_employe"),
        "description", "quantite", "prix_unitaire", F.col("total").alias("total_ligne"), "id_service",
        "event_key")


def invoices_of(facts: DataFrame) -> DataFrame:
    return facts.select("id_facture", "facture_no", "date_facture", "statut_paiement", "id_client", "id_employe", "event_key")


def lines_of(facts: DataFrame) -> DataFrame:
    return facts.select("id_facture", "description", "quantite", "prix_unitaire", "total_ligne", "id_service")


def first_per_event(orders: DataFrame) -> DataFrame:
    """Drop repeated deliveries of the same event (at-least-once sources)."""
    return keep_first(orders, ["event_key"], ["seq"])
