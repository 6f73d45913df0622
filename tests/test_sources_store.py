"""Untyped source scans and the table sinks (versioned publish, partition replace)."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import clean as C
from sparkmart.sources import files as FS
from sparkmart.sources import store as ST


def _dir(spark, name):
    return os.path.join(spark.conf.get("spark.checkpoint.dir"), f"{name}-{uuid.uuid4().hex[:8]}")


def test_csv_scan_keeps_text_and_trims_header(spark):
    d = _dir(spark, "csv")
    os.makedirs(d)
    with open(os.path.join(d, "clients.csv"), "w", encoding="utf-8") as fh:
        fh.write(" Nom_Client ,Entreprise,Telephone,Email,Ville,Notes\n")
        fh.write("Acme,,007,nan,PN,\n")
    df = FS.scan_text(spark, d, "csv", [c.strip() for c in FS.SOURCE_HEADERS["clients"]])
    assert df.columns == ["nom_client", "entreprise", "telephone", "email", "ville", "notes"]
    r = df.collect()[0]
    assert r.telephone == "007" and r.email == "nan"      # leading zero kept: nothing inferred


def test_csv_columns_are_matched_by_name(spark):
    d = _dir(spark, "csv")
    os.makedirs(d)
    with open(os.path.join(d, "clients.csv"), "w", encoding="utf-8") as fh:
        fh.write("Extra,Notes,Ville,Email,Telephone,Entreprise,Nom_Client\nx,n,PN,e@x,007,Co,Acme\n")
    r = FS.scan_source(spark, "clients", d, "csv").collect()[0]
    assert r.asDict() == {"nom_client": "Acme", "entreprise": "Co", "telephone": "007", "email": "e@x", "ville": "PN", "notes": "n"}
    with pytest.raises(ValueError, match="missing columns"):
        FS.scan_source(spark, "sales", d, "csv")


def test_json_scan_all_text(spark):
    d = _dir(spark, "json")
    os.makedirs(d)
    with open(os.path.join(d, "p.json"), "w", encoding="utf-8") as fh:
        fh.write('{"Date": "01/06/2024", "Fournisseur": "F", "Article": "A", "Categorie": "C", "Quantite": 3, '
                 '"Prix_Achat_Total": -5.5, "Mode_Paiement": null}\n')
    df = FS.scan_all(spark, {"purchases": (d, "json")})["purchases"]
    assert dict(df.dtypes)["quantite"] == "string"
    assert df.collect()[0].prix_achat_total == "-5.5"


def test_archive_lowercases_and_stamps(spark):
    df = spark.createDataFrame([("a",)], "Client string")
    out = ST.archive_frame(df)
    assert out.columns == ["client", "charge_le"]


def test_publish_switches_pointer_and_keeps_old_version(spark):
    root = _dir(spark, "table")
    v1 = ST.publish(spark.range(3), root, "v1")
    v2 = ST.publish(spark.range(5), root, "v2")
    assert (v1, v2) == ("v1", "v2") and ST.current_version(spark, root) == "v2"
    assert ST.read_current(spark, root).count() == 5
    assert spark.read.parquet(f"{root}/v=v1/data").count() == 3


def test_clean_all_builds_each_job(spark, sf_small):
    from sparkmart.sources import feeds
    raw = {"sales": feeds.sales_feed(spark, sf_small), "clients": feeds.clients_feed(spark, sf_small),
           "purchases": feeds.purchases_feed(spark, sf_small)}
    out = C.clean_all(raw)
    assert sorted(out) == ["clients", "purchases", "sales"] and out["purchases"].filter("prix_achat_total < 0").count() == 0
    assert out["sales"].filter(F.col("date_facture").isNull()).count() == 0
