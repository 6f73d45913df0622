"""Scalar functions on inline values (dates, labels, numbers, text)."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.functions import dates as D
from sparkmart.functions import labels as L
from sparkmart.functions import money as M
from sparkmart.functions import text as T


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_parse_date_formats(spark):
    got = _one(spark, ["15/06/2024", "5/6/2024", "2024-06-15", "15-06-2024", " 01/02/2025 "], D.parse_date)
    assert got == [dt.date(2024, 6, 15), dt.date(2024, 6, 5), dt.date(2024, 6, 15),
                   dt.date(2024, 6, 15), dt.date(2025, 2, 1)]


def test_parse_date_free_text_month(spark):
    got = _one(spark, ["Début Juin 2024", "fin août 2025", "Décembre 2024"], D.parse_date)
    assert got == [dt.date(2024, 6, 1), dt.date(2025, 8, 1), dt.date(2024, 12, 1)]


def test_parse_date_invalid_and_null(spark):
    got = _one(spark, ["pas une date", "32/13/2024", "", None, "Début Juni 2024", "juin 0000"], D.parse_date)
    assert got == [None] * 6


def test_service_aliases(spark):
    got = _one(spark, [" sérigrafe ", "IMPRIMERIE", "video surveillance", "Maint.", "Autre", None],
               L.normalise_service)
    assert got == ["Sérigraphie", "Imprimerie", "Vidéosurveillance", "Maintenance", "Autre", None]


def test_status_aliases(spark):
    got = _one(spark, ["paye", "En attente", "impayé", "Partiel", "??"], L.normalise_status)
    assert got == ["Payé", "Non payé", "Non payé", "Partiel", "??"]


def test_city_variants(spark):
    got = _one(spark, ["pointe noire", " PN ", "Pte-Noire", "Brazzaville"], L.normalise_city)
    assert got == ["Pointe-Noire", "Pointe-Noire", "Pointe-Noire", "Brazzaville"]


def test_safe_number(spark):
    got = _one(spark, ["12", " 3.5 ", "abc", "12d", "NaN", "", "-4", "1e3", None], M.safe_number)
    assert got == [12.0, 3.5, None, None, None, None, -4.0, 1000.0, None]


def test_round_half_even(spark):
    got = _one(spark, [0.5, 1.5, 2.5, -0.5], lambda c: M.to_money_int(c), "double")
    assert got == [0, 2, 2, 0]


def test_round_half_up_helper(spark):
    got = _one(spark, [1.25, 2.675, float("inf")], lambda c: M.round_half_up(c, 1), "double")
    assert got[0] == 1.3 and got[2] == float("inf")


def test_clean_text_folds_missing(spark):
    got = _one(spark, ["  a ", "", "nan", "None", None, " x\t"], T.clean_text)
    assert got == ["a", None, None, None, None, "x"]


def test_is_all_upper(spark):
    got = _one(spark, ["ABC", "Abc", "123", "ÉCOLE", None], T.is_all_upper)
    assert got == [True, False, False, True, False]


def test_slugify(spark):
    got = _one(spark, ["Sérigraphie", " Vidéosurveillance ", "Maintenance informatique", "Façade"], T.slugify)
    assert got == ["serigraphie", "videosurveillance", "maintenance_informatique", "fa_ade"]
