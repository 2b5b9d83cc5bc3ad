"""Cleaning and normalising, with the documented golden cases."""

import pytest
from pyspark.sql import functions as F

from sthalam.functions import extract as X
from sthalam.functions import text as T
from sthalam.plans.parse import prepare

VOCABULARY = {"ROAD", "HOSUR", "BANGALORE", "WHITEFIELD", "APARTMENT", "PROVIDENT", "SUNWORTH", "VENKATAPURA"}


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("address", "zip_code", "text"), [
    ("INDIA INFOLINE LTD  31/9 KRIMSON SQUARE 2ND FLOOR  HOSU R MAIN ROAD  BANGALORE", "560068", "31/9 KRIMSON SQUARE 2ND FLOOR, HOSUR MAIN ROAD, BANGALORE"),
    ("ADITYA APARTMENT R OAD BEHIND", "", "ADITYA APARTMENT ROAD BEHIND"),
    ("NO 5 K R PURAM M G ROAD", "", "NO 5 K R PURAM M G ROAD"),
    ("AMODA APARTMENT BANGALORE BANGALORE", "", "AMODA APARTMENT BANGALORE"),
    ("BISMILLA NAGAR###### BANGALORE", "", "BISMILLA NAGAR, BANGALORE"),
    ("NO 66/3 BAGMANE TECH PARK", "", "NO 66/3 BAGMANE TECH PARK"),
    ("PROVIDENTSUNWORTHVENKATAPURA", "", "PROVIDENT SUNWORTH VENKATAPURA"),
    (None, None, ""),
    ("", "", ""),
])
def test_prepared_text(spark, address, zip_code, text):
    d = spark.createDataFrame([(address, zip_code)], "address string, zip string")
    assert prepare(d, vocabulary=VOCABULARY).first()["text"] == text


def test_prepared_fields(spark):
    d = spark.createDataFrame([("S/O LATE SATHI RAJU FLAT NO 106 KOTE ARCADE APARTMENT", "560067"), ("3RD CROSS a.b@c.test 9876543210 560001", "")], "address string, zip string")
    a, b = prepare(d).collect()
    assert a["care_of"] == "LATE SATHI RAJU" and "SATHI" not in a["text"] and a["pin"] == "560067"
    assert b["pin"] == "560001" and "ORD" in b["parser_text"] and [x["step"] for x in b["dropped"]] == ["email", "phone"] and "@" not in b["text"]


@pytest.mark.parametrize(("function", "value", "wanted"), [
    (T.norm_name, " Sai-Nivas,  #2 ", "SAI NIVAS 2"),
    (T.split_figures, "TOWER12A", "TOWER 12 A"),
    (T.match_text, "J.P. Ngr 2nd Stg", "J P NAGAR 2ND STAGE"),
    (T.locality_base, "HSR LAYOUT SECTOR 2", "HSR LAYOUT"),
    (T.city_key, "Gurugram", "gurgaon"),
    (T.clean_locality, "Bommanahalli S.O (Bengaluru)", "Bommanahalli"),
    (T.clean_locality, "Bengaluru G.", None),
    (T.restore_ordinals, "3ORDRD CROSS", "3rd CROSS"),
    (T.protect_ordinals, "3RD CROSS", "3ORDRD CROSS"),
    (T.unglue, "LAYOUTKAGGADASAPURABENGALUR", "LAYOUT KAGGADASAPURA BENGALUR"),
    (T.phase_numbers, "Nandi Gardens Phase II", ["2"]),
    (T.generic_name, "SAI NIVAS", True),
    (T.generic_name, "RENUKA RESIDENCY", False),
    (T.rejected_name, "PVT LTD", True),
    (T.building_number, "FLAT NO 106 KOTE ARCADE", "106"),
])
def test_scalars(spark, function, value, wanted):
    assert one(spark, function, value) == wanted


def test_landmark_guard(spark):
    words = "H NO 189 3RD CROSS RD NEAR ELEMENTS MALL".split()
    d = spark.createDataFrame([(words,)], "w array<string>")
    assert d.select(T.named_as_landmark(F.col("w"), F.lit("ELEMENTS")).alias("y")).first()["y"]
    assert not d.select(T.named_as_landmark(F.col("w"), F.lit("CROSS")).alias("y")).first()["y"]


def test_confidence_terms(spark):
    def score(**given):
        names = ["pin", "pin_known", "state", "city_agrees", "city", "building", "rule", "osm", "same_as_locality", "locality_source", "locality", "number", "landmark"]
        kinds = {"pin": "boolean", "pin_known": "boolean", "state": "int", "city_agrees": "boolean", "osm": "boolean", "same_as_locality": "boolean"}
        args = [F.lit(given.get(n)).cast(kinds.get(n, "string")) for n in names]
        return spark.range(1).select(T.confidence(*args).alias("y")).first()["y"]

    assert score() == 0.0
    assert score(pin=True) == 0.18 and score(pin=True, pin_known=True) == 0.25
    assert score(pin=True, state=-1) == 0.06 and score(state=1) == 0.15 and score(state=-1) == 0.0 and score(state=0) == 0.05
    assert score(city_agrees=True) == 0.1 and score(city="X") == 0.04
    assert score(building="B", rule="project_locality") == 0.38 and score(building="B", osm=True) == 0.34 and score(building="B", same_as_locality=True) == 0.26 and score(building="B") == 0.28
    assert score(locality="L", locality_source="gazetteer") == 0.08 and score(locality="L", locality_source="sheet_hint") == 0.05
    assert score(number="1") == 0.04 and score(landmark="X") == 0.04
    assert score(pin=True, pin_known=True, state=1, city_agrees=True, building="B", rule="project_locality_pincode", locality="L", locality_source="dotcom_match", number="1", landmark="X") == 1.0


@pytest.mark.parametrize(("function", "norm", "wanted"), [
    (X.trimmed_building, "THANGAM 2ND CROSS ADITYA APARTMENT", "ADITYA APARTMENT"),
    (X.trimmed_building, "PVT LTD", None),
    (X.compound_building, "NO 203 JAYVILLA ROAD", "JAYVILLA"),
    (X.layout_building, "NO 5 GREEN HILL LAYOUT BANGALORE", "GREEN HILL LAYOUT"),
    (X.landmark_building, "FLAT 2 NEAR SKY HIGH TOWERS HEBBAL", "SKY HIGH TOWERS"),
    (X.before_bldg, "12 ROSE GARDEN BLDG PUNE", "ROSE GARDEN"),
    (X.residence, "7 SAI KRUPA RESIDENCE PUNE", "SAI KRUPA RESIDENCE"),
    (X.single_area, "NO 8 AKSHAYNAGAR BANGALORE", "AKSHAYNAGAR"),
    (X.first_building, "FLAT 101 HAPPY HOME HEBBAL", "HAPPY HOME HEBBAL"),
    (X.first_building, "", None),
])
def test_extractors(spark, function, norm, wanted):
    assert one(spark, function, norm) == wanted


def test_extractors_beside_a_locality(spark):
    d = spark.createDataFrame([("12 SUBASH NAGAR ROSE COLONY", "Subash Nagar"), (None, None)], "n string, l string")
    a, b = d.select(X.society(F.col("n"), F.col("l")).alias("s"), X.locality_as_building(F.col("n"), F.col("l")).alias("l"), X.fallback_building(F.col("n"), F.col("l")).alias("f")).collect()
    assert a["l"] == "SUBASH NAGAR" and a["f"]["value"] is not None and b["f"]["value"] is None
