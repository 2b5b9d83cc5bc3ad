"""Catalogue matching on a stand-in catalogue, and the matching operators against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from sthalam.operators import matching as M
from sthalam.plans.project_match import dimensions, match_projects

#: Stand-in records and pins, invented to satisfy the documented assertions.
CATALOGUE = [
    ("Prestige Shantiniketan", "Bangalore", "Whitefield", "560066;560048"), ("Elements Mall", "Bangalore", "Thanisandra", "560045"), ("SLS Springs", "Bangalore", "Haralur", "560102"), ("Sobha Daffodils", "Bangalore", "HSR Layout", "560102"),
    ("Maithri Shilpitha Sunflower", "Bangalore", "Whitefield", "560066"), ("Purva Venezia", "Bangalore", "Yelahanka New Town", "560064"), ("Elegant Exotica Yelahanka New Town", "Bangalore", "Yelahanka", "560064"), ("Confident Atria Phase IV", "Bangalore", "Sarjapur", "562125"),
    ("Nandi Gardens Phase II", "Bangalore", "JP Nagar", "560062"), ("79 Orchids", "Bangalore", "Orchid Test Area", "560999"), ("Renuka Residency", "Bangalore", "Renuka Test Area", "560998"), ("Maruthi Mansion", "Bangalore", "Maruthi Test Area", "560997"),
    ("Sai Nivas", "Bangalore", "Sai Test Area", "560049"), ("Lodha Bellezza Sky Villas", "Hyderabad", "Kukatpally", "500072"), ("Runwal Greens", "Mumbai", "Mulund West", "400078"), ("Unitech The Close North", "Gurgaon", "Sector 50", "122018"),
]
CASES = [
    ("FLAT 1 PRESTIGE SHANTINIKETAN WHITEFIELD", "400001", None), ("FLAT 1 PRESTIGE SHANTINIKETAN WHITEFIELD", "560066", "Prestige Shantiniketan"), ("H NO 189 3RD CROSS THANISANDRA RD NEAR ELEMENTS MALL", "560045", None),
    ("E-120 SLS SPRINGS HARALUR VILLAGE BEHIND SOBHA DAFFODILS HSR LAYOUT", "560102", "SLS Springs"), ("A 1005 SPRING BLOCK SHILPITHA SUNFLOWER SOCIETY", "560066", "Maithri Shilpitha Sunflower"), ("VD 802 PURVA VENEZIA YELAHANKA NEW TOWN BANGALORE", "560064", "Purva Venezia"),
    ("FLAT 101 CONFIDENT ATRIA PHASE IV SARJAPUR", "562125", "Confident Atria Phase IV"), ("FLAT 10 NANDI GARDENS PHASE 1 J P NAGAR", "560062", None), ("T301 79 ORCHIDS 5TH CROSS ROYAL ENCLAVE", "560064", None), ("NO S101 FIRST FLOOR RENUKA RESIDENCY PANATHUR VILLAGE", "560087", "Renuka Residency"),
    ("NO 1C MARUTHI MANSION 1ST CROSS SARASWATHIPURAM", "560096", None), ("FP#35 SAI NIVAS PATEL LAYOUT CHEEMASANDRA", "560049", None), ("S/O LATE SATHI RAJU FLAT NO 106 KOTE ARCADE APARTMENT K CHANNASANDRA", "560067", None), ("FLAT 1204 LODHA BELLEZZA MANJEERA ROAD KUKATPALLY HYDERABAD", "500072", "Lodha Bellezza Sky Villas"),
    ("A-703 RUNWAL GREENS MULUND WEST MUMBAI", "400078", "Runwal Greens"), ("TOWER 4 UNITECH THE CLOSE NORTH SECTOR 50 GURGAON", "122018", "Unitech The Close North"), (None, None, None), ("", "560066", None),
]
PIN_CITY = {"Bangalore": ["560066", "560045", "560102", "560064", "562125", "560062", "560087", "560096", "560049", "560067"], "Mumbai": ["400001", "400078"], "Hyderabad": ["500072"], "Gurgaon": ["122018"]}
GEO = [("560064", 13.10, 77.59), ("560999", 13.1558, 77.59), ("560087", 12.93, 77.70), ("560998", 12.95, 77.71), ("560096", 13.01, 77.53), ("560997", 13.07, 77.53)]


@pytest.fixture(scope="module")
def matched(spark):
    cat = spark.createDataFrame([(i, *r, "high") for i, r in enumerate(CATALOGUE)], "rec_id bigint, projectname string, city string, sublocation string, all_pincodes string, pincode_confidence string")
    loc = spark.createDataFrame([(p, f"Area {p}", c, "both") for c, ps in PIN_CITY.items() for p in ps], "pincode string, locality string, city string, source string")
    geo = spark.createDataFrame(GEO, "pin string, latitude double, longitude double")
    a = spark.createDataFrame([(i, x, z, None, None, None, "clash") for i, (x, z, _) in enumerate(CASES)], "id bigint, address string, zip string, city string, locality string, building string, name string")
    return {r["id"]: r for r in match_projects(a, dimensions(cat, loc, geo)).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_golden_projects(matched, i):
    assert matched[i]["project"] == CASES[i][2], matched[i]


def test_reasons(matched):
    assert matched[11]["reason"] == "generic_pincode_only" and matched[12]["reason"] == "no_project" and matched[16]["reason"] == "no_city"
    assert matched[9]["rule"] == "project_unique_nearby"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_indel_ratio():
    r = random.Random(1)
    for _ in range(400):
        a, b = ("".join(r.choice("ABC ") for _ in range(r.randrange(12))) for _ in range(2))
        want = 100.0 if not a and not b else 200 * lcs(a, b) / (len(a) + len(b))
        assert abs(M.indel_ratio(a, b) - want) < 1e-9
    assert M.token_set_ratio("SAI NIVAS", "NEW SAI NIVAS") == 100.0 and M.token_set_ratio("", "X") == 0.0


def test_fuzzy_prefilter_loses_nothing(spark):
    r = random.Random(2)
    words = ["".join(r.choice("ABCD") for _ in range(r.randrange(4, 12))) for _ in range(60)]
    d = spark.createDataFrame([(1, w) for w in sorted(set(words))], "k int, a string")
    got = {(x["a"], x["b"]) for x in M.fuzzy_pairs(d, d.withColumnRenamed("a", "b"), ["k"], 80.0).collect()}
    assert got == {(a, b) for a in set(words) for b in set(words) if M.indel_ratio(a, b) >= 80.0}


def test_contained_names(spark):
    r = random.Random(3)
    texts = [(i, "".join(r.choice("AB") for _ in range(30))) for i in range(20)]
    names = ["".join(r.choice("AB") for _ in range(r.randrange(6, 9))) for _ in range(40)]
    n = spark.createDataFrame([(x,) for x in names], "name string")
    got = {(x["id"], x["name"]) for x in M.contained_names(spark.createDataFrame(texts, "id int, t string"), "id", F.col("t"), n, prefix=4, least=6).collect()}
    assert got == {(i, x) for i, t in texts for x in names if x in t}


def test_nested_hits_and_cascade(spark):
    d = spark.createDataFrame([(1, "PURAM"), (1, "K R PURAM"), (2, "PURAM")], "id int, name string")
    assert sorted(map(tuple, M.without_nested(d, "id").collect())) == [(1, "K R PURAM"), (2, "PURAM")]
    c = spark.createDataFrame([(None, " ", "z"), ("x", "y", None), (None, None, None)], "a string, b string, c string")
    got = [tuple(r["v"]) for r in c.select(M.first_known(a=F.col("a"), b=F.col("b"), c=F.col("c")).alias("v")).collect()]
    assert got == [("z", "c"), ("x", "a"), (None, None)]


def test_near_pairs_are_those_of_all_pairs(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("BDKLMN") + r.choice("AEIOU") for _ in range(r.randrange(1, 7)))
    names = [f"ZENARA {word()} {r.choice(['TOWERS', 'HEIGHTS', 'PHASE 2', 'É', ''])}".strip() for _ in range(150)]

    def slipped(x: str) -> str:
        for _ in range(r.randrange(4)):
            i = r.randrange(7, len(x) + 1)
            x = x[:i] + r.choice(["", "A", "K", " ", "2", "É"]) + x[i + r.randrange(2) :]
        return x

    runs = [slipped(x) for x in names for _ in range(3)] + ["", "ZENARA"]
    both = [("a", x) for x in runs] + [("b", x) for x in runs[:50]]
    left, right = spark.createDataFrame(both, "k string, a string"), spark.createDataFrame([(k, x) for k in "ac" for x in [*names, ""]], "k string, b string")
    for cutoff in (92.0, 80.0):
        got = [(x["k"], x["a"], x["b"], x["score"]) for x in M.near_pairs(left, right, ["k"], cutoff).collect()]
        want = {("a", a, b, M.indel_ratio(a, b)) for a in runs for b in [*names, ""] if M.indel_ratio(a, b) >= cutoff}
        assert set(got) == want and len(got) == len(want) > 300


def test_project_names_are_not_compared_with_every_run_of_their_brand(spark, monkeypatch):
    from sthalam.plans import project_match as P

    names = spark.createDataFrame([("velmora", "ZENARA KIMALO TOWERS"), ("velmora", "ZENARA KIMALA TOWERS"), ("velmora", "ZENARA DUBENI")], "city_key string, name string")
    dims = P.Dimensions(*[None] * 9)
    dims.names, dims.fragments = names, spark.createDataFrame([], "city_key string, run string, name string")
    a = spark.createDataFrame([(1, "velmora", "NO 4 ZENARA KIMALOO TOWERS LAKE ROAD", None), (2, "other", "ZENARA KIMALOO TOWERS", None)], "id int, city_key string, text string, building string")
    monkeypatch.setattr(M, "fuzzy_pairs", lambda *x, **k: pytest.fail("all pairs of a brand are compared"))
    got = {(x["id"], x["name"], x["kind"], x["span"]) for x in P.candidates(a, dims).collect()}
    assert got == {(1, "ZENARA KIMALO TOWERS", "fuzzy_strong", "ZENARA KIMALOO TOWERS"), (1, "ZENARA KIMALA TOWERS", "fuzzy", "ZENARA KIMALOO TOWERS")}
