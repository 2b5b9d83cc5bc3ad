"""Sampling, canonical values, the address parser, same doors and linkage on small fixtures."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sthalam.llm import canonical as C
from sthalam.llm.address_parts import Gazetteer, Names, gazetteer, one_slip_apart, take_apart
from sthalam.llm.linkage import collective_links, project_parts
from sthalam.llm.proportions import Proportioned, latest_rules, required_rows
from sthalam.llm.same_place import door_links, same_doors

LOCALITIES = [(1, "Mepema Nagar", "Velmora", "210001"), (2, "Kivure Puram", "Velmora", "210002"), (3, "Rimelu Vihar", "Punwadi", "395002"), (4, "Rimelu Vihar", "Nagvelli", "617002"), (1, "Mepema Nagar ", None, "210001")]
G = Gazetteer([(i, n.strip().upper(), c and c.upper(), p) for i, n, c, p in LOCALITIES], {"ZENARA", "QUILLON", "TULIPA", "LUMORA"})


def test_needed_rows_are_exact():
    assert required_rows([("a", 0.1, 0), ("b", 0.3, 25), ("c", None, None)], 70) == {"a": 7, "b": 25, "c": 0}


def test_proportions(spark):
    r = random.Random(1)
    rows = [(i, r.choice([" Alpha ", "ALPHA", "alpha"]) if i % 2 else r.choice(["beta", None, "  ", "gamma"]), f"2024-01-01 00:00:{i % 60:02d}") for i in range(2000)]
    rows += [(5, "beta", "2023-01-01 00:00:00"), (6, "gamma", None), (None, "alpha", "2024-01-01 00:00:00"), (7777, "rare", "2024-01-01 00:00:00")]
    d = spark.createDataFrame(rows, "row_id bigint, dotcom_match_rule string, parsed_at string").withColumn("parsed_at", F.col("parsed_at").cast("timestamp")).withColumn("category", F.lit("clash"))
    last = latest_rules(d)
    assert last.count() == 2001 and {x["category"] for x in last.select("category").distinct().collect()} == {"alpha", "beta", "gamma", "rare", "unmatched"}
    targets = spark.createDataFrame([("alpha", 0.55, 3), ("beta", 0.25, 80), ("rare", 0.05, 2), ("missing", 0.1, 1), ("zero", 0.0, 0)], "match_rule string, target_share double, min_rows bigint")
    p = Proportioned(last, targets)
    rep = {x["match_rule"]: x for x in p.report().collect()}
    assert p.size == 200 and rep["alpha"]["needed"] == 110 and rep["beta"]["needed"] == 80
    assert {k for k, x in rep.items() if x["short"]} == {"rare", "missing"}
    s = p.sample().collect()
    assert len({x["row_id"] for x in s}) == len(s)
    counts = {k: sum(1 for x in s if x["category"] == k) for k in ("alpha", "beta", "rare", "gamma")}
    assert counts == {"alpha": 110, "beta": 80, "rare": 1, "gamma": 0}
    empty = Proportioned(last.limit(0), targets)
    assert empty.sample().count() == 0 and empty.size == 0


def test_prefix_join_is_exact(spark):
    r = random.Random(2)
    bags = [(i, sorted({r.choice("abcdefgh") for _ in range(r.randrange(0, 7))})) for i in range(60)]
    left, right = bags[:35], bags[20:] + [(20, bags[20][1]), (99, None)]
    ld, rd = spark.createDataFrame(left, "id int, tokens array<string>"), spark.createDataFrame(right, "id int, tokens array<string>")
    for t in (0.3, 0.5, 1.0):
        got = {(x["left_id"], x["right_id"]): x["jaccard"] for x in C.similar_values(ld, rd, t).collect()}
        want = {(i, j): len(set(a) & set(b)) / len(set(a) | set(b)) for i, a in left for j, b in right if a and b and len(set(a) & set(b)) / len(set(a) | set(b)) >= t - 1e-9}
        assert got == pytest.approx(want)


@pytest.mark.parametrize(("a", "b", "near"), [("mepema", "mepema", True), ("mepema", "mpeema", True), ("mepema", "mepma", True), ("mepema", "mepeema", True), ("mepema", "mepemo", True), ("mepema", "emepma", False), ("mepema", "epmema", False), ("a", "", True)])
def test_one_slip(spark, a, b, near):
    d = spark.createDataFrame([(a, b)], "a string, b string")
    assert one_slip_apart(a, b) == near == one_slip_apart(b, a)
    assert d.select(C.one_slip(F.col("a"), F.col("b")).alias("x")).first()["x"] == near


def test_localities_are_mapped(spark):
    cases = [("Mepema Nagar", "Velmora", None, 1), (" MEPEMANAGAR ", "velmora city", None, 1), ("Mepma Ngr.", "Velmoar", None, 1), ("Near Mepema-Nagar West", "NA", "210001", 1), ("Mepema Nagar S.O (Velmora)", None, "210002", 1), ("Kivure Pm, Velmora", "Velmora", None, 2), ("Rimelu Vihar", "Punwadi", "617002", 3), ("Rimelu Vihar", None, "617002", 4), ("Seretina Chowk", "Velmora", None, -1), ("-", "Velmora", None, -1), ("", "Velmora", None, -1), (None, "Velmora", "210001", 0), ("Mepema Wadi", "Velmora", None, -1)]
    rec = spark.createDataFrame([(i, "P", s, c, p, p, "clash") for i, (s, c, p, _) in enumerate(cases)], "rec_id bigint, projectname string, sublocation string, city string, pincode string, all_pincodes string, name string")
    loc = spark.createDataFrame(LOCALITIES, "locality_id bigint, locality string, city string, pincode string")
    got = {r["rec_id"]: r["locality_id"] for r in C.map_localities(rec, loc).collect()}
    assert got == {i: w for i, (*_, w) in enumerate(cases) if w != 0}
    assert C.map_localities(rec.limit(0), loc).count() == 0 and C.map_localities(rec, loc.limit(0)).where("locality_id <> -1").count() == 0
    assert C.unmatched_values(rec, C.map_localities(rec, loc)).count() == 4


@pytest.mark.parametrize(("address", "parts"), [
    ("FLAT NO 506 A WING ZENARA MUSALIDA APPT, MEPEMA NGR, VELMORA 210 001", {"door": "506", "wing": "A", "family": "B", "name": "MUSALIDA", "brand": "ZENARA", "ending": "APARTMENTS", "locality": "MEPEMA NAGAR", "city": "VELMORA", "pin": "210001"}),
    ("MEPMANAGAR VELMOAR A-506 ZENARAMUSALIDA NEAR TULIPA KIRIRUTA", {"door": "506", "wing": "A", "name": "MUSALIDA", "brand": "ZENARA", "locality": "MEPEMA NAGAR", "city": "VELMORA"}),
    ("S/O LATE OMVINESH VARDHAPPA D.NO 95/2 LUVUKI MIDA MN RD KIVURE PM 9876543210 NATIVE #4 OTHER PELU ROAD", {"door": "95/2", "wing": "", "family": "S", "name": "LUVUKIMIDA", "ending": "MAIN ROAD", "locality": "KIVURE PURAM", "city": "VELMORA"}),
    ("M/S LUMORA FOODS LLP 1105, B BLOCK QUILLON TUSE SEVE PH 2 METER NO 45454545", {"door": "1105", "wing": "B", "name": "TUSESEVE", "brand": "QUILLON", "phase": "2"}),
    ("", {"door": None, "name": None}), (None, {"door": None}), ("######", {"door": None}), ("x" * 5000, {"door": None}),
])
def test_parser(address, parts):
    got = take_apart(address, None, G)
    assert {k: got[k] for k in parts} == parts


def test_names_with_a_slip():
    n = Names({"VELMORA", "PUNWADI"})
    assert n.find("VELMROA") == "VELMORA" and n.find("XELMORX") is None and n.all("PUNWADI") == ["PUNWADI"]
    assert project_parts("  Zenara  Musalida Phase II ", G) == ("ZENARA", "MUSALIDA", "PHASE 2", "2") and project_parts(None, G)[1] is None


DOORS = [
    (1, "FLAT NO 506 A WING ZENARA MUSALIDA MEPEMA NAGAR VELMORA", None), (2, "A-506 ZENARA MUSALDA APTS, MEPEMA NGR", "210001"), (3, "F NO A/506 MUSALIDA VELMORA", None), (4, "B-506 ZENARA MUSALIDA MEPEMA NAGAR VELMORA", None),
    (5, "FLAT 506 ZENARA MUSALIDA MEPEMA NAGAR VELMORA", None), (6, "D.NO 7 LUVUKI MIDA ROAD MEPEMA NAGAR", None), (7, "#7 LUVUKI MIDA RD VELMORA", None), (8, "#7 LUVUKI MIDA LANE VELMORA", None), (9, "A-506 ZENARA MUSALIDA RIMELU VIHAR PUNWADI", None),
    (10, None, "210001"), (11, "", None), (12, "A-506 ZENARA MUSALIDA PHASE 1 MEPEMA NAGAR VELMORA", None), (13, "A-506 ZENARA MUSALIDA PHASE 2 MEPEMA NAGAR VELMORA", None), (14, "#7 LUVUKI MIDA RD VELMORA", "999"), (None, "#7 LUVUKI MIDA RD VELMORA", None), (14, "#7 LUVUKI MIDA RD VELMORA", "999"),
]


def lists(spark):
    loc = spark.createDataFrame(LOCALITIES, "locality_id bigint, locality string, city string, pincode string")
    cat = spark.createDataFrame([(1, "Zenara Musalida Apartments", "Velmora", "Mepema Nagar", "210001", "210001"), (2, "ZENARA MUSALDA", None, "Mepema Ngr", None, None), (3, "Zenara Musalida", "Punwadi", "Rimelu Vihar", "395002", "395002"), (4, "Quillon Tuseseve", "Velmora", "Kivure Puram", None, None), (5, None, None, None, None, None)], "rec_id bigint, projectname string, city string, sublocation string, pincode string, all_pincodes string")
    return loc, cat, gazetteer(loc, cat)


def test_same_doors(spark):
    _, _, g = lists(spark)
    d = spark.createDataFrame([(*x, "clash") for x in DOORS], "row_id bigint, address string, zip string, door string")
    got = {(r["row_id_a"], r["row_id_b"]) for r in same_doors(d, g).collect()}
    want = set(itertools.combinations((1, 2, 3), 2)) | set(itertools.combinations((6, 7, 14), 2)) | {(a, b) for a in (1, 3) for b in (12, 13)}  # 2 has another ending than both phases
    assert got == want
    assert same_doors(d.limit(0), g).count() == 0


def test_doors_with_missing_parts(spark):
    _, _, g = lists(spark)
    rows = [
        (1, "FLAT NO 506 A WING ZENARA MUSALIDA MEPEMA NAGAR VELMORA", None), (2, "FLAT 506 ZENARA MUSALIDA MEPEMA NAGAR VELMORA", None),  # the wing is missing, and only one wing has that flat
        (3, "FLAT NO 7 A WING ZENARA MUSALIDA VELMORA", None), (4, "FLAT NO 7 B WING ZENARA MUSALIDA VELMORA", None), (5, "FLAT 7 ZENARA MUSALIDA VELMORA", None),  # two wings have it: whose is open
        (6, "FLAT NO 91 KIVURE PURAM VELMORA", None), (7, "FLAT NO 91 QUILLON TUSESEVE KIVURE PURAM VELMORA", None),  # the name is missing, and only one building of the locality has that flat
        (8, "FLAT NO 92 KIVURE PURAM VELMORA", None), (9, "FLAT NO 92 QUILLON TUSESEVE KIVURE PURAM VELMORA", None), (10, "FLAT NO 92 TULIPA KIRIRUTA KIVURE PURAM VELMORA", None),
    ]
    d = spark.createDataFrame(rows, "row_id bigint, address string, zip string")
    assert {(r["row_id_a"], r["row_id_b"]) for r in same_doors(d, g).collect()} == {(1, 2), (6, 7)}
    members, links = door_links(d, g)
    assert members.count() == 10 and links.count() == 2


SHORT = Gazetteer([(1, "OM NAGAR", "PUNE", "411001"), (2, "KORAMANGALA", "GOA", "403001"), (3, "BANDRA WEST", "NAVI MUMBAI", "400703"), (4, "MEPEMA NAGAR", "VELMORA", "210001")], {"DLF", "ZENARA"})


@pytest.mark.parametrize(("address", "parts"), [
    ("FLAT 12 M WING DLF PARK PLACE, OM NAGAR, PUNE", {"wing": "M", "door": "12", "brand": "DLF", "name": "PARKPLACE", "locality": "OM NAGAR", "city": "PUNE"}),
    ("R-204 DLF SUN SHINE GREEN VALLEY HEIGHTS GOA", {"wing": "R", "door": "204", "brand": "DLF", "name": "SUNSHINEGREENVALLEY", "ending": "HEIGHTS", "city": "GOA"}),
    ("NO 5 OLD GREEN LAKE TEMPLE ROAD, KORAMANGALA", {"door": "5", "family": "S", "name": "OLDGREENLAKETEMPLE", "locality": "KORAMANGALA", "city": "GOA"}),
    ("NO 5 MG ROAD, KORAMANGLA, GOA", {"family": "S", "name": "MG", "locality": "KORAMANGALA"}),
    ("FLAT 9 ZENARA OM TOWERS, BANDRA WEST, NAVI MUMBAI", {"name": "OM", "brand": "ZENARA", "locality": "BANDRAWEST", "city": "NAVIMUMBAI"}),
    ("FLAT 9 DLFPARK, NAVIMUMBAI", {"name": "PARK", "brand": "DLF", "city": "NAVIMUMBAI"}),
    ("FLAT 9 ZENARA TUSE R OAD", {"family": "S", "ending": "ROAD"}),
    ("FLAT 9 ZENARA TUSESEVE UNLISTED NAGAR", {"family": "B", "name": "TUSESEVE"}),
])
def test_parser_has_no_letter_caps(address, parts):
    got = take_apart(address, None, SHORT)
    assert {k: got[k] for k in parts} == parts


def test_links(spark):
    loc, cat, g = lists(spark)
    rows = [(1, "FLAT NO 506 A WING ZENARA MUSALIDA MEPEMA NAGAR VELMORA", None), (2, "A-9 TULIPA KIRIRUTA NEAR ZENARA MUSALIDA MEPEMA NAGAR VELMORA", None), (3, "B-1 ZENARA MUSALIDA RIMELU VIHAR PUNWADI", None), (4, "C 12 MUSALIDA APTS VELMORA", None), (5, None, None), (6, "#7 LUVUKI MIDA RD VELMORA", None)]
    d = spark.createDataFrame([(*x, "clash") for x in rows], "row_id bigint, address string, zip string, name string")
    links = collective_links(d, cat, C.map_localities(cat, loc), g).collect()
    assert {(x["row_id"], x["rec_id"]) for x in links} == {(1, 1), (1, 2), (3, 3), (4, 1), (4, 2)}
    assert all(0.5 <= x["confidence"] <= 1 for x in links)
    assert collective_links(d.limit(0), cat, C.map_localities(cat, loc), g).count() == 0


def test_a_hot_project_makes_no_first_word(spark):
    loc = spark.createDataFrame(LOCALITIES, "locality_id bigint, locality string, city string, pincode string")
    hot = ["Zenara Musalida"] * 260 + ["ZenaraMusalida"] * 20 + ["ZenaraMusalida Heights"] * 20 + ["ZenaraMusalida Hts"] * 20
    names = hot + [f"{b} {x}" for b in ("Zenara", "Quillon", "Tulipa") for x in ("Tuseseve", "Kirimanu", "Nalodari")] + ["Lumora Heights"]
    cat = spark.createDataFrame([(i, n, "Velmora", "Mepema Nagar", "210001", "210001") for i, n in enumerate(names)], "rec_id bigint, projectname string, city string, sublocation string, pincode string, all_pincodes string")
    g = gazetteer(loc, cat)
    assert set(g.brands.names) == {"ZENARA", "QUILLON", "TULIPA"}
    assert project_parts("ZenaraMusalida Heights", g) == ("ZENARA", "MUSALIDA", "HEIGHTS", None)
    assert project_parts("Zenara Heights", g) == (None, "ZENARA", "HEIGHTS", None) and take_apart("A-9 ZENARA HEIGHTS VELMORA", None, g)["name"] == "ZENARA"
    rows = spark.createDataFrame([(1, "A-506 ZENARAMUSALIDA MEPEMA NAGAR VELMORA", None), (2, "FLAT NO 506 A WING ZENARA MUSALIDA VELMORA", None)], "row_id bigint, address string, zip string")
    assert same_doors(rows, g).count() == 1
    links = collective_links(rows, cat, C.map_localities(cat, loc), g).collect()
    assert {(x["row_id"], x["rec_id"]) for x in links} == {(r, i) for r in (1, 2) for i in range(len(hot))}
