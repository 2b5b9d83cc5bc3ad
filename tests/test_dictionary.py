"""Dictionary lookups against brute force, spelling repair, states, titles and two-address labels on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from sthalam.functions import extract as X
from sthalam.functions import text as T
from sthalam.operators import dictionary as D
from sthalam.operators import matching as M
from sthalam.plans import builders as B
from sthalam.plans.slots import rescored, slot_stats, with_label

NAMES = ["ROSE VALLEY HEIGHTS", "ROSE GARDEN COURT", "LOTUS POND", "LOTUS", "SKY"]


def test_fuzzy_names_are_exact(spark):
    r = random.Random(4)
    texts = [(i, " ".join(r.choice(["ROSE", "VALLY", "VALLEY", "HEIGHTS", "HIGHTS", "LOTUS", "POND", "GARDEN", "COURT", "X"]) for _ in range(r.randrange(0, 8)))) for i in range(60)] + [(99, None)]
    n, t = spark.createDataFrame([(x,) for x in NAMES], "name string"), spark.createDataFrame(texts, "id int, text string")
    for cutoff, chars, shared in ((88.0, 6, 0), (90.0, 8, 4)):
        got = {x["id"]: round(x["score"], 6) for x in D.fuzzy_names(t, n, cutoff=cutoff, chars=chars, shared_word=shared).collect()}
        want = {}
        for i, x in texts:
            w, best = (x or "").split(), 0.0
            for a in range(len(w)):
                for b in range(a + 2, min(a + 8, len(w)) + 1):
                    run = " ".join(w[a:b])
                    for name in NAMES:
                        if len(run) >= chars and name.split()[0] == w[a] and (not shared or {y for y in w[a:b] if len(y) >= shared} & {y for y in name.split() if len(y) >= shared}):
                            best = max(best, M.token_set_ratio(run, name))
            if best >= cutoff:
                want[i] = round(best, 6)
        assert got == want and want
    assert D.fuzzy_names(t.limit(0), n).count() == 0 and D.fuzzy_names(t, n.limit(0)).count() == 0


@pytest.mark.parametrize("cutoff", [75.0, 88.0])
def test_token_set_pairs_lose_none_and_leave_most_out(spark, cutoff):
    r = random.Random(int(cutoff))
    word = lambda n: "".join(r.choice("KLMNPRSTV") + r.choice("AEIU") for _ in range(n))
    slip = lambda w: w[: (k := r.randrange(len(w)))] + r.choice(["", "A", w[k] * 2]) + w[k + 1 :]
    brands = ["HAVENOR", "BRINDALE", "LO"]
    names = {b if k % 40 == 0 else f"{b} {word(r.choice([2, 4, 6]))}" + r.choice(["", "", " ENCLAVE", " PHASE I", " PHASE 2", f" {b}"]) for k in range(300) for b in brands}
    runs = set(brands)
    for n in sorted(names):
        w = n.split()
        runs |= {n, " ".join([w[0], *map(slip, w[1:])]), " ".join([*w, word(1), word(3)]), " ".join([w[0], *w[:0:-1]]), " ".join(w[:2])}
    both = lambda xs, c: spark.createDataFrame(sorted((x.split()[0], x) for x in xs), f"brand string, {c} string")
    got = {(x["a"], x["b"]) for x in D.token_set_pairs(both(runs, "a"), both(names, "b"), ["brand"], cutoff).collect()}
    every = [(a, b) for a in runs for b in names if a.split()[0] == b.split()[0]]
    assert {p for p in every if M.token_set_ratio(*p) >= cutoff} <= got <= set(every) and len(got) < len(every) / (2 if cutoff < 80 else 4)


def test_known_names_by_the_first_way(spark):
    t = spark.createDataFrame([(1, "12 ROSE VALLEY HEIGHTS PUNE"), (2, "LOTUS NO 9 LOTUSPOND"), (3, "ROSE VALLEY HIGHTS"), (4, "NOTHING HERE"), (5, "ROSEVALLEYHEIGHTS OF ROSE")], "id int, text string")
    n = spark.createDataFrame([(x,) for x in [*NAMES, "LOTUS POND TOWERS"]], "name string")
    got = {x["id"]: (x["name"], x["how"]) for x in D.known_names(t, n).collect()}
    assert got[1] == ("ROSE VALLEY HEIGHTS", "exact") and got[5] == ("ROSE VALLEY HEIGHTS", "exact") and got[3] == ("ROSE VALLEY HEIGHTS", "fuzzy") and 4 not in got
    b = {x["id"]: (x["name"], x["how"]) for x in D.known_buildings(t, n).collect()}
    assert b[1][1] == "exact" and b[2] == ("LOTUS", "exact") and b[5][1] == "glued" and 4 not in b


def test_places(spark):
    t = spark.createDataFrame([(1, "A", "1", "NEAR K R PURAM MAIN"), (2, "A", "2", "KRPURAM EXTENSIONS ELECTRONICCITY"), (3, "B", "1", "K R PURAM")], "id int, city_key string, pin string, text string")
    p = spark.createDataFrame([("A", "K R PURAM"), ("A", "PURAM"), ("A", "ELECTRONIC CITY")], "city_key string, name string")
    known = spark.createDataFrame([("1", "K R PURAM")], "pin string, name string")
    assert {tuple(x) for x in D.written_places(t, p, scope=("city_key",)).collect()} == {(1, "K R PURAM"), (1, "PURAM"), (2, "ELECTRONIC CITY")}
    assert {tuple(x) for x in D.best_place(t, p, known, scope=("city_key",)).collect()} == {(1, "K R PURAM"), (2, "ELECTRONIC CITY")}
    v = spark.createDataFrame([("A", "ELECTRONIC CTY"), ("A", "PURAM"), ("A", "PURM"), ("A", None)], "city_key string, value string")
    assert {(x["value"], x["name"]) for x in D.respelt(v, p).collect()} == {("PURAM", "PURAM"), ("ELECTRONIC CTY", "ELECTRONIC CITY")}
    q = spark.createDataFrame([(1, "1", ["KR PURAM", "X"]), (2, "9", ["KR PURAM"])], "id int, pin string, phrases array<string>")
    assert [(x["id"], x["name"]) for x in D.near_places(q, known).collect()] == [(1, "K R PURAM")]
    area = spark.createDataFrame([(1, "AT GREEN LAKE PARK", None), (2, "AT GREEN LAKE PARK", "GREEN LAKE PARK"), (3, "GREEN LAKE", None)], "id int, text string, locality string")
    places = spark.createDataFrame([("GREEN LAKE PARK",), ("GREEN LAKE",), ("MAIN ROAD AREA",)], "name string")
    assert {tuple(x) for x in D.named_area(area, places, D.common_localities(places)).collect()} == {(1, "GREEN LAKE PARK")}


def test_scoped_else_global(spark):
    names = spark.createDataFrame([("A", "X", "xa"), ("B", "X", "xb"), ("B", "Y", "yb"), (None, "Z", "z")], "k string, n string, v string")
    rows = spark.createDataFrame([(1, "A", "X"), (2, "A", "Y"), (3, "C", "Y"), (4, None, "Z"), (5, "B", None)], "id int, k string, n string")
    got = {x["id"]: x["c"] for x in D.scoped_else_global(rows, names, scope="k", key="n", value="v", out="c").collect()}
    assert got == {1: "xa", 2: None, 3: "yb", 4: "z", 5: None}


def test_spelling_repair(spark):
    known = frozenset(["NAGAR", "RAJ", "RAJAJI", "APARTMENT", "GREEN", "VALLEY", "HEIGHTS", "PURAM"])
    assert M.joined_words("12 N AGAR MAIN".split(), known) == ["12", "NAGAR", "MAIN"] and M.joined_words("PURA M X".split(), known) == ["PURAM", "X"]
    assert M.joined_words([], known) == [] and M.joined_words(["NA", "GAR"], known) == ["NAGAR"]
    assert M.cut_run("GREENVALLEYHEIGHTS", known) == ["GREEN", "VALLEY", "HEIGHTS"] and M.cut_run("GREENVALLEY", known) == ["GREENVALLEY"]
    assert M.cut_run("XXGREENVALLEYZZZ", known) == ["XXGREEN", "VALLEYZZZ"] and M.cut_run("A" * 20, known) == ["A" * 20]
    d = spark.createDataFrame([("N AGAR greenvalleyheights",), (None,), ("",)], "t string")
    assert [r["repaired"] for r in M.spelling_repair(d, "t", set(known)).collect()] == ["NAGAR GREEN VALLEY HEIGHTS", None, ""]
    words = M.vocabulary(spark.createDataFrame([("ROSE VALLEYS 12",), (None,)], "name string"), spark.createDataFrame([("K R PURAM",)], "name string"))
    assert {"VALLEYS", "KRPURAM", "PURAM", "NAGAR"} <= M.collected_vocabulary(words) and "ROSE" not in M.collected_vocabulary(words)


@pytest.mark.parametrize(("own", "known", "want"), [("ka", "KA", 1), ("CG", "CT", 1), ("MH", "KA", -1), (None, "KA", 0), ("??", "KA", 0), ("KA", None, None), (None, None, None)])
def test_state_evidence(spark, own, known, want):
    d = spark.createDataFrame([(own, known)], "a string, b string")
    assert d.select(T.state_evidence(F.col("a"), F.col("b"))).first()[0] == want


def test_words_of_places_and_buildings(spark):
    d = spark.createDataFrame([(1,)], "id int")
    one = lambda c: d.select(c.alias("x")).first()["x"]
    say = F.lit
    assert one(T.title_building(say("McDONALD house VILLA"))) == "McDONALD House Villa" and one(T.title_locality(say("indira NAGAR"))) == "Indira NAGAR"
    assert one(T.precise_locality(say("NO 654 B BLOCK SUBASH NAGAR"), say(None).cast("string"))) == "Subash Nagar" and one(T.precise_locality(say("2 3 OBALAPPA CROSS"), say("X"))) is None
    assert one(T.precise_locality(say("GARUDACHAR PALYA SHETTY LAYOUT"), say(None).cast("string"))) == "Garudachar Palya" and one(T.precise_locality(say("SUN MEADOW LAYOUT"), say("Sun"))) == "Meadow Layout"
    assert one(T.trim_landmark(say("GREEN PARK NEAR PUNE INDIA"), say("pune"), say(None).cast("string"))) == "GREEN PARK NEAR" and one(T.trim_landmark(say(""), say("x"), say("y"))) is None
    assert one(T.locality_phrases(say("A B, INDIRA NAGAR; X"))) == ["INDIRA NAGAR", "A B, INDIRA NAGAR;", "B, INDIRA NAGAR; X", "A B, INDIRA", "INDIRA NAGAR; X"]
    n = say("FLAT NO 12 SUN SHINE VALLEY HEIGHTS 2ND FLOOR GREEN GLEN LAYOUT")
    none = say(None).cast("string")
    assert one(X.after_unit(n)) == "SUN SHINE VALLEY HEIGHTS" == one(X.before_floor(n, none)) and one(X.single_area(n)) == "GLEN LAYOUT" and one(X.enclave(n, none)) is None
    assert one(X.sanitised_building(say("Sun Valley Heights"), n)) == "SUN VALLEY HEIGHTS" and one(X.locality_like(say("Indira Nagar"), say("INDIRA NAGAR"), say(False)))


def test_labels_and_scores(spark):
    cols = "row_id int, address string, zip string, state_code string, building_name string, dotcom_matched string, dotcom_match_rule string, location_matched string, locality string, locality_source string, city string, building_number string, landmark string, confidence double"
    rows = [(1, "12 X; Building: ROSE COURT", "560001", "KA", "Sky Tower", "Yes", "project_locality", "No", None, None, "Pune", None, None, 0.9), (2, "12 X", "560001", "MH", "Sky Tower", "Yes", "project_locality", "No", None, None, "Pune", None, None, 0.9), (3, "Society - SKY", None, None, "Sky", "Yes", "project_pincode", "No", None, None, None, None, None, 0.1)]
    p = with_label(spark.createDataFrame(rows, cols), spark.createDataFrame([("ROSE COURT",)], "name string"))
    got = {r["row_id"]: r for r in p.collect()}
    assert got[1]["building_name"] == "Rose Court" and got[1]["dotcom_matched"] == "No" and got[1]["location_matched"] == "Yes" and not got[2]["relabelled"] and got[3]["dotcom_matched"] == "Yes"
    pin_city = spark.createDataFrame([("560001", "pune")], "pin string, pin_city string")
    states = spark.createDataFrame([("560001", "KA")], "pin string, state string")
    s = {r["row_id"]: r["confidence"] for r in rescored(p, pin_city, states).collect()}
    assert s[1] == pytest.approx(0.18 + 0.07 + 0.15 + 0.10 + 0.22 + 0.12) and s[2] == pytest.approx(0.18 + 0.07 - 0.12 + 0.10 + 0.22 + 0.16)
    wide = spark.createDataFrame([("A", "Yes", "No", 0.5, None, "No", "Yes", None), (None, None, None, None, " ", "No", "No", 0.1)], "building_name_1 string, dotcom_matched_1 string, location_matched_1 string, confidence_1 double, building_name_2 string, dotcom_matched_2 string, location_matched_2 string, confidence_2 double")
    assert {tuple(r) for r in slot_stats(wide).collect()} == {("1", 2, 1, 1, 1, 0), ("2", 2, 1, 0, 0, 1), ("either", 2, 2, 1, 1, 1)}


def test_reviews(spark):
    d = spark.createDataFrame([(i, f"A{i}", "1", "B", "L", "C", " R1 " if i % 2 else "r2", "Yes" if i % 3 else "No") for i in range(30)], "row_id int, address string, zip string, building_name string, locality string, city string, dotcom_match_rule string, dotcom_matched string")
    s = B.review_sample(d, 3)
    assert s.columns == B.REVIEW and s.groupBy("dotcom_match_rule").count().orderBy("dotcom_match_rule").collect() == [("r1", 3), ("r2", 3)]
    assert B.reviewed(s.withColumn("verdict", F.lit(" WRONG "))).count() == 6 and B.reviewed(s).count() == 0


def test_respelt_values_are_not_compared_with_every_place_of_their_city(spark, monkeypatch):
    monkeypatch.setattr(M, "fuzzy_pairs", lambda *x, **k: pytest.fail("all pairs of a city are compared"))
    v = spark.createDataFrame([("v", "KIMALO NAGARR"), ("v", "KIMALO NAGAR"), ("v", "KI MALO NAGAR"), ("v", "DUBENI"), ("w", "KIMALO NAGARR"), ("v", None)], "city_key string, value string")
    p = spark.createDataFrame([("v", "KIMALO NAGAR"), ("v", "KIMALU NAGAR"), ("v", "DUBENA")], "city_key string, name string")
    got = {tuple(x) for x in D.respelt(v, p).collect()}
    assert got == {("v", "KIMALO NAGAR", "KIMALO NAGAR"), ("v", "KIMALO NAGARR", "KIMALO NAGAR"), ("v", "KI MALO NAGAR", "KIMALO NAGAR")}


def test_building_by_ending_matches_as_if_tried_at_every_letter(spark):
    import re

    from sthalam.functions import words as W

    texts = ["A B C D E F G TOWERS", "KIMALO TOWERS NEAR LAKE VILLA X", "TOWERS", "A TOWERSX", "NO 4 A1B HEIGHTS HEIGHTS", "A B C D E TOWER F G H I J K VILLA Q", ""]
    want = [(m[1] if (m := re.search(rf"((?:[A-Z0-9]+ ){{1,5}}(?:{W.BUILDING_SUFFIX}))(?: |$)", x)) else None) for x in texts]
    d = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    assert [r[1] for r in d.select("i", T.building_by_ending(F.col("x"))).orderBy("i").collect()] == want
