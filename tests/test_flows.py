"""Files, builders, slots, reports, samples and streams on small fixtures."""

import json
import zipfile

from pyspark.sql import functions as F

from sthalam.operators import summaries as S
from sthalam.plans import builders as B
from sthalam.plans.parse import parse_addresses
from sthalam.plans.project_match import dimensions
from sthalam.plans.slots import fill_by_model, parse_two_slots
from sthalam.sources import files, xlsx
from sthalam.streaming import live


def write_sheet(path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda ref, v: f'<c r="{ref}" t="s"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{ref}"><v>{v}</v></c>'
    rows = f'<row>{cell("A1", 0)}{cell("B1", 1)}{cell("C1", 2)}</row><row>{cell("A2", 3)}{cell("C2", "560001.0")}</row><row></row>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Pincode" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><t>Address </t></si><si><t>City</t></si><si><t>Pin</t></si><si><t>12 MAIN ROAD</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{rows}</sheetData></worksheet>")


def test_xlsx(spark, tmp_path):
    write_sheet(tmp_path / "a.xlsx")
    xlsx.register(spark)
    d = spark.read.format("xlsx").option("path", str(tmp_path / "a.xlsx")).option("sheet", "Pincode").load()
    assert [tuple(r) for r in d.collect()] == [("12 MAIN ROAD", "", "560001")] and xlsx.column_named(d.columns, "ADDRESS") == "Address"


def test_files(spark, tmp_path):
    (tmp_path / "b.csv").write_text('ADDRESS,State code,ZIP\n" 1 MAIN RD ",ka,560001\n')
    assert tuple(files.read_bureau(spark, str(tmp_path / "b.csv")).first()) == ("1 MAIN RD", "KA", "560001")
    folder = tmp_path / "imp"
    folder.mkdir()
    text = "Name\tAddress1\tAddress2\nA\tX 1\n\nB\tY\tZ\n"
    (folder / "1.xls").write_bytes(text.encode("utf-16"))
    (folder / "2.csv").write_text(text)
    (folder / "3.xlsx").write_bytes(b"\xfe\xff" + text.encode("utf-16-be"))
    got = files.read_folder(spark, str(folder)).groupBy("source_file").agg(F.sort_array(F.collect_list("Address1")).alias("a")).collect()
    assert sorted((r["source_file"], r["a"]) for r in got) == [(f, ["X 1", "Y"]) for f in ("1.xls", "2.csv", "3.xlsx")]
    (tmp_path / "p.json").write_text(json.dumps({"560001": {"latitude": 12.9, "longitude": 77.6, "district": "D", "offices": ["O"]}, "1": {"latitude": 0, "longitude": 0}}))
    assert {(r["pin"], r["latitude"]) for r in files.read_pin_points(spark, str(tmp_path / "p.json")).collect()} == {("560001", 12.9), ("1", None)}
    (tmp_path / "g.json").write_text(json.dumps({"q": [{"lat": "1.5", "lon": "2", "name": "N", "addresstype": "suburb", "address": {"postcode": "560001"}}]}))
    assert files.read_geocodes(spark, str(tmp_path / "g.json")).first()["postcode"] == "560001"
    d = spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    out = files.write_csv(d, str(tmp_path / "o"), limit=1, order="k")
    assert out.endswith("_limit1") and spark.read.option("header", True).csv(out).count() == 1
    files.replace_with_backup(d, str(tmp_path / "o_limit1"))
    assert spark.read.option("header", True).csv(str(tmp_path / "o_limit1")).count() == 2
    assert [(r["k"], r["row_id"]) for r in files.numbered(d, "k").orderBy("k").collect()] == [(1, 1), (2, 2)]
    places = spark.createDataFrame([("Bangalore", "building", "0.9", "Sky Tower", None, None, "L One", None, None), ("Bangalore", "road", "0.9", "Big Name", None, None, None, None, None), ("Bangalore", "tower", "bad", "Low Sure", None, None, None, None, None)], "city string, entity_type string, confidence string, name string, society_name string, building_name string, locality string, sub_locality string, neighbourhood string")
    assert [r["name"] for r in files.map_buildings(places, "bangalore").collect()] == ["SKY TOWER"] and files.map_localities(places, "bangalore").count() == 1


def dims(spark):
    cat = spark.createDataFrame([(1, "Prestige Shantiniketan", "Bangalore", "Whitefield", "560066", "560066", "high"), (2, "Other Long Name", "Bangalore", "Hebbal", "560024", "560024", "high")], "rec_id bigint, projectname string, city string, sublocation string, pincode string, all_pincodes string, pincode_confidence string")
    loc = spark.createDataFrame([("560066", "Whitefield", "Bangalore", "both"), ("560024", "Hebbal", "Bangalore", "both")], "pincode string, locality string, city string, source string")
    return cat, loc, dimensions(cat, loc)


def test_parse_slots_and_model(spark):
    _, loc, d = dims(spark)
    rows = spark.createDataFrame([(1, "FLAT 1 PRESTIGE SHANTINIKETAN WHITEFIELD NEAR LAKE", "KA", "560066"), (2, None, None, None), (3, "", "", "")], "row_id bigint, address string, state_code string, zip string")
    got = {r["row_id"]: r for r in parse_addresses(rows, d).collect()}
    assert got[1]["dotcom_match_rule"] == "project_locality_pincode" and got[1]["locality"] == "Whitefield" and got[1]["locality_source"] == "dotcom_match" and got[1]["confidence"] > 0.8
    assert got[2]["dotcom_matched"] == "No" and got[2]["confidence"] == 0.0 and got[3]["building_name"] is None
    two = spark.createDataFrame([(1, "FLAT 1 PRESTIGE SHANTINIKETAN WHITEFIELD 560066", "Building: Sky Palace, Hebbal 560024")], "row_id bigint, Address1 string, Address2 string")
    r = parse_two_slots(two, d).first()
    assert r["dotcom_matched_1"] == "Yes" and r["building_name_2"] == "Sky Palace" and r["locality_2"] == "Hebbal"
    model = lambda: lambda texts: [[{"score": 0.9, "entity_group": "LOCALITY", "word": "Whitefield"}, {"score": 0.1, "entity_group": "BUILDING", "word": "Low"}] for _ in texts]
    known = loc.select(F.upper("locality").alias("name"))
    f = fill_by_model(parse_addresses(rows, d), model, known).where("row_id = 2").first()
    assert f["locality"] == "Whitefield" and f["locality_source"] == "ner" and f["building_name"] is None
    assert "rows: 3" in B.run_report(parse_addresses(rows, d), 2.0)


def test_builders(spark):
    sheet = spark.createDataFrame([("560066", "Whitefield"), ("bad", "X")], "pincode string, locality string")
    posts = spark.createDataFrame([("560066", "Whitefield S.O"), ("560024", "Hebbal B.O")], "pincode string, locality string")
    assert [tuple(r) for r in B.merge_localities(sheet, posts).collect()] == [("560024", "Hebbal", "post_list"), ("560066", "Whitefield", "both")]
    cat, _, _ = dims(spark)
    more = spark.createDataFrame([(3, "A", "Bangalore", "Kadugodi", None, None, ""), (4, "B", "Dubai", "Marina", None, None, ""), (5, "C", "Bangalore", "Hebbaal", None, None, ""), (6, "D", "Bangalore", "Nowhere Place", "560024", None, "")], cat.schema)
    points = spark.createDataFrame([("560066", 12.97, 77.75, ["Whitefield S.O"]), ("560024", 13.03, 77.59, ["Hebbal B.O"]), ("560067", 12.99, 77.76, ["Other"])], "pin string, latitude double, longitude double, offices array<string>")
    learned = spark.createDataFrame([("bangalore", "KADUGODI", "560067", 5)], "city_key string, sub string, pin string, n int").drop("city_key")
    got = {r["sub"]: (r["pincode"], r["pincode_source"], r["pincode_confidence"]) for r in B.catalogue_pins(cat.unionByName(more), points, learned).collect()}
    assert got["WHITEFIELD"] == ("560066", "office_exact", "high") and got["KADUGODI"] == ("560067", "combo_learned", "high") and got["MARINA"][1] == "no_postal_code"
    assert got["HEBBAAL"][1] == "office_fuzzy" and got["NOWHERE PLACE"] == ("560024", "city_default", "very_low")


def test_samples_and_reports(spark):
    d = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(300)] + [(999, None)], "k int, s string")
    assert {r["s"]: r["count"] for r in S.per_stratum(d, "s", "k", 20, "x").groupBy("s").count().collect()} == {"a": 20, "b": 20, None: 1}
    assert S.fill_report(d.limit(0), ["s"]).first()["share"] == 0.0


def test_streams(spark, tmp_path):
    _, _, d = dims(spark)
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "FLAT 1 PRESTIGE SHANTINIKETAN WHITEFIELD", "KA", "560066")], "row_id bigint, address string, state_code string, zip string").write.parquet(src)
    stream = spark.readStream.schema("row_id bigint, address string, state_code string, zip string").parquet(src)
    live.match_stream(stream, d, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).first()["dotcom_matched"] == "Yes"
    assert live.clean_stream(stream).isStreaming
    ev = str(tmp_path / "ev")
    spark.sql("SELECT TIMESTAMP'2024-01-01 00:10:00' AS ts, 'a' AS event_type UNION ALL SELECT TIMESTAMP'2024-01-01 00:20:00', 'a'").write.parquet(ev)
    q = live.running_counts(spark.readStream.schema("ts timestamp, event_type string").parquet(ev)).writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").first()["n"] == 2


def test_a_written_table_is_sent_by_the_size_of_its_rows(spark):
    from pyspark.sql import functions as F

    from sthalam import session as S

    settings = lambda: [spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")]
    plan = lambda d: d._jdf.queryExecution().sparkPlan().toString()
    large, small = (S.cut_lineage(spark.range(n).select("id", F.concat(F.lit("the same long words "), F.col("id") % 7).alias("x"))) for n in (600_000, 100))
    joined = lambda right: large.select("id").join(right, "id")
    before = settings()
    assert "BroadcastHashJoin" in plan(joined(large))  # some 70 MB of rows in files of less than 10 MB
    with S.sent_by_rows(spark):
        assert "BroadcastHashJoin" not in plan(joined(large)) and "BroadcastHashJoin" in plan(joined(small))
    assert settings() == before
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    with S.sent_by_rows(spark):
        assert "BroadcastHashJoin" not in plan(joined(small))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
