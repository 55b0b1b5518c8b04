import gzip
import json

import pytest
from pyspark.sql import functions as F

from ohmbridge import schemas
from ohmbridge.operators import assemble, extract
from ohmbridge.plans import pipeline
from ohmbridge.sources import files, sinks, synthetic

AT = "2024-06-01T00:00:00+00:00"

PLAIN = "﻿start_date;station_name;charging_time_hh_mm_ss;energy_kwh;address_1;address_2;city;state_province;zip_postal_code\r\n" \
    "2023-01-02T10:00:00-05:00;Town Hall;01:10:00;7.5;1 Main St; ;Cary;NC;27511\r\n\r\n" \
    "start_date;station_name;charging_time_hh_mm_ss;energy_kwh;address_1;address_2;city;state_province;zip_postal_code\r\n" \
    "2023-01-03T10:00:00-05:00;\"Hall; East\";00:30:00;;;;Cary;NC;27511\r\n"
SHORT = "a_id,b_name,c_kw,d_x\n1,two,3,4\n1,two,3\n1,two,3,4,5,\"6,7\"\n"
BOXES = 'Date,Station Name,Location Name,Charge Box ID,Connector ID,Driver ID,Connected Time,Disconnected Time,Charge Duration (min),Connected Duration (min),Energy Provided (kWh),Session Status,Invalidity Reason\n' \
    '"10/14/2022","17","Court Square","EVB-1","1","D1","13:18:21.0000000","14:18:21.0000000","60","61","12.5","VALID","NULL"\n' \
    '"10/14/2022","17","Court Square","EVB-1","1","D2","15:00:00.0000000","15:30:00.0000000","30","31","0","INVALID","too short"\n' \
    '"10/15/2022","18","Bay Garage","EVB-2","","","23:30:00.0000000","00:30:00.0000000","60","61","3.25","VALID","NULL"\n'
UNITS = json.dumps([{"network": "N", "charging_level": "2", "connectors": {"J1772": {"power_kw": 6.6, "port_count": 2}, "CCS": {"power_kw": 50, "port_count": 0}}}])
GEO = {"type": "FeatureCollection", "features": [
    {"type": "Feature", "geometry": {"type": "Point", "coordinates": [-78.78, 35.79]}, "properties": {"id": 7, "station_name": "Town Hall", "street_address": "1 Main St", "city": "Cary", "state": "NC", "zip": "27511", "status_code": "E", "open_date": 1287100800000, "ev_network": "Net", "ev_charging_units": UNITS}},
    {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": []}, "properties": {"id": 8, "station_name": "Bare", "ev_connector_types": ["J1772"], "ev_network": "Net", "ev_charging_units": "not json"}},
]}
DIGEST = "WEEKLY FAULT DIGEST\nperiod ending: 03.04.2024\nCourt Square :: breaker trip :: count=4 :: sev=major\n\nBay Garage :: display flicker\nNOTE check the garage\nrouted to: north crew\n"
MAIL = "From: crew\nSent: 01.02.2023\nStation: Town Hall\nSeverity: urgent-safety\nThe cable insulation cracked. rated 7.2 kW\n"
FORM = "Quarterly Inspection Form\ninsp.date : 2/3/2024\nsite/station....... Bay Garage\nseverity code [minor]\ntechnician : Ann\n"


@pytest.fixture()
def raw(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "a_sessions.csv").write_text(PLAIN, encoding="utf-8", newline="")
    (d / "b_short.csv").write_text(SHORT)
    (d / "c_boxes.csv.gz").write_bytes(gzip.compress(BOXES.encode()))
    (d / "d_registry.geojson").write_text(json.dumps(GEO))
    (d / "e_fault.txt").write_text(DIGEST)
    (d / "f_email.txt").write_text(MAIL)
    (d / "g_inspection.txt").write_text(FORM)
    (d / ".hidden").write_text("x")
    (d / "sub").mkdir()
    return str(d)


def by_name(spark, raw):
    return {f.name: f for f in files.detect(spark, raw)}


def test_detection(spark, raw):
    found = by_name(spark, raw)
    assert list(found) == sorted(found) and ".hidden" not in found and "sub" not in found
    assert {n: f.kind for n, f in found.items()} == {"a_sessions.csv": "csv", "b_short.csv": "csv", "c_boxes.csv.gz": "csv", "d_registry.geojson": "geojson", "e_fault.txt": "text", "f_email.txt": "text", "g_inspection.txt": "text"}
    assert found["a_sessions.csv"].delimiter == ";" and found["c_boxes.csv.gz"].gzipped
    with pytest.raises(ValueError):
        files.kind_of("x.parquet", "")
    assert files.kind_of("dump.json", '{"type": "FeatureCollection"}') == "geojson" and files.kind_of("notes", "plain") == "text" and files.kind_of("t", "a;b") == "csv"
    assert files.delimiter_of("plain") == ";" and files.delimiter_of("a\tb\tc,d") == "\t"
    assert files.is_header(["Date", "Charge Duration (min)"]) and not files.is_header(["1", "x y"]) and not files.is_header(["only"])


def test_delimited(spark, raw):
    found = by_name(spark, raw)
    a = files.read_delimited(spark, found["a_sessions.csv"]).orderBy("n").collect()
    assert [r.n for r in a] == [1, 2] and a[0].address_2 == " " and a[1].station_name == "Hall; East" and a[1].energy_kwh is None
    b = files.read_delimited(spark, found["b_short.csv"]).orderBy("n").collect()
    assert [r.issues for r in b] == [[], ["malformed_row"], ["unmapped_columns"]] and b[2].extra_columns == ["5", "6,7"] and b[1].d_x is None


def test_misnamed_gzip(spark, tmp_path):
    (tmp_path / "rows.csv").write_bytes(gzip.compress(SHORT.encode()))
    f = files.detect(spark, str(tmp_path))[0]
    assert f.gzipped and files.read_delimited(spark, f).count() == 3


def test_no_header(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("1,2,3\n4,5,6\n")
    f = files.detect(spark, str(tmp_path))[0]
    assert f.header == ["col_1", "col_2", "col_3"] and files.read_delimited(spark, f).count() == 2


def test_records(spark, raw):
    got = pipeline.ingest(spark, raw, AT)
    s = {r.session_id: r for r in got["session"].collect()}
    assert len(s) == 2 + 3 + 3
    box = [r for r in s.values() if r.station_id == "EVB-1"]
    assert {r.charger_id for r in box} == {"EVB-1:1"} and box[0].start_time.startswith("10/14/2022 1") and all(r.end_time is None for r in box)
    assert {r.charger_id for r in s.values() if r.station_id == "EVB-2"} == {"EVB-2"} and {r.invalidity_reason for r in box} == {"NULL", "too short"}
    c = got["charger"].collect()
    ports = {r.charger_id for r in c if r.provenance.source == "afdc"}
    assert ports == {"7#0#J1772#0", "7#0#J1772#1", None}
    port = next(r for r in c if r.charger_id == "7#0#J1772#0")
    assert (port.lat, port.lon, port.power_kw, port.network, port.install_date) == ("35.79", "-78.78", "6.6", "N", "1287100800000")
    assert {r.charger_id for r in c if r.provenance.source == "nyc_dot"} == {"EVB-1:1", "EVB-2"}
    short = [r for r in s.values() if r.provenance.source_file == "b_short.csv"]
    assert sorted(r.quality.score for r in short) == [0.7, 0.7, 1.0]


def test_reports(spark, raw):
    e = {r.event_id: r for r in pipeline.ingest(spark, raw, AT)["maintenance"].collect()}
    digest = sorted((r for r in e.values() if r.provenance.source_file == "e_fault.txt"), key=lambda r: r.station_name, reverse=True)
    assert [(r.station_name, r.severity, r.event_date) for r in digest] == [("Court Square", "MAJOR", "03.04.2024"), ("Bay Garage", "MAJOR", "03.04.2024")]
    assert digest[0].extracted_fields["count"] == "4" and digest[0].extracted_fields["routed_to"] == "north crew" and digest[0].extracted_fields["notes"] == "check the garage"
    mail = next(r for r in e.values() if r.provenance.source_file == "f_email.txt")
    assert (mail.event_type, mail.severity, mail.station_name, mail.event_date, mail.extracted_fields["power_rating"], mail.quality.score) == ("REPAIR", "SAFETY", "Town Hall", "01.02.2023", "7.2 kW", 0.9)
    form = next(r for r in e.values() if r.provenance.source_file == "g_inspection.txt")
    assert (form.event_type, form.severity, form.event_date, form.station_name, form.quality.score) == ("INSPECTION", "MINOR", "2/3/2024", "Bay Garage", 0.95)


def test_jsonl_sink_and_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, None, (None, None)), (2, "x", ("y", None))], "a int, b string, c struct<d:string,e:string>")
    out = str(tmp_path / "out")
    sinks.write_jsonl([(df, ["a"]), (df, ["a"])], out, limit=3)
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(lines, key=str) == sorted([{"a": 1}, {"a": 2, "b": "x", "c": {"d": "y"}}, {"a": 1}], key=str)
    assert files.read_jsonl(spark, out, df.schema).count() == 3
    sinks.write_jsonl([(df, ["a"])], out, limit=0)
    assert spark.read.text(out).count() == 0
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\nnot json\n')
    with pytest.raises(Exception, match="not a JSON object"):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), df.schema).collect()


def test_unknown_text_gives_one_event(spark):
    got = extract.events(spark.createDataFrame([("x.txt", "nothing to see"), ("y_install.txt", ""), ("z.txt", None)], "file string, text string")).orderBy("file").collect()
    assert [(r.event_type, r.severity, r.confidence) for r in got] == [("OTHER", None, 0.5), ("INSTALL", None, 0.5), ("OTHER", None, 0.5)]
    assert assemble.REPORT_SOURCE == "contractor"


def test_311_in_a_place_or_a_number_is_no_complaint(spark):
    said = {"a": "station: Yard 311\nbreaker trip", "b": "breaker trip on unit 13110", "c": "routed from 311\nbreaker trip", "d": "station: Yard 5\nvia 311, breaker trip", "e": "site/station.... Lot 311\novertemp"}
    found = extract.events(spark.createDataFrame(list(said.items()), "file string, text string"))
    assert {r.file: r.event_type for r in found.collect()} == {"a": "FAULT", "b": "FAULT", "c": "COMPLAINT", "d": "COMPLAINT", "e": "FAULT"}


def test_outside_parser_falls_back(spark):
    def parse(said, file):
        if "bad" in file:
            raise RuntimeError
        return [{"description": said, "event_type": "REPAIR", "severity": "odd", "extracted_fields": {"n": 1}}]

    df = spark.createDataFrame([("good.txt", "latch broken"), ("bad.txt", "urgent fault")], "file string, text string")
    got = {r.provenance.source_file: r for r in assemble.maintenance(extract.events_by(df, parse), AT).collect()}
    assert (got["good.txt"].event_type, got["good.txt"].severity, got["good.txt"].extracted_fields, got["good.txt"].quality.issues) == ("REPAIR", None, {"n": "1"}, [])
    assert (got["bad.txt"].event_type, got["bad.txt"].severity, got["bad.txt"].quality.issues) == ("FAULT", "SAFETY", ["llm_fallback"])


def by_csv(text, delimiter=","):
    import csv
    import io

    rows = [r for r in csv.reader(io.StringIO(text), delimiter=delimiter) if any(c.strip() for c in r)]
    return rows[1:]


@pytest.mark.parametrize("small", [False, True])
def test_quoted_line_breaks(spark, tmp_path, small):
    """Against the standard reader, in one block and in blocks of a few bytes each."""
    import random

    rng = random.Random(4)
    cell = lambda: rng.choice(["x", "", "a b", '"two\nlines"', '"a,b"', '"say ""hi"" now"', '"\n\n"', '5 "inch', '"one, ""two""\nthree\nfour"', "é"])
    texts = ["one,two,three\n" + "".join(",".join([f"k{i}", cell(), cell()]) + "\n" for i in range(60)) for _ in range(3)]
    (tmp_path / "in").mkdir()
    for i, text in enumerate(texts):
        (tmp_path / f"in/f{i}.csv").write_text(text, encoding="utf-8")
    had = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if small:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    try:
        group = files.detect(spark, str(tmp_path / "in"))
        got = files.read_delimited(spark, group).orderBy("file", "n").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had)
    for i, text in enumerate(texts):
        expected = by_csv(text)
        mine = [r for r in got if r.file == f"f{i}.csv"]
        assert [r.n for r in mine] == list(range(1, len(expected) + 1))
        assert [[r.one or "", r.two or "", r.three or ""] for r in mine] == expected


def test_many_files_of_one_shape_are_one_scan(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"s{i}.csv").write_text(f"start_date;energy_kwh\n2024-01-01;{i}\n2024-01-02;{i}\n")
    got = pipeline.ingest(spark, str(tmp_path), AT)["session"]
    assert got.count() == 60 and got.select("session_id").distinct().count() == 60
    assert got._jdf.queryExecution().toString().count("Union") <= 1


def test_bad_lines_are_named_and_unknown_types_counted(spark, tmp_path):
    f = tmp_path / "r.jsonl"
    f.write_text('{"record_type": "session", "session_id": "a"}\n\n{"record_type": "pet"}\n{"x": 1}\nnot json\n')
    assert {r.record_type: r.n for r in files.unknown_records(spark, str(f)).collect()} == {"pet": 1, None: 2}
    with pytest.raises(Exception, match=r"r\.jsonl, line 5: not json"):
        files.read_jsonl(spark, str(f), schemas.struct(session_id=schemas.S)).collect()


def test_generated_stations(spark, tmp_path):
    whole, messy = synthetic.stations(spark, 2000, 7, degrade=False), synthetic.stations(spark, 2000, 7)
    assert whole.count() == 2000 and whole.where(F.size("props") == 11).count() == 2000
    # the same for any partitioning
    rows = lambda df: sorted(json.dumps(r.asDict(), sort_keys=True) for r in df.collect())
    got = rows(messy)
    assert got == rows(synthetic.degrade_features(whole.repartition(3), 7)) and got != rows(synthetic.stations(spark, 2000, 8))
    share = lambda c: messy.where(c).count() / 2000
    p = lambda k: F.try_element_at("props", F.lit(k))
    assert 1.005 < share(F.lit(True)) < 1.04 and 0.6 < share(F.size("props") < 11) < 0.95
    assert 0.05 < share(p("open_date").isin(synthetic.ODD_DATES)) < 0.16 and 0.02 < share(F.length(F.element_at("coordinates", 2)) > 9) < 0.08
    synthetic.write_features(messy, str(tmp_path / "s.geojson"))
    back = files.read_geojson(spark, [str(tmp_path / "s.geojson")])
    ports = assemble.ports(back, "2024-01-01T00:00:00+00:00")
    # a unit's ports, or one bare record without units
    want = sum(json.loads(u)[0]["connectors"]["J1772"]["port_count"] if u else 1 for u in (r.u for r in messy.select(p("ev_charging_units").alias("u")).collect()))
    assert back.count() == len(got) and ports.count() == want
    empty = tmp_path / "empty.geojson"
    synthetic.write_features(messy.where("false"), str(empty))
    assert files.read_geojson(spark, [str(empty)]).count() == 0 and files.sniff(empty.read_text()) == "geojson"
