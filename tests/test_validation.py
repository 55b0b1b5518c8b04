import datetime as dt
import random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from ohmbridge import config, schemas
from ohmbridge.functions import time
from ohmbridge.operators import rules, standardise
from ohmbridge.streaming import intake

PROV = {"source": "afdc", "source_file": "f", "ingested_at": "2024-03-10T00:00:00+00:00", "raw_ref": "line:1"}


def clean(spark, kind, rows, cat=None):
    full = [{**{f: None for f in schemas.raw(kind).names}, "record_type": kind, "provenance": PROV, **r, "idx": i} for i, r in enumerate(rows)]
    schema = schemas.raw(kind).add("idx", "long")
    return [r for r in standardise.clean(spark.createDataFrame(full, schema), kind, cat).orderBy("idx").collect()]


def test_chargers(spark):
    got = clean(spark, "charger", [
        {"connector_type": "chgpt LVL2 dual", "power_kw": "8000", "address": {"street": " 1  Main ", "city": "Cary", "state": "North  Carolina", "zip": "27511-12"}, "lat": "35.7", "lon": "-78.7", "status": "in service", "install_date": "3/4/24"},
        {"lat": "40.7", "lon": "-74.0", "level": "2", "power_kw": "abc"},
        {"connector_type": "mystery", "status": "odd", "lat": "91", "lon": "0", "provenance": {**PROV, "source": None}},
        {"power_kw": "1.4"}, {"power_kw": "-3"}, {"power_kw": "500000"}, {"install_date": "1287100800000"},
    ])
    a = got[0]
    assert (a.connector_type, a.power_kw, a.level, a.status, a.install_date, a.address.state, a.address.zip, a.address.street) == ("CHAdeMO", 8.0, "L2", "ACTIVE", "2024-03-04", "NC", "27511", "1 Main")
    assert a.quality.issues == [] and a.quality.score == 1.0 and "unit_repair:power_kw:8000.0→8.0" in a.quality.fixes_applied and "derive:level:null→L2" in a.quality.fixes_applied
    b = got[1]
    assert b.quality.issues == ["invalid_power_kw", "outside_territory", "invalid_level"] and b.raw_power_kw == "abc" and b.power_kw is None and b.raw_level == "2" and b.level is None and b.quality.score == 0.4 and not b.quarantined
    c = got[2]
    assert c.connector_type == "OTHER" and c.status == "UNKNOWN" and c.quality.issues == ["missing_provenance_source", "coordinate_out_of_range", "outside_territory", "model_validation_failed"] and c.quality.score == 0.25 and c.quarantined
    assert got[3].level == "L1" and got[4].quality.issues == ["impossible_power_kw"] and got[5].quality.issues == ["power_kw_out_of_range"] and got[5].power_kw == 500000
    assert got[6].quality.issues == ["invalid_install_date"] and got[6].raw_install_date == "1287100800000"


def test_sessions(spark):
    got = clean(spark, "session", [
        {"start_time": "3/4/24 2pm", "end_time": "2024-03-04T15:00:00-05:00"},
        {"energy_kwh": "3500", "start_time": "2024-03-09T10:00:00+00:00"},
        {"energy_kwh": "-1", "start_time": "2024-03-09T10:00:00Z", "end_time": "2024-03-09T09:00:00Z", "duration_min": "5"},
        {"start_time": "2024-03-09T10:00:00Z", "end_time": "2024-03-09T11:00:00Z", "duration_min": "30"},
        {"start_time": "yesterday-ish", "energy_kwh": "lots"}, {"start_time": "2024-01-05", "duration_min": "01:10:00"},
        {"start_time": "2024-03-01T10:00:00Z", "quality": {"score": 0.7, "extraction_confidence": None, "issues": ["x"], "fixes_applied": ["before"]}},
    ])
    assert got[0].start_time == "2024-03-04T14:00:00-05:00" and got[0].duration_min == 60.0
    assert got[1].energy_kwh == 3.5
    assert got[2].quality.issues == ["impossible_energy_kwh", "end_before_start"]
    assert got[3].duration_min == 60.0 and got[3].quality.issues == []
    assert got[4].raw_start_time == "yesterday-ish" and got[4].raw_energy_kwh == "lots" and got[4].start_time is None
    assert got[5].quality.issues == ["invalid_duration_min", "stale_report", "invalid_start_time"] and got[5].raw_start_time == "2024-01-05T00:00:00"
    assert got[6].quality.issues == ["stale_report"] and got[6].quality.score == 0.6 and got[6].quality.extraction_confidence == 0.7 and got[6].quality.fixes_applied[0] == "before"


def test_maintenance(spark):
    got = clean(spark, "maintenance", [
        {"event_id": "e1", "description": "  text \n", "event_type": "site visit", "severity": "urgent-safety", "event_date": "01.03.2024"},
        {"event_id": "e2", "description": "x", "event_type": "dance", "severity": "catastrophic"},
        {"description": None},
    ])
    assert (got[0].event_type, got[0].severity, got[0].event_date, got[0].description) == ("INSPECTION", "SAFETY", "2024-03-01", "text") and got[0].quality.issues == ["stale_report"]
    assert got[1].event_type == "OTHER" and got[1].severity is None and got[1].raw_severity == "catastrophic" and got[1].quality.issues == ["invalid_severity"]
    assert got[2].quality.issues == ["missing_event_id", "missing_description", "model_validation_failed"]


def test_override_and_registry(spark):
    box = config.catalog({"territory": {"bbox": {"min_lat": 40.0, "max_lat": 41.0}}})
    assert box["territory"]["bbox"] == {"min_lat": 40.0, "max_lat": 41.0, "min_lon": -84.4, "max_lon": -75.4}
    got = clean(spark, "charger", [{"lat": "40.5", "lon": "-80"}], box)
    assert got[0].quality.issues == []
    with pytest.raises(KeyError):
        rules.issues(config.catalog({"rules": [{"id": "x", "check": "nope", "severity": "MINOR"}]}), "charger")
    rules.CHECKS["even"] = lambda cat, rule, kind: [F.when(F.col(rule["field"]) % 2 == 0, F.lit(rule["id"]))]
    try:
        cat = config.catalog({"rules": [{"id": "is_even", "check": "even", "severity": "INFO", "field": "n"}]})
        df = spark.range(3).withColumnRenamed("id", "n").withColumn("i", rules.issues(cat, "any"))
        assert [r.i for r in df.orderBy("n").collect()] == [["is_even"], [], ["is_even"]]
        assert df.select(rules.score(F.col("i"), F.lit(None).cast("double"), cat).alias("s")).first().s == 0.98
    finally:
        del rules.CHECKS["even"]


def test_numbers(spark):
    texts = ["1", " 2.5 ", "1d", "1_0", "nan", "inf", "1e400", "", None, "-3e2", ".5"]
    got = [r.v for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", rules.number(F.col("t")).alias("v")).orderBy("i").collect()]
    assert got == [1.0, 2.5, None, None, None, None, None, None, None, -300.0, 0.5]


def test_validation_stream_equals_batch(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.jsonl").write_text('{"record_type":"charger","power_kw":"8000","provenance":{"source":"s","source_file":"f","ingested_at":"2024-01-01T00:00:00Z"}}\n{"record_type":"session"}\n')
    q = intake.validate_stream(intake.raw_stream(spark, str(src), "charger"), "charger", str(out), str(tmp_path / "cp"))
    q.awaitTermination()
    (src / "b.jsonl").write_text('{"record_type":"charger","power_kw":"7","provenance":{"source":"s","source_file":"f","ingested_at":"2024-01-01T00:00:00Z"}}\n')
    q = intake.validate_stream(intake.raw_stream(spark, str(src), "charger"), "charger", str(out), str(tmp_path / "cp"))
    q.awaitTermination()
    assert sorted(r.power_kw for r in spark.read.parquet(str(out)).collect()) == [7.0, 8.0]


def test_repair_hook(spark):
    def repair(field, value, members):
        return {"catastrophic": "SAFETY", "bad": "NOT A MEMBER"}.get(value)

    rows = [{"event_id": str(i), "description": "x", "severity": v} for i, v in enumerate(["catastrophic", "bad", "minor", None])]
    full = [{**{f: None for f in schemas.raw("maintenance").names}, "record_type": "maintenance", "provenance": PROV, **r} for r in rows]
    got = {r.event_id: r for r in standardise.clean(spark.createDataFrame(full, schemas.raw("maintenance")), "maintenance", repair=repair).collect()}
    assert [got[str(i)].severity for i in range(4)] == ["SAFETY", None, "MINOR", None] and got["1"].raw_severity == "bad"
    assert "repair:severity:catastrophic→SAFETY" in got["0"].quality.fixes_applied


def test_catalog_problems():
    assert config.problems(config.catalog()) == []
    bad = config.catalog({"territory": {"bbox": {"min_lat": 90}}, "scoring": {"weights": {"MAJOR": 3}}, "synonyms": {"level": {"L9": ["x"]}}, "rules": [{"id": "a", "check": "range"}]})
    assert len(config.problems(bad)) == 4


def test_unknown_keys_of_an_override_are_named():
    bad = config.catalog({"stale_days": 3, "territory": {"min_lat": 1}, "unit_repair": {"speed": {"watts_if_above": 5, "max_plausible": 9}}, "rules": [{"id": "a", "check": "stale", "severity": "INFO", "code": "b"}]})
    assert config.problems(bad) == ["unknown key: territory.min_lat", "unknown key: stale_days", "rule a: unknown key code"]
    assert config.problems(config.catalog({"stale": {"max_days": 3}, "scoring": {"weights": {"MAJOR": 0.3}}})) == []


def test_lenient_dates_equal_a_general_parser(spark):
    parser = pytest.importorskip("dateutil.parser")
    zone = ZoneInfo("America/New_York")
    rng = random.Random(4)
    dates = ("{d.year}-{d.month:02}-{d.day:02}", "{d.year}/{d.month}/{d.day}", "{d.month}/{d.day}/{d.year}", "{d.month}-{d.day}-{d.year}", "{d:%B} {d.day}, {d.year}", "{d:%b} {d.day} {d.year}", "{d:%b}. {d.day}, {d.year}", "{d.day} {d:%b} {d.year}", "{d.day:02}-{d:%b}-{d.year}", "{d.year} {d:%B} {d.day}", "{d:%a}, {d.day} {d:%b} {d.year}", "{d:%A} {d:%B} {d.day}th, {d.year}", "{d.day} of {d:%B} {d.year}", "{d:%Y%m%d}", "{d:%b} {d.day} {d:%y}", "{d.day}/{d.month}/{d.year}")
    times = ("{d:%H:%M}", "{d:%H:%M:%S}", "{d:%H:%M:%S}.{d.microsecond:06}", "{d.hour}:{d.minute}:{d.second}", "{d:%I}:{d.minute}{d:%p}", "{d:%I:%M %p}", "{d:%I:%M:%S%p}", "{d:%I %p}", "{d:%I}pm", "{d:%H:%M:%S} UTC", "{d:%H:%M:%S}+02:00", "{d:%H:%M} -0730", "{d:%H:%M}Z")
    said = []
    for k, date in enumerate(dates):
        for time_ in times:
            d = dt.datetime(1990, 1, 1) + dt.timedelta(seconds=rng.randrange(30 * 365 * 86400), microseconds=rng.choice([0, 120000, 7]))
            # noon or midnight would be no plain test of the halves of a day; 02:30 may not exist
            d = d.replace(hour=rng.randrange(3, 24))
            said.append(" ".join((date, time_)).format(d=d))
            said.append(date.format(d=d) if k > 3 and k < 15 else f"{time_.format(d=d)} {date.format(d=d)}")
    said += ["12:05 AM 1/2/2024", "12:05 PM 1/2/2024", "1/2/2024 0:00", "2/30/2024 10:00", "1/2/2024 25:00", "13:00 PM 1/2/2024", "Smarch 3, 2024", "Jan 5, 2024 soon", "1/2/2024 10:61", "sometime", "10:00", ""]

    def plain(text):
        try:
            got = parser.parse(text, fuzzy=False)
        except (ValueError, OverflowError):
            return None
        if text in ("", "10:00"):
            return None  # the parser takes today's date
        return (got if got.tzinfo else got.replace(tzinfo=zone)).isoformat()

    df = spark.createDataFrame(list(enumerate(said)), "i int, t string")
    got = {r.i: r.iso for r in df.select("i", time.lenient(F.col("t"), "America/New_York").alias("iso")).collect()}
    assert [(t, got[i]) for i, t in enumerate(said) if got[i] != plain(t)] == []
    assert sum(v is not None for v in got.values()) > 300


def _readers(df) -> int:
    """How often the plan reads a text by the reader of all forms."""
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    return df._jdf.queryExecution().optimizedPlan().toString().count("TUES?")


def test_each_value_is_made_once_for_a_row(spark):
    """The reader of dates stands in the plan once for each date of a record, however many values and notes are made of it."""
    one = _readers(spark.createDataFrame([("1/2/2024",)], "a string").select(time.lenient(F.col("a"), "America/New_York").alias("a")))
    raw = spark.createDataFrame([], schemas.raw("session"))
    assert one > 0 and _readers(standardise.clean(raw, "session")) <= 3 * one


def test_plain_instants_and_texts_without_figures(spark):
    said = {"2024-01-02t03:04:05z": "2024-01-02T03:04:05+00:00", " 2024-01-02T03:04:05.5-05:00 ": "2024-01-02T03:04:05.5-05:00", "2024-13-02T03:04:05Z": "2024-02-13T03:04:05+00:00", "2024-02-30T03:04:05+01:00": None, "soon": None, "": None}
    rows = spark.createDataFrame([(k,) for k in said], "a string").select("a", time.lenient(F.col("a"), "America/New_York").alias("x")).collect()
    assert {r.a: r.x for r in rows} == said
