import random

import pytest
from pyspark.sql import functions as F

from ohmbridge import schemas
from ohmbridge.functions import geo, stats, text
from ohmbridge.operators import anomalies, classes, dedup, fuse, kpis, matching
from ohmbridge.plans import pipeline, registry

SEEN = "2024-06-01T00:00:00+00:00"


def prov(source="cary", ref="line:1", at=SEEN):
    return {"source": source, "source_file": "f", "ingested_at": at, "raw_ref": ref}


def frame(spark, kind, rows):
    full = [{**{f: None for f in schemas.validated(kind).names}, "record_type": kind, "quality": {"score": 1.0, "extraction_confidence": None, "issues": [], "fixes_applied": []}, "provenance": prov(ref=f"line:{i}"), **r} for i, r in enumerate(rows)]
    return spark.createDataFrame(full, schemas.validated(kind)).withColumn("quarantined", F.lit(False))


def session(i, day, cid="A1", start="10:00:00", end="11:00:00", kwh=7.0, **more):
    return {"session_id": f"s{i}", "charger_id": cid, "start_time": f"2024-{day}T{start}+00:00", "end_time": f"2024-{day}T{end}+00:00", "energy_kwh": kwh, "duration_min": 60.0, **more}


ADDR = {"street": "1 Main St", "city": "Cary", "state": "NC", "zip": "27511"}
CHARGERS = [
    {"charger_id": "A1", "station_id": "A", "station_name": "Alpha Garage", "address": ADDR, "lat": 35.79, "lon": -78.78, "power_kw": 7.2, "status": "ACTIVE"},
    {"charger_id": "B1", "station_id": "B", "station_name": "Beta Lot", "power_kw": 6.6, "status": "ACTIVE", "provenance": prov("afdc", "r1", "2024-01-01T00:00:00+00:00")},
    {"charger_id": "B1", "station_id": "B", "station_name": "Beta Lot", "power_kw": 7.2, "status": "MAINTENANCE", "provenance": prov("afdc", "r2", "2024-06-01T00:00:00+00:00")},
    {"charger_id": "C1", "station_id": "C", "station_name": "Gamma Deck", "power_kw": 7.2, "status": "ACTIVE"},
]
SESSIONS = [
    *(session(60 + i, f"01-{2 + i:02d}", kwh=7.0 + i / 10) for i in range(6)),
    *(session(i, f"01-{10 + i:02d}") for i in range(6)),
    session(6, "01-20", kwh=42.7),
    session(0, "01-10"),  # the same session again
    session(7, "01-22", kwh=31.0), session(8, "01-22", start="10:02:00", end="11:02:00", kwh=31.1),  # billed twice
    *(session(20 + i, f"05-{10 + i:02d}", "B1", fault_code="E-42" if i < 2 else None, peak_kw=9.2 if i == 4 else 6.0) for i in range(5)),
    session(30, "05-20", "B1", start="10:00:00", end="11:00:00"), session(31, "05-20", "B1", start="10:30:00", end="12:00:00", kwh=9.0),  # overlap
    *(session(40 + i, f"05-{20 + i:02d}", "C1") for i in range(5)),
    session(50, "05-25", "Z9", station_name="Nowhere"),
]
EVENTS = [
    {"event_id": "e1", "charger_id": "B1", "event_date": "2024-05-12", "event_type": "FAULT", "severity": "SAFETY", "description": "smoke"},
    {"event_id": "e2", "charger_id": "C1", "event_date": "2024-05-12", "event_type": "FAULT", "severity": "SAFETY", "description": "arc"},
    {"event_id": "e3", "charger_id": "C1", "event_date": "2024-05-13", "event_type": "REPAIR", "severity": "MINOR", "description": "fixed"},
    {"event_id": "e4", "charger_id": "C1", "event_date": "2024-05-13", "event_type": "REPAIR", "severity": "MINOR", "description": "Fixed!"},
    {"event_id": "e5", "description": "see charge box A1 at the garage", "event_type": "OTHER", "severity": "INFO", "event_date": "2024-05-01"},
]


def valid(spark, sessions=SESSIONS, chargers=CHARGERS, events=EVENTS):
    return {"charger": frame(spark, "charger", chargers), "session": frame(spark, "session", sessions), "maintenance": frame(spark, "maintenance", events)}


@pytest.fixture(scope="module")
def golden(spark):
    return pipeline.reconcile(valid(spark))


def test_golden_counts(spark, golden):
    report = pipeline.reconciliation_report(valid(spark), golden)
    assert report["clusters"] == 3 and report["duplicates_removed"] == 1 + 2 + 1
    assert report["golden_records_out"] == 3 + (len(SESSIONS) - 2) + (len(EVENTS) - 1)
    assert report["anomalies"] == {"duplicate_billing": 1, "energy_outlier": 2, "utilization_cliff": 1, "concurrent_sessions": 1, "repeated_fault_code": 1, "power_over_rated": 1, "unresolved_safety_event": 1}


def test_each_plant_has_its_anomaly(golden):
    found = {(r.type, tuple(r.evidence)) for r in golden["anomalies"].collect()}
    assert ("duplicate_billing", ("s7", "s8")) in found and ("energy_outlier", ("s6",)) in found
    assert ("concurrent_sessions", ("s30", "s31")) in found and ("repeated_fault_code", ("s20", "s21")) in found
    assert ("power_over_rated", ("s24",)) in found and ("unresolved_safety_event", ("e1",)) in found
    cliffs = [e for t, e in found if t == "utilization_cliff"]
    assert len(cliffs) == 1 and cliffs[0][0] in ("s7", "s8")
    assert not any("e2" in e for t, e in found if t == "unresolved_safety_event")


def test_health_and_metrics(golden):
    c = {r.charger_id: r for r in golden["charger"].collect()}
    assert {k: v.health.state for k, v in c.items()} == {"A1": "SUSPECT_OUTAGE", "B1": "SAFETY_REVIEW", "C1": "HEALTHY"}
    assert c["B1"].metrics.fault_recurrence_count == 2 and c["C1"].metrics.est_uptime_pct == 1.0 and c["A1"].metrics.est_uptime_pct < 0.2
    assert c["A1"].health.since == "2024-01-22" and c["B1"].health.since == "2024-05-12"
    assert c["B1"].power_kw == 7.2 and c["B1"].status == "MAINTENANCE"
    assert sorted((x.field, x.chosen, tuple(x.rejected)) for x in c["B1"].conflicts_resolved) == [("power_kw", "7.2", ("6.6",)), ("status", "MAINTENANCE", ("ACTIVE",))]
    assert len(c["B1"].merged_from) == 2


def test_links(golden):
    c = {r.charger_id: r.golden_id for r in golden["charger"].collect()}
    e = {r.event_id: r for r in golden["maintenance"].collect()}
    assert e["e1"].charger_golden_id == c["B1"] and e["e5"].charger_golden_id is None and ("e3" in e) != ("e4" in e)
    s = {r.session_id: r for r in golden["session"].collect()}
    assert s["s50"].charger_golden_id is None and s["s0"].charger_golden_id == c["A1"] and s["s0"].station_id == "A"


def test_box_ids_in_text_link_events(spark):
    events = [{"event_id": "x", "description": "charge box EVB-77 dead", "event_type": "FAULT", "severity": "MAJOR"}]
    g = pipeline.reconcile(valid(spark, chargers=[{"charger_id": "EVB-77:1", "station_id": "EVB-77"}], sessions=[session(1, "01-01", "EVB-77:1")], events=events))
    assert g["maintenance"].first().charger_golden_id == g["charger"].first().golden_id


def test_ids_are_stable_on_a_superset(spark, golden):
    more = valid(spark, [*SESSIONS, session(90, "06-20")], [*CHARGERS, {"charger_id": "D1", "station_name": "Delta"}], [*EVENTS, {"event_id": "e9", "description": "new", "event_type": "OTHER", "severity": "INFO"}])
    late = pipeline.reconcile(more)
    for t in ("charger", "session", "maintenance"):
        assert golden[t].select("golden_id").join(late[t].select("golden_id"), "golden_id", "left_anti").count() == 0
    assert late["anomalies"].where("type = 'utilization_cliff' and key = 0").count() == 0


def test_compat_rank_prefers_the_other_source(spark):
    rows = [{"charger_id": "X", "power_kw": 1.0, "provenance": prov("afdc")}, {"charger_id": "X", "power_kw": 2.0, "provenance": prov("contractor")}]
    for compat, power in ((False, 1.0), (True, 2.0)):
        assert pipeline.reconcile(valid(spark, chargers=rows), compat)["charger"].first().power_kw == power


def refs(spark, rows):
    return frame(spark, "charger", rows).withColumn("idx", F.regexp_extract("provenance.raw_ref", r"(\d+)", 1).cast("long"))


def clusters(spark, rows):
    return {r.idx: r.cluster for r in matching.cluster_chargers(refs(spark, rows)).collect()}


def test_matching_predicate(spark):
    near = {"lat": 35.7900, "lon": -78.7800}
    assert clusters(spark, [{"charger_id": "1", "station_id": "S"}, {"charger_id": "2", "station_id": "S"}]) == {0: 0, 1: 1}
    assert clusters(spark, [{"charger_id": "1", "station_id": "S"}, {"station_id": " s "}]) == {0: 0, 1: 0}
    assert clusters(spark, [{"station_name": "Town Hall-PWH", **near}, {"station_name": "Town Hall PWH", "lat": 35.7905, "lon": -78.7800}]) == {0: 0, 1: 0}
    brand = [{"station_name": "Icon Parking 235 W 48th St", "lat": 40.76, "lon": -73.98, "address": {**ADDR, "city": "New York", "zip": None, "street": None}}, {"station_name": "Icon Parking 235 W 49th St", "lat": 40.72, "lon": -74.0, "address": {**ADDR, "city": "New York", "zip": None, "street": None}}]
    assert clusters(spark, brand) == {0: 0, 1: 1}
    same = [{"station_name": "One", "address": ADDR}, {"station_name": "Two", "address": {**ADDR, "street": "1 MAIN ST."}}]
    assert clusters(spark, same) == {0: 0, 1: 0}
    assert clusters(spark, [{"station_name": "Alone"}]) == {0: 0}


def mixed_rows(rng, n, sites):
    """Records of some sites that share ids, names, places and signs of zero in every combination."""
    pick = lambda *v: rng.choice(v)

    def row(k):
        return {
            "charger_id": pick(None, None, f"C{k}", f"c{k} ", f"D{k}"), "station_id": pick(None, None, f"S{k}", f"s{k}"), "station_name": pick(None, f"Town Hall North {k}", f"Town Hall-North {k}", "Town Hall South"),
            "address": pick(None, {**ADDR, "street": f"{k} Oak Ave"}, {**ADDR, "street": pick(f"{k} Oak Ave.", None)}), "lat": pick(None, 35.79 + k / 20, 35.7905 + k / 20, 0.0, -0.0), "lon": pick(None, -78.78, 0.0),
        }

    return [row(rng.randrange(sites)) for _ in range(n)]


def side(refs, prefix):
    return refs.select(*(F.col(c).alias({"x": "a", "y": "b"}[prefix] if c == "idx" else f"{prefix}_{c}") for c in refs.columns))


def test_clusters_equal_those_of_all_pairs_in_blocks(spark):
    rows = refs(spark, mixed_rows(random.Random(5), 60, 15))
    r = matching.station_refs(rows, "charger")
    pairs = matching.blocked_pairs(r).join(side(r, "x"), "a").join(side(r, "y"), "b")
    links = pairs.withColumn("__sim", text.name_similarity(F.col("x_name"), F.col("y_name"))).where(matching.same_entity()).select("a", "b").collect()
    least = list(range(60))
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert {x.idx: x.cluster for x in matching.cluster_chargers(rows).collect()} == dict(enumerate(least))
    assert 1 < len(set(least)) < 60


def test_pairs_of_classes_equal_those_of_rows(spark, monkeypatch):
    monkeypatch.setattr(classes, "PART", 3)
    rows = spark.range(60).select(F.col("id").alias("idx"), (F.col("id") * 7 % 5).alias("v"))
    kinds = classes.kinds_of(rows, ["v"])
    assert {r.parts for r in kinds.collect()} == {4} and kinds.count() == 5
    x, y = kinds.select(F.col("rep").alias("p"), F.col("v").alias("x")), kinds.select(F.col("rep").alias("q"), F.col("v").alias("y"))
    met = x.crossJoin(y).where("p <= q and abs(x - y) <> 1").select("p", "q", F.abs(F.col("x") - F.col("y")).alias("d"))
    out = sorted(map(tuple, classes.expand(met, rows, kinds, ["v"], ["d"]).collect()))
    at = {r.idx: r.v for r in rows.collect()}
    assert out == sorted((a, b, abs(at[a] - at[b])) for a in at for b in at if a < b and abs(at[a] - at[b]) != 1)


def test_distances_are_computed_for_places_before_rows_are_written_out(spark, tmp_path):
    spark.range(2700).select(F.col("id").alias("s_suppkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    plan = registry.QUERIES["haversine_pairs"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(ys") < plan.index("explode(xs") < plan.index("ASIN")


@pytest.mark.parametrize("broadcast", [True, False])
def test_association_equals_that_of_all_pairs_in_blocks(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(matching, "BROADCAST_REFS", 0)
    rng = random.Random(9)
    mine, chargers = refs(spark, mixed_rows(rng, 80, 12)), refs(spark, mixed_rows(rng, 25, 10))
    x, y = matching.station_refs(mine, "charger"), matching.station_refs(chargers, "charger")
    left, right = x.select(F.col("idx").alias("a"), F.posexplode(matching.blocking_keys()).alias("ord", "k")), y.select(F.col("idx").alias("b"), F.explode(matching.blocking_keys()).alias("k"))
    pairs = left.join(right, "k").groupBy("a", "b").agg(F.min("ord").alias("ord")).join(side(x, "x"), "a").join(side(y, "y"), "b")
    by_id = F.coalesce(F.col("x_cid") == F.col("y_cid"), F.lit(False)) | F.coalesce(F.col("x_sid") == F.col("y_sid"), F.lit(False))
    pairs = pairs.withColumn("__sim", F.when(by_id, 1.0).otherwise(text.name_similarity(F.col("x_name"), F.col("y_name"))))
    scored = pairs.select("a", "b", "ord", "__sim", matching.match_class().alias("c")).where("c >= 1").collect()
    best = {}
    for p in scored:
        best[p.a] = max(best.get(p.a, (0,)), (p.c, p["__sim"], -p.ord, -p.b))
    got = matching.associate(mine, "charger", chargers, chargers.select("idx", F.col("idx").alias("cluster")))
    assert {r.idx: r.cluster for r in got.collect()} == {a: -m[3] for a, m in best.items()}
    assert {m[0] for m in best.values()} >= {1, 3, 4, 5} and len(best) < 80


def test_survivor_of_a_group(spark):
    rows = [(0, "cary", 0.5, "2024", "a"), (1, "afdc", 0.5, None, None), (2, "afdc", 0.9, "2023", "a"), (3, "afdc", 0.9, "2024", "a"), (4, "afdc", 0.9, "2024", "a"), (5, None, None, None, None)]
    df = spark.createDataFrame(rows, "idx bigint, source string, score double, at string, station_name string")
    df = df.select("idx", F.when(F.col("idx") < 5, 1).alias("group"), "station_name", F.lit(None).cast("string").alias("station_id"), F.struct("source", F.col("at").alias("ingested_at")).alias("provenance"), F.struct("score").alias("quality"))
    out = matching.with_survivor(df)
    # a null group is a group
    assert out.columns == [*df.columns, "survivor"] and {r.idx for r in out.where("survivor").collect()} == {3, 5}


def test_name_similarity(spark):
    df = spark.createDataFrame([("Town Hall-PWH", "Town Hall PWH"), ("", None), ("a", ""), ("Cary Town Hall Parking", "TOWN OF CARY / TOWN HALL")], "a string, b string")
    got = [r.s for r in df.select(text.name_similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got[:3] == [1.0, 1.0, 0.0] and 0.7 < got[3] < 0.8


def groups(spark, rows):
    s = frame(spark, "session", rows).withColumn("idx", F.regexp_extract("provenance.raw_ref", r"(\d+)", 1).cast("long"))
    placed = spark.createDataFrame([], "idx bigint, cluster bigint")
    return {r.idx: (r.group, r.survivor) for r in dedup.group_sessions(s, placed).collect()}


def test_session_duplicates(spark):
    one = session(1, "01-01", None, driver_id="d1")
    assert groups(spark, [one, {**one, "session_id": "s2", "driver_id": "D1 "}]) == {0: (0, True), 1: (0, False)}
    got = groups(spark, [one, {**one, "session_id": "s2"}, {**one, "session_id": "s3", "driver_id": "d2"}, {**one, "session_id": "s4", "start_time": "2024-01-01T10:05:01+00:00"}, {**one, "session_id": "s5", "energy_kwh": 7.4}, {**one, "session_id": "s6", "energy_kwh": None}])
    assert [got[i][0] for i in range(6)] == [0, 0, 2, 3, 4, 5]
    chain = [{**one, "session_id": f"c{i}", "start_time": f"2024-01-01T10:{4 * i:02d}:00+00:00"} for i in range(5)]
    assert {g for g, _ in groups(spark, chain).values()} == {0} and sum(s for _, s in groups(spark, chain).values()) == 1


def test_fence_and_ranks(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4, 5)] + [("b", 5.0)] * 5 + [("b", 9.0)] + [("c", 1.0)] * 4 + [("d", float(x)) for x in (0, 1, 5, 5, 5, 5, 6, 99)], "g string, v double")
    fence = {r.g: r.fence for r in stats.upper_fences(df, "g", "v").collect()}
    got = {r.g: (fence.get(r.g), r.p50, r.p95) for r in stats.order_statistics(df, "g", "v", {"p50": stats.nearest_rank(50), "p95": stats.nearest_rank(95)}).collect()}
    assert got["a"] == (4 + 3 * 2, 2.0, 5.0) and got["b"] == (None, 5.0, 9.0) and got["c"][0] is None
    assert got["d"][0] == 6 + 3 * 1


def test_haversine(spark):
    r = spark.range(1).select(geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("a"), geo.haversine_km(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("b")).first()
    assert abs(r.a - 111.195) < 0.01 and r.b == float("inf")


def test_source_rank(spark):
    names = ["AFDC mirror", "nyc_dot", "Town of Cary", "contractor email", "elsewhere", "", None]
    got = [r.r for r in spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select("i", matching.source_rank(F.col("n")).alias("r")).orderBy("i").collect()]
    assert got == [0, 0, 1, 2, 3, 3, 3]


def test_reports(spark, golden):
    out = pipeline.report(golden)
    assert out["kpis"]["chargers_deployed"] == 3 and out["kpis"]["active_chargers"] == 2 and out["kpis"]["sessions_count"] == len(SESSIONS) - 2
    assert out["health_states"] == {"SUSPECT_OUTAGE": 1, "SAFETY_REVIEW": 1, "HEALTHY": 1}
    now = spark.createDataFrame([(6, 0.5, None)], "chargers_deployed long, est_uptime_pct double, data_completeness_pct double")
    old = spark.createDataFrame([(4, 60.0, 90.0)], "chargers_deployed long, est_uptime_pct double, data_completeness_pct double")
    assert {r.metric: r.delta for r in kpis.restatement(now, old).collect()} == {"Chargers deployed": 2.0, "Est. fleet uptime (%)": -10.0}
    feed = kpis.severity_feed(spark.createDataFrame([("INFO",), (None,), ("SAFETY",), ("odd",), ("WARN",)], "severity string"), "severity")
    assert [r.severity for r in feed.collect()] == ["SAFETY", "WARN", "INFO", None, "odd"]


def test_write_golden(spark, golden, tmp_path):
    import json

    pipeline.write_golden(golden, str(tmp_path / "g"), limit=5)
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "g")).collect()]
    assert len(rows) == 5 and sum(r["record_type"] == "charger" for r in rows) == 3 and all("peak_kw" not in r or r["peak_kw"] is not None for r in rows)


def test_empty_inputs(spark):
    g = pipeline.reconcile(valid(spark, [], [], []))
    assert all(g[t].count() == 0 for t in g)
    assert anomalies.A["cliff_sessions"] == 3 and fuse.SESSION_FIELDS


def test_run_is_resumable(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "s.csv").write_text("start_date;station_name;charging_time_hh_mm_ss;energy_kwh;address_1;address_2;city;state_province;zip_postal_code\n2023-01-02T10:00:00-05:00;Hall;1;7.5;1 Main St;;Cary;NC;27511\n")
    run = lambda: pipeline.Run(spark, str(raw), str(tmp_path / "out"), SEEN).execute()
    first = run()
    assert first["kpis"]["sessions_count"] == 1 and "skipped" not in first and run()["skipped"]
    (raw / "late.csv").write_text((raw / "s.csv").read_text())
    again = run()
    assert "skipped" not in again and again["reconciliation"]["records_in"] == 2


def test_a_run_goes_on_from_the_stage_that_changed(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "s.csv").write_text("start_date;energy_kwh\n2023-01-02T10:00:00-05:00;7.5\n")
    made = lambda **k: pipeline.Run(spark, str(raw), str(tmp_path / "out"), SEEN, **k)

    def broken(*a):
        raise RuntimeError

    monkeypatch.setattr(pipeline, "report", broken)
    with pytest.raises(RuntimeError):
        made(retries=0).execute()
    monkeypatch.undo()
    second = made()
    out = second.execute()
    assert [second.health[s]["skipped"] for s in ("validation", "reconciliation", "reporting")] == [True, True, False] and out["kpis"]["sessions_count"] == 1
    # an output that is gone is made again
    import shutil

    shutil.rmtree(tmp_path / "out/golden/session")
    third = made()
    third.execute()
    assert [third.health[s]["skipped"] for s in ("validation", "reconciliation", "reporting")] == [True, False, True]
    fourth = made(rules={"stale": {"max_days": 100000}})
    assert "skipped" not in fourth.execute() and not fourth.health["validation"]["skipped"]
