"""Queries that run the record operators themselves, over records made from the star tables.

Each builds raw or validated records of known content from a table's keys, hands
them to an operator, and has the SQL of what must come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmbridge import schemas
from ohmbridge.operators import anomalies, assemble, dedup, extract, fuse, kpis, matching, standardise
from ohmbridge.plans import pipeline
from ohmbridge.plans.registry import _FENCE, _order_members, query, sessions, table
from ohmbridge.sources import files, sinks
from ohmbridge.storage import scratch_path


def shaped(df: DataFrame, kind: str, tier: str = "validated") -> DataFrame:
    """``df`` with all columns of the record type's schema, and its others."""
    fields = (schemas.raw(kind) if tier == "raw" else schemas.validated(kind)).fields
    return df.withColumns({f.name: (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType) for f in fields})


def text_of(*parts) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def provenance(source="afdc", at="2024-03-01", ref="line:1") -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(source).alias("source"), F.lit("f.csv").alias("source_file"), lit(at).alias("ingested_at"), lit(ref).alias("raw_ref"))


def quality(score: float = 1.0) -> Column:
    none = F.array().cast("array<string>")
    return F.struct(F.lit(score).alias("score"), F.lit(None).cast("double").alias("extraction_confidence"), none.alias("issues"), none.alias("fixes_applied"))


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


# --- scans -----------------------------------------------------------------------------

@query("""SELECT c_custkey::VARCHAR AS key, c_name || chr(10) || 'x;"y"' AS name, c_custkey + 1 - (SELECT min(c_custkey) FROM customer) AS n, '' AS issues FROM customer""")
def delimited_scan(spark, sf_dir):
    """Customers written as one semicolon file with quoted line breaks, detected and read back."""
    path = scratch_path(spark, "delimited")
    c = table(spark, sf_dir, "customer").orderBy("c_custkey").select(F.col("c_custkey").cast("string").alias("key"), text_of(F.col("c_name"), '\nx;"y"').alias("name"))
    c.coalesce(1).write.option("header", True).option("sep", ";").option("quoteAll", True).option("escape", '"').csv(path)
    (f,) = (f for f in files.detect(spark, path) if f.kind == "csv")
    return files.read_delimited(spark, f).select("key", "name", "n", F.array_join("issues", ",").alias("issues"))


@query("""SELECT 'session' AS record_type, count(*) AS n, sum(event_id)::BIGINT AS keys FROM events UNION ALL SELECT 'charger', count(*), sum(s_suppkey)::BIGINT FROM supplier
UNION ALL SELECT 'maintenance', count(*), sum(p_partkey)::BIGINT FROM part""")
def typed_records(spark, sf_dir):
    """Records of three types in one file of JSON lines, without nulls, split by type again."""
    path = scratch_path(spark, "typed")
    made = {"charger": ("supplier", "s_suppkey", "charger_id"), "session": ("events", "event_id", "session_id"), "maintenance": ("part", "p_partkey", "event_id")}
    frames = [shaped(table(spark, sf_dir, t).select(F.lit(kind).alias("record_type"), F.col(key).cast("string").alias(name)), kind, "raw").select(*schemas.raw(kind).names) for kind, (t, key, name) in made.items()]
    sinks.write_jsonl([(df, []) for df in frames], path)
    back = files.read_records(spark, path)
    out = [back[kind].agg(F.lit(kind).alias("record_type"), F.count("*").alias("n"), F.sum(F.col(name).cast("long")).alias("keys")) for kind, (_, _, name) in made.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


# --- assembly --------------------------------------------------------------------------

@query("""SELECT 'cary-' || left(sha1('a.csv:' || (event_id + 1)), 12) AS session_id, strftime(ts::TIMESTAMP, '%Y-%m-%d') AS start_time, nullif(event_id % 5, 0)::VARCHAR AS energy_kwh, 'line:' || (event_id + 1) AS raw_ref,
    CASE WHEN event_id % 7 = 0 THEN 0.7 ELSE 1.0 END::DOUBLE AS score, CASE WHEN event_id % 7 = 0 THEN 'malformed_row' ELSE '' END AS issues FROM events""")
def plain_sessions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    broken = F.when(F.col("event_id") % 7 == 0, F.array(F.lit("malformed_row"))).otherwise(F.array().cast("array<string>"))
    rows = e.select(F.lit("a.csv").alias("file"), (F.col("event_id") + 1).alias("n"), broken.alias("issues"), F.date_format("ts", "yyyy-MM-dd").alias("start_date"), F.when(F.col("event_id") % 5 > 0, (F.col("event_id") % 5).cast("string")).otherwise(F.lit("")).alias("energy_kwh"))
    s = assemble.sessions_plain(rows, "2024-03-01")
    return s.select("session_id", "start_time", "energy_kwh", F.col("provenance.raw_ref").alias("raw_ref"), F.col("quality.score").alias("score"), F.array_join("quality.issues", ",").alias("issues"))


def _boxes(spark, sf_dir) -> DataFrame:
    s = sessions(spark, sf_dir)
    rows = s.select(F.lit("b.csv").alias("file"), (F.col("idx") + 1).alias("n"), F.array().cast("array<string>").alias("issues"), F.lit(" 01/02/2024").alias("Date"), F.lit("10:00:00").alias("Connected Time"),
                    F.when(F.col("idx") % 11 > 0, text_of("B", F.col("user_id"))).alias("Charge Box ID"), (F.col("k") % 2).cast("string").alias("Connector ID"), F.col("k").cast("string").alias("Energy Provided (kWh)"))
    return assemble.sessions_box(rows, "2024-03-01")


@query("""SELECT 'nyc-' || left(sha1('b.csv:' || (event_id + 1)), 12) AS session_id, CASE WHEN event_id % 11 > 0 THEN 'B' || user_id || ':' || ((props->>'$.k')::BIGINT % 2) END AS charger_id, '01/02/2024 10:00:00' AS start_time, (props->>'$.k') AS energy_kwh FROM events""")
def box_sessions(spark, sf_dir):
    return _boxes(spark, sf_dir).select("session_id", "charger_id", "start_time", "energy_kwh")


@query("""SELECT 'B' || user_id || ':' || ((props->>'$.k')::BIGINT % 2) AS charger_id, any_value('B' || user_id) AS station_id, 'line:' || (min(event_id) + 1) AS raw_ref FROM events WHERE event_id % 11 > 0 GROUP BY 1""")
def first_per_key(spark, sf_dir):
    """A charger for each box, from the first session that names it."""
    return assemble.box_chargers(_boxes(spark, sf_dir)).select("charger_id", "station_id", F.col("provenance.raw_ref").alias("raw_ref"))


@query("""WITH p AS (SELECT p_partkey AS p, unnest([0, 1, 2, 3]) AS i FROM part)
SELECT p::VARCHAR AS station_id, CASE WHEN p % 4 = 0 THEN NULL WHEN i < 2 THEN p || '#0#J1772#' || i ELSE p || '#0#CCS#' || (i - 2) END AS charger_id, CASE WHEN p % 4 = 0 THEN 'raw' WHEN i < 2 THEN 'J1772' ELSE 'CCS' END AS connector_type,
    CASE WHEN p % 4 = 0 THEN NULL WHEN i < 2 THEN '7.2' ELSE '50' END AS power_kw, '35.2' AS lat, '-80.1' AS lon, 'Cary' AS city FROM p WHERE CASE WHEN p % 4 = 0 THEN i = 0 ELSE i < 2 + p % 3 END""")
def feature_ports(spark, sf_dir):
    """Registry features to ports: two of one connector, none to two of another, or a bare record."""
    p = F.col("p_partkey")
    units = text_of('[{"network":"N","charging_level":"2","connectors":{"J1772":{"power_kw":"7.2","port_count":2},"CCS":{"power_kw":"50","port_count":', p % 3, "}}}]")
    props = F.map_filter(F.create_map(F.lit("id"), p.cast("string"), F.lit("ev_charging_units"), F.when(p % 4 > 0, units), F.lit("ev_connector_types"), F.lit("raw"), F.lit("city"), F.lit("Cary")), lambda k, v: v.isNotNull())
    f = table(spark, sf_dir, "part").select(F.lit("r.geojson").alias("file"), F.lit("Point").alias("type"), F.array(F.lit("-80.1"), F.lit("35.2")).alias("coordinates"), props.alias("props"))
    return assemble.ports(f, "2024-03-01").select("station_id", "charger_id", "connector_type", "power_kw", "lat", "lon", F.col("address.city").alias("city"))


@query("""WITH r AS (SELECT s_suppkey AS k, 'r' || s_suppkey || '.txt' AS file FROM supplier), s AS (SELECT *, CASE k % 4 WHEN 0 THEN 'Depot ' WHEN 1 THEN 'Lot ' WHEN 2 THEN 'Site ' ELSE 'Yard ' END || k AS station_name FROM r)
SELECT 'maint-' || left(sha1(file || '#0#' || station_name), 12) AS event_id, CASE k % 4 WHEN 0 THEN 'INSPECTION' WHEN 1 THEN 'COMPLAINT' WHEN 2 THEN 'INSTALL' ELSE 'FAULT' END AS event_type,
    CASE k % 4 WHEN 0 THEN 'SAFETY' WHEN 1 THEN 'MINOR' WHEN 3 THEN 'SAFETY' END AS severity, CASE k % 4 WHEN 0 THEN '03/04/2024' WHEN 1 THEN '5/6/2024' WHEN 2 THEN '4/5/2024' ELSE '7/8/2024' END AS event_date, station_name,
    CASE k % 4 WHEN 2 THEN 0.85 WHEN 3 THEN 0.9 ELSE 0.95 END::DOUBLE AS score, CASE WHEN k % 4 = 2 THEN '7.2 kW' END AS rating, CASE WHEN k % 4 = 2 THEN 'Blue' END AS crew, CASE WHEN k % 4 = 0 THEN 'Ann' END AS technician, file AS raw_ref FROM s""")
def report_events(spark, sf_dir):
    """Four forms of reports, one event each, as maintenance records."""
    k = F.col("s_suppkey")
    forms = F.when(k % 4 == 0, text_of("Quarterly Inspection Form\ninsp.date: 03/04/2024\nsite/station.... Depot ", k, "\nseverity code [safety!!]\ntechnician: Ann"))
    forms = forms.when(k % 4 == 1, text_of('Customer complaint via 311\nlogged 5/6/2024\nlocation given: "Lot ', k, '"\npriority: minor'))
    forms = forms.when(k % 4 == 2, text_of("Install completion report\n4/5/2024 | crew: Blue\nnew unit commissioned at Site ", k, "\nnameplate: 7.2 kW"))
    forms = forms.otherwise(text_of("Subject: unit\nsent: 7/8/2024\nstation: Yard ", k, "\nbreaker trip again, urgent"))
    found = extract.events(table(spark, sf_dir, "supplier").select(text_of("r", k, ".txt").alias("file"), forms.alias("text")))
    m = assemble.maintenance(found, "2024-03-01")
    field = lambda name: F.try_element_at("extracted_fields", F.lit(name))
    return m.select("event_id", "event_type", "severity", "event_date", "station_name", F.col("quality.score").alias("score"), field("power_rating").alias("rating"), field("crew").alias("crew"), field("technician").alias("technician"), F.col("provenance.raw_ref").alias("raw_ref"))


# --- validation ------------------------------------------------------------------------

def _raw_sessions(spark, sf_dir) -> DataFrame:
    s = sessions(spark, sf_dir)
    m, plain = F.col("idx") % 6, lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    end = F.timestamp_micros(F.unix_micros("ts") + (F.col("k") + 1) * 60_000_000)
    seen = F.timestamp_micros(F.unix_micros("ts") + F.when(m == 5, F.lit(8)).otherwise(F.lit(1)) * 86_400_000_000)
    return shaped(s.select(
        "idx", F.lit("session").alias("record_type"), text_of(" s", F.col("idx"), "  x ").alias("session_id"), F.when(m == 1, F.lit("yesterday-ish")).otherwise(plain(F.col("ts"))).alias("start_time"), F.when(m != 1, plain(end)).alias("end_time"),
        F.when(m == 2, F.lit("lots")).when(m == 3, F.lit("-5")).when(m == 0, F.lit("3500")).otherwise(F.lit("12.5")).alias("energy_kwh"), F.when(m == 4, F.lit("999")).alias("duration_min"), provenance(at=plain(seen)).alias("provenance")), "session", "raw")


_SESSION_ISSUE = "CASE event_id % 6 WHEN 1 THEN 'invalid_start_time' WHEN 2 THEN 'invalid_energy_kwh' WHEN 3 THEN 'impossible_energy_kwh' WHEN 5 THEN 'stale_report' ELSE '' END"
_SESSION_SCORE = "CASE event_id % 6 WHEN 1 THEN 0.9 WHEN 2 THEN 0.75 WHEN 3 THEN 0.75 WHEN 5 THEN 0.9 ELSE 1.0 END::DOUBLE"


@query(f"""SELECT event_id AS idx, {_SESSION_ISSUE} AS issues, {_SESSION_SCORE} AS score, 's' || event_id || ' x' AS session_id, CASE event_id % 6 WHEN 2 THEN NULL WHEN 3 THEN -5.0 WHEN 0 THEN 3.5 ELSE 12.5 END::DOUBLE AS energy_kwh,
    CASE WHEN event_id % 6 <> 1 THEN ((props->>'$.k')::BIGINT + 1)::DOUBLE END AS duration_min, CASE WHEN event_id % 6 = 2 THEN 'lots' END AS raw_energy, CASE WHEN event_id % 6 = 1 THEN 'yesterday-ish' END AS raw_start,
    CASE WHEN event_id % 6 <> 1 THEN strftime(ts::TIMESTAMP, '%Y-%m-%dT%H:%M:%S+00:00') END AS start_time, event_id % 6 = 0 AS unit_fixed FROM events""")
def cleaned_sessions(spark, sf_dir):
    """Raw sessions of six kinds: clean, of a bad start, energy, sign, duration, or late."""
    c = standardise.clean(_raw_sessions(spark, sf_dir), "session")
    fixed = F.exists("quality.fixes_applied", lambda x: x == "unit_repair:energy_kwh:3500.0→3.5")
    return c.select("idx", F.array_join("quality.issues", ",").alias("issues"), F.col("quality.score").alias("score"), "session_id", "energy_kwh", "duration_min", F.col("raw_energy_kwh").alias("raw_energy"), F.col("raw_start_time").alias("raw_start"), "start_time", fixed.alias("unit_fixed"))


@query(f"SELECT count(*) AS records, 0::BIGINT AS quarantined, round(avg({_SESSION_SCORE}), 4) AS avg_score FROM events")
def pipeline_totals(spark, sf_dir):
    return pipeline.totals(pipeline.validate({"session": _raw_sessions(spark, sf_dir)}))


@query("""SELECT p_partkey AS idx, CASE p_partkey % 4 WHEN 0 THEN 'J1772' WHEN 1 THEN 'CCS' WHEN 2 THEN 'OTHER' ELSE 'NACS' END AS connector_type, CASE WHEN p_partkey % 2 = 0 THEN 'ACTIVE' ELSE 'UNKNOWN' END AS status,
    CASE WHEN p_size > 4 THEN p_size / 10.0 ELSE p_size * 100 END::DOUBLE AS power_kw, CASE WHEN p_size <= 4 THEN 'DCFC' WHEN p_size / 10.0 <= 1.9 THEN 'L1' ELSE 'L2' END AS level, '27511' AS zip, 'NC' AS state, CASE WHEN p_partkey % 5 = 0 THEN '2024-03-04' END AS install_date,
    CASE WHEN p_partkey % 5 = 1 THEN 'missing_provenance_source,' ELSE '' END || CASE p_partkey % 7 WHEN 3 THEN 'invalid_latitude' WHEN 4 THEN 'outside_territory' ELSE '' END || CASE WHEN p_partkey % 5 = 2 THEN ',invalid_install_date' ELSE '' END
    || CASE WHEN p_partkey % 5 = 1 THEN ',model_validation_failed' ELSE '' END AS said, CASE WHEN p_partkey % 7 = 3 THEN 'north' END AS raw_lat FROM part""")
def cleaned_chargers(spark, sf_dir):
    p = F.col("p_partkey")
    kind = F.when(p % 4 == 0, F.lit(" sae  J1772 ")).when(p % 4 == 1, F.lit("CCS combo")).when(p % 4 == 2, F.lit("weird")).otherwise(F.lit("Tesla"))
    lat = F.when(p % 7 == 3, F.lit("north")).when(p % 7 == 4, F.lit("45.5")).otherwise(F.lit("35.5"))
    place = F.struct(F.lit(" 1  Main ").alias("street"), F.lit("Cary").alias("city"), F.lit(" North  Carolina ").alias("state"), F.lit("zip 27511-1234").alias("zip"))
    raw = shaped(table(spark, sf_dir, "part").select(
        p.alias("idx"), F.lit("charger").alias("record_type"), kind.alias("connector_type"), F.when(p % 2 == 0, F.lit("in service")).otherwise(F.lit("odd")).alias("status"), (F.col("p_size") * 100).cast("string").alias("power_kw"), place.alias("address"),
        lat.alias("lat"), F.lit("-79").alias("lon"), F.when(p % 5 == 0, F.lit("3/4/24")).when(p % 5 == 2, F.lit("soon")).alias("install_date"), provenance(F.when(p % 5 != 1, F.lit("afdc")), "2024-03-10T00:00:00Z").alias("provenance")), "charger", "raw")
    c = standardise.clean(raw, "charger")
    has = lambda code: F.array_contains("quality.issues", code)
    said = F.concat(*(F.when(has(code), F.lit(shown)).otherwise(F.lit("")) for code, shown in (("missing_provenance_source", "missing_provenance_source,"), ("invalid_latitude", "invalid_latitude"), ("outside_territory", "outside_territory"), ("invalid_install_date", ",invalid_install_date"), ("model_validation_failed", ",model_validation_failed"))))
    return c.select("idx", "connector_type", "status", "power_kw", "level", F.col("address.zip").alias("zip"), F.col("address.state").alias("state"), "install_date", said.alias("said"), "raw_lat")


@query("""SELECT o_orderkey AS idx, CASE o_orderkey % 3 WHEN 0 THEN 'INSPECTION' WHEN 1 THEN 'REPAIR' ELSE 'OTHER' END AS event_type, CASE o_orderkey % 3 WHEN 0 THEN 'SAFETY' WHEN 1 THEN 'MINOR' END AS severity, CASE WHEN o_orderkey % 3 = 2 THEN 'catastrophic' END AS raw_severity,
    strftime(o_orderdate, '%Y-%m-%d') AS event_date, CASE WHEN o_orderkey % 3 = 2 THEN 'invalid_severity' ELSE '' END AS issues, CASE WHEN o_orderkey % 3 = 2 THEN 0.9 ELSE 1.0 END::DOUBLE AS score FROM orders""")
def cleaned_events(spark, sf_dir):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    pick = lambda a, b, c: F.when(k % 3 == 0, F.lit(a)).when(k % 3 == 1, F.lit(b)).otherwise(F.lit(c))
    raw = shaped(table(spark, sf_dir, "orders").select(
        k.alias("idx"), F.lit("maintenance").alias("record_type"), text_of("e", k).alias("event_id"), F.lit(" text \n").alias("description"), pick("site visit", "replaced unit", "dance").alias("event_type"), pick("urgent-safety", "cosmetic", "catastrophic").alias("severity"),
        F.date_format(day, "dd.MM.yyyy").alias("event_date"), provenance(at=F.date_format(day, "yyyy-MM-dd'T'12:00:00'Z'")).alias("provenance")), "maintenance", "raw")
    c = standardise.clean(raw, "maintenance")
    return c.select("idx", "event_type", "severity", "raw_severity", "event_date", F.array_join("quality.issues", ",").alias("issues"), F.col("quality.score").alias("score"))


# --- matching ----------------------------------------------------------------------------

_NORM = "trim(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g'))"


@query(f"SELECT s_suppkey AS idx, CASE WHEN s_suppkey % 2 = 0 THEN 's' || s_suppkey ELSE 'bx-' || (100 + s_suppkey) END AS sid, {_NORM} AS name_norm FROM supplier")
def station_references(spark, sf_dir):
    """References of events: the station id, or the box that the text names."""
    k = F.col("s_suppkey")
    df = shaped(table(spark, sf_dir, "supplier").select(k.alias("idx"), F.when(k % 2 == 0, text_of(" S", k, " ")).alias("station_id"), text_of("seen at Charge Box: BX-", 100 + k, " again").alias("description"), F.col("s_name").alias("station_name")), "maintenance")
    return matching.station_refs(df, "maintenance").select("idx", "sid", "name_norm")


@query(f"""SELECT s_suppkey AS idx, unnest(list_filter([CASE WHEN s_suppkey % 3 = 0 THEN 'chg:c' || s_suppkey END, CASE WHEN s_suppkey % 3 = 1 THEN 'sid:s' || s_suppkey END,
    CASE WHEN s_suppkey % 2 = 0 THEN 'cityzip:city ' || (s_suppkey % 4) || '|' || lpad((s_suppkey % 7)::VARCHAR, 5, '0') END, 'geo:' || printf('%.1f', 33.023::DOUBLE + (s_suppkey % 50) / 10.0::DOUBLE) || ',' || printf('%.1f', -80.023::DOUBLE - (s_suppkey % 30) / 10.0::DOUBLE),
    'name3:st ' || {_NORM}, 'name3:' || {_NORM} || ' north'], lambda x: x IS NOT NULL)) AS key FROM supplier""")
def station_blocking_keys(spark, sf_dir):
    k = F.col("s_suppkey")
    place = F.struct(F.lit(None).cast("string").alias("street"), text_of("City ", k % 4).alias("city"), F.lit(None).cast("string").alias("state"), F.when(k % 2 == 0, F.lpad((k % 7).cast("string"), 5, "0")).alias("zip"))
    df = shaped(table(spark, sf_dir, "supplier").select(k.alias("idx"), F.when(k % 3 == 0, text_of("C", k)).alias("charger_id"), F.when(k % 3 == 1, text_of("S", k)).alias("station_id"), text_of("St ", F.col("s_name"), " north").alias("station_name"), place.alias("address"),
                                                        (33.023 + (k % 50) / 10.0).alias("lat"), (-80.023 - (k % 30) / 10.0).alias("lon")), "charger")
    return matching.station_refs(df, "charger").select("idx", F.explode(matching.blocking_keys()).alias("key"))


def _ports(spark, sf_dir) -> DataFrame:
    """Three records of each supplier: by id and address, by address (or apart), by id alone."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), "s_name", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("i"))
    k, i = F.col("k"), F.col("i")
    apart = (i == 1) & (k % 5 == 0)
    none = F.lit(None).cast("string")
    place = F.when(i < 2, F.struct(F.when(apart, F.lit("9 Side")).otherwise(text_of(k, " Main")).alias("street"), F.when(apart, text_of("Far ", k)).otherwise(text_of("Town ", k)).alias("city"), none.alias("state"), F.when(apart, F.lit("99999")).otherwise(F.lpad(k.cast("string"), 5, "0")).alias("zip")))
    return shaped(s.select(
        (3 * k + i).alias("idx"), k, i, F.lit("charger").alias("record_type"), F.when(i == 0, text_of("C", k)).when((i == 1) & (k % 5 == 1), text_of("D", k)).when(i == 2, text_of(" c", k)).alias("charger_id"),
        F.when(apart, text_of("Elsewhere ", k)).when(i == 2, text_of("Unit ", k)).otherwise(F.col("s_name")).alias("station_name"), place.alias("address"), F.when(i == 0, F.lit("ACTIVE")).when(i == 1, F.lit("MAINTENANCE")).alias("status"),
        provenance(F.when(i == 0, F.lit("afdc")).when(i == 1, F.lit("cary")).otherwise(F.lit("contractor")), ref=text_of("line:", i)).alias("provenance"), quality().alias("quality")), "charger").withColumns({"idx": F.col("idx")})


_PORTS_SQL = "p AS (SELECT s_suppkey AS k, unnest([0, 1, 2]) AS i FROM supplier), c AS (SELECT 3 * k + i AS idx, k, i, CASE WHEN i = 1 AND k % 5 < 2 THEN 3 * k + 1 ELSE 3 * k END AS cluster FROM p)"


@query(f"WITH {_PORTS_SQL} SELECT idx, cluster FROM c")
def port_clusters(spark, sf_dir):
    """Clusters of one port's records: by id, or by address where no ids disagree."""
    return matching.cluster_chargers(_ports(spark, sf_dir)).select("idx", "cluster")


@query(f"""WITH {_PORTS_SQL}, g AS (SELECT cluster, any_value(k) AS k, count(*) AS members, min(i) AS first FROM c GROUP BY cluster)
SELECT cluster, 'chg-' || left(sha256(CASE WHEN first = 0 THEN 'cid:c' || k WHEN k % 5 = 1 THEN 'cid:d' || k ELSE 'nm:elsewhere ' || k || '|Far ' || k || '||no-geo' END), 20) AS golden_id, members, members AS merged,
    CASE WHEN first = 0 THEN 'ACTIVE' ELSE 'MAINTENANCE' END AS status, CASE WHEN members = 3 THEN 'status:ACTIVE:MAINTENANCE' ELSE '' END AS conflicts FROM g""")
def golden_ports(spark, sf_dir):
    """Golden chargers of these clusters: key, members, where they come from, and the conflict of status."""
    p = _ports(spark, sf_dir)
    g = fuse.golden_chargers(p.drop("k", "i"), matching.cluster_chargers(p))
    said = F.array_join(F.transform("conflicts_resolved", lambda x: F.concat_ws(":", x["field"], x["chosen"], F.array_join(x["rejected"], ","))), ";")
    return g.select("cluster", "golden_id", "members", F.size("merged_from").cast("long").alias("merged"), "status", said.alias("conflicts"))


@query("""SELECT o_orderkey, s_suppkey FROM orders JOIN supplier ON s_suppkey = o_custkey % 50 WHERE o_orderkey % 4 < 3""")
def best_association(spark, sf_dir):
    """Each session's charger: by charger id, by station id, by name; a session that names nothing has none."""
    k = F.col("s_suppkey")
    chargers = shaped(table(spark, sf_dir, "supplier").select(k.alias("idx"), text_of("C", k).alias("charger_id"), text_of("S", k).alias("station_id"), F.col("s_name").alias("station_name")), "charger")
    o, site = F.col("o_orderkey"), F.col("o_custkey") % 50
    names = table(spark, sf_dir, "supplier").select(k.alias("site"), "s_name")
    s = table(spark, sf_dir, "orders").select(o.alias("idx"), site.alias("site"), "o_orderkey").join(F.broadcast(names), "site", "left")
    s = shaped(s.select("idx", F.when((o % 4 == 0), text_of("c", F.col("site"))).alias("charger_id"), F.when(o % 4 == 1, text_of("s", F.col("site"))).alias("station_id"), F.when(o % 4 == 2, F.upper("s_name")).alias("station_name")), "session")
    found = matching.associate(s, "session", chargers, chargers.select("idx", F.col("idx").alias("cluster")))
    return found.select(F.col("idx").alias("o_orderkey"), F.col("cluster").alias("s_suppkey"))


# --- duplicates and golden records ----------------------------------------------------------

def _twice(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Every event as a session and once more: within a minute, under the same id later, or as another session; and their clusters."""
    s = sessions(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    e, copy, m = F.col("idx"), F.col("copy"), F.col("idx") % 3
    at = F.timestamp_micros(F.unix_micros("ts") + F.when(copy == 0, F.lit(0)).when(m == 1, F.lit(7200)).otherwise(F.lit(60)).cast("long") * 1_000_000)
    sid = F.when((copy == 1) & (m != 1), text_of("t", e)).otherwise(text_of("s", e))
    rows = shaped(s.select(
        (2 * e + copy).alias("idx"), F.lit("session").alias("record_type"), sid.alias("session_id"), text_of("d", e).alias("driver_id"), iso(at).alias("start_time"), (F.coalesce("value", F.lit(0.0)) + F.when((copy == 1) & (m == 2), 100.0 + F.coalesce("value", F.lit(0.0))).otherwise(0.0)).alias("energy_kwh"),
        provenance("cary", F.when((copy == 1) & (e % 2 == 0), F.lit("2024-03-02")).otherwise(F.lit("2024-03-01"))).alias("provenance"), quality().alias("quality")), "session")
    return rows, rows.select("idx", (F.floor(F.col("idx") / 2) % 50).cast("long").alias("cluster"))


@query("""SELECT 2 * event_id + copy AS idx, CASE WHEN event_id % 3 = 2 THEN 2 * event_id + copy ELSE 2 * event_id END AS "group", event_id % 3 = 2 OR copy = (CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END) AS survivor FROM events, (SELECT unnest([0, 1]) AS copy)""")
def session_groups(spark, sf_dir):
    """Duplicate sessions by id, or by near-equal start and energy, and the one that stays."""
    return dedup.group_sessions(*_twice(spark, sf_dir)).select("idx", "group", "survivor")


@query("""WITH s AS (SELECT event_id AS e, event_id % 3 AS m, unnest(CASE WHEN event_id % 3 = 2 THEN [0, 1] ELSE [CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END] END) AS copy FROM events)
SELECT 'ses-' || left(sha256('sid:' || CASE WHEN copy = 1 AND m <> 1 THEN 't' ELSE 's' END || e), 20) AS golden_id, CASE WHEN m = 2 THEN 1 ELSE 2 END::BIGINT AS members, CASE WHEN m = 0 THEN 2 ELSE 1 END::BIGINT AS ids, 'g' || (e % 50) AS charger_golden_id, 'S' || (e % 50) AS station_id FROM s""")
def golden_session_records(spark, sf_dir):
    rows, placed = _twice(spark, sf_dir)
    chargers = spark.range(50).select(F.col("id").alias("cluster"), text_of("g", F.col("id")).alias("golden_id"), text_of("S", F.col("id")).alias("station_id"))
    g = fuse.golden_sessions(dedup.group_sessions(rows, placed), chargers)
    return g.select("golden_id", "members", F.size("session_ids").cast("long").alias("ids"), "charger_golden_id", "station_id")


def _order_events(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders as events: three neighbours share an id, or the same words of a day."""
    k = F.col("o_orderkey")
    three = F.floor(k / 3).cast("long")
    rows = shaped(table(spark, sf_dir, "orders").select(
        k.alias("idx"), F.lit("maintenance").alias("record_type"), F.when(three % 2 == 0, text_of("E", three)).otherwise(text_of("one", k)).alias("event_id"), F.lit("2024-01-01").alias("event_date"), F.lit("FAULT").alias("event_type"), F.lit("MAJOR").alias("severity"),
        F.when(three % 2 == 0, text_of("case ", k)).otherwise(F.when(k % 3 == 0, text_of("Same  CASE ", three)).otherwise(text_of("same case: ", three))).alias("description"), provenance("contractor").alias("provenance"), quality().alias("quality")), "maintenance")
    return rows, rows.select("idx", (F.floor(F.col("idx") / 3) % 20).cast("long").alias("cluster")).where("cluster > 0")


@query("""SELECT o_orderkey AS idx, min(o_orderkey) OVER (PARTITION BY o_orderkey // 3) AS "group", o_orderkey = min(o_orderkey) OVER (PARTITION BY o_orderkey // 3) AS survivor FROM orders""")
def event_groups(spark, sf_dir):
    return dedup.group_events(*_order_events(spark, sf_dir)).select("idx", "group", "survivor")


@query("""WITH g AS (SELECT o_orderkey // 3 AS t, min(o_orderkey) AS first, count(*) AS members, arg_min(o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 9 ELSE o_orderkey % 3 END) AS second FROM orders GROUP BY 1)
SELECT first AS idx, members, 'mnt-' || left(sha256(CASE WHEN t % 2 = 0 THEN 'E' || t WHEN members = 1 THEN 'one' || first ELSE 'one' || (SELECT min(o_orderkey) FROM orders WHERE o_orderkey // 3 = t AND o_orderkey > first) END), 20) AS golden_id, CASE WHEN t % 20 > 0 THEN 'g' || (t % 20) END AS charger_golden_id FROM g""")
def golden_event_records(spark, sf_dir):
    chargers = spark.range(20).select(F.col("id").alias("cluster"), text_of("g", F.col("id")).alias("golden_id"))
    g = fuse.golden_events(dedup.group_events(*_order_events(spark, sf_dir)), chargers)
    return g.select("idx", "members", "golden_id", "charger_golden_id")


@query("""WITH d AS (SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) AS t FROM documents) SELECT min(doc_id) AS first_id, count(*) AS copies FROM d GROUP BY t HAVING count(*) > 1""")
def exact_duplicates(spark, sf_dir):
    """Documents of the same words as events of one scope: equal descriptions are one event."""
    d = table(spark, sf_dir, "documents")
    rows = shaped(d.select(F.col("doc_id").alias("idx"), F.lit("maintenance").alias("record_type"), text_of("e", F.col("doc_id")).alias("event_id"), F.coalesce("text", F.lit("")).alias("description"), provenance().alias("provenance"), quality().alias("quality")), "maintenance")
    g = dedup.group_events(rows, rows.select("idx", F.lit(0).cast("long").alias("cluster")).where("false"))
    return g.groupBy(F.col("group").alias("first_id")).agg(F.count("*").alias("copies")).where("copies > 1")


@query("""SELECT cust, idx FROM (SELECT o_custkey AS cust, o_orderkey AS idx, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def survivors(spark, sf_dir):
    none = F.lit(None).cast("string")
    rows = _order_members(spark, sf_dir).withColumns({"station_name": none, "station_id": none})
    return matching.with_survivor(rows, "cust").where("survivor").select("cust", "idx")


@query("SELECT sum(n - 1)::BIGINT AS duplicates_removed, count(*) AS groups FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)")
def duplicates_removed(spark, sf_dir):
    g = fuse.fuse(_order_members(spark, sf_dir), "cust", ["priority"])
    return g.agg(F.sum(F.col("members") - 1).alias("duplicates_removed"), F.count("*").alias("groups"))


# --- anomalies, health, reports --------------------------------------------------------------

def _golden(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Users as chargers, their events as sessions, errors as safety events and purchases as repairs."""
    s = sessions(spark, sf_dir)
    e, none = F.col("idx"), F.lit(None).cast("string")
    end = F.timestamp_micros(F.unix_micros("ts") + F.col("k") * 60_000_000)
    golden = s.select(
        e.alias("group"), F.col("user_id").alias("cluster"), e.alias("survivor_idx"), text_of("s", e).alias("session_id"), F.when(e % 100 == 0, F.array(text_of("s", e), text_of("t", e))).otherwise(F.array(text_of("s", e))).alias("session_ids"), F.lit(1).cast("long").alias("members"),
        F.col("value").alias("energy_kwh"), F.col("value").alias("peak_kw"), F.when(F.col("event_type") == "error", text_of("E", F.col("k") % 5)).alias("fault_code"), iso(F.col("ts")).alias("start_time"), iso(end).alias("end_time"), text_of("ses-", e).alias("golden_id"),
        provenance(at=iso(F.timestamp_micros(F.unix_micros("ts") + (e % 10 + 1) * 86_400_000_000))).alias("provenance"))
    events = s.where("event_type in ('error', 'purchase')").select("user_id", e, F.col("event_type").alias("kind"), "ts")
    events = events.select(F.col("user_id").alias("cluster"), F.col("idx").alias("survivor_idx"), text_of("m", F.col("idx")).alias("event_id"), iso(F.col("ts")).alias("event_date"), F.when(F.col("kind") == "error", F.lit("FAULT")).otherwise(F.lit("REPAIR")).alias("event_type"),
                           F.when(F.col("kind") == "error", F.lit("SAFETY")).otherwise(F.lit("INFO")).alias("severity"), none.alias("charger_id"))
    chargers = s.select(F.col("user_id").alias("cluster")).distinct().select("cluster", text_of("g", F.col("cluster")).alias("golden_id"), text_of("c", F.col("cluster")).alias("charger_id"), F.lit(50.0).alias("power_kw"))
    return golden, events, chargers


_RUN_SQL = "s AS (SELECT event_id AS idx, user_id, value, event_type, (props->>'$.k')::BIGINT AS k, ts::TIMESTAMP AS st, ts::TIMESTAMP + to_minutes((props->>'$.k')::BIGINT) AS et FROM events)"
_OPEN_SQL = "open AS (SELECT user_id, idx FROM s x WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM s r WHERE r.event_type = 'purchase' AND r.user_id = x.user_id AND r.st >= x.st))"
_BOTH_SQL = "both_on AS (SELECT x.user_id FROM s x JOIN s y ON x.user_id = y.user_id AND x.idx < y.idx AND x.st < y.et AND y.st < x.et WHERE coalesce(x.value, 0) >= 0.5 OR coalesce(y.value, 0) >= 0.5)"
_CODES_SQL = "codes AS (SELECT user_id, k % 5 AS code FROM s WHERE event_type = 'error' GROUP BY 1, 2 HAVING count(*) >= 2)"
_QUIET_SQL = "quiet AS (SELECT user_id, (epoch_us((SELECT max(st) FROM s)) - epoch_us(max(st))) / 86400000000.0::DOUBLE AS days FROM s GROUP BY user_id HAVING count(*) >= 3 AND (epoch_us((SELECT max(st) FROM s)) - epoch_us(max(st))) / 86400000000.0::DOUBLE >= 30)"


@query(f"""WITH {_RUN_SQL}, {_FENCE}, {_OPEN_SQL}, {_BOTH_SQL}, {_CODES_SQL}, {_QUIET_SQL}
SELECT * FROM (SELECT 'duplicate_billing' AS type, CASE WHEN coalesce(value, 0) >= 30 THEN 'CRITICAL' ELSE 'WARN' END AS severity, count(*) AS n FROM s WHERE idx % 100 = 0 GROUP BY 1, 2
UNION ALL SELECT 'energy_outlier', 'WARN', count(*) FROM s JOIN fence USING (user_id) WHERE value > fence UNION ALL SELECT 'utilization_cliff', 'CRITICAL', count(*) FROM quiet UNION ALL SELECT 'concurrent_sessions', 'CRITICAL', count(*) FROM both_on
UNION ALL SELECT 'repeated_fault_code', 'WARN', count(*) FROM codes UNION ALL SELECT 'power_over_rated', 'SAFETY', count(*) FROM s WHERE value > 50 * 1.1 UNION ALL SELECT 'unresolved_safety_event', 'SAFETY', count(*) FROM open) WHERE n > 0""")
def anomaly_counts(spark, sf_dir):
    """All seven detectors together, counted by type and severity."""
    return anomalies.detect(*_golden(spark, sf_dir)).groupBy("type", "severity").agg(F.count("*").alias("n"))


@query("SELECT 'g' || user_id AS golden_id, 's' || event_id AS session_id, 'peak ' || CASE WHEN value = floor(value) THEN value::BIGINT || '.0' ELSE value::VARCHAR END || ' kW above rated 50.0 kW' AS said FROM events WHERE value > 50 * 1.1")
def power_over_rated(spark, sf_dir):
    found = anomalies.detect(*_golden(spark, sf_dir)).where("type = 'power_over_rated'")
    return found.select("golden_id", F.get("evidence", F.lit(0)).alias("session_id"), F.regexp_replace("detail", " at .*$", "").alias("said"))


_HEALTH_SQL = f"""WITH {_RUN_SQL}, {_OPEN_SQL}, {_BOTH_SQL}, {_CODES_SQL}, {_QUIET_SQL}, p AS (SELECT (epoch_us(max(st)) - epoch_us(min(st))) // 86400000000 + 1 AS days FROM s),
l AS (SELECT user_id, list_sort(list((idx % 10 + 1)::DOUBLE)) AS v, count(*) FILTER (WHERE event_type = 'error') AS faults, max(value) AS most FROM s GROUP BY user_id),
m AS (SELECT l.user_id, faults, most, round(greatest(0, least(1, 1 - coalesce(quiet.days, 0) / p.days)), 4) AS uptime, v[greatest(1, least(len(v), round_even(0.5 * len(v), 0)::BIGINT))] AS p50, v[greatest(1, least(len(v), round_even(0.95 * len(v), 0)::BIGINT))] AS p95,
    quiet.days IS NOT NULL AS silent FROM l LEFT JOIN quiet ON quiet.user_id = l.user_id, p)
SELECT user_id AS cluster, faults, uptime::DOUBLE AS uptime, round(p50, 6) AS p50, round(p95, 6) AS p95, CASE WHEN most > 50 * 1.1 OR user_id IN (SELECT user_id FROM open) THEN 'SAFETY_REVIEW' WHEN silent THEN 'SUSPECT_OUTAGE'
    WHEN user_id IN (SELECT user_id FROM codes) OR user_id IN (SELECT user_id FROM both_on) OR uptime < 0.95 THEN 'DEGRADED' ELSE 'HEALTHY' END AS state FROM m"""


def _healthy(spark, sf_dir) -> DataFrame:
    golden, events, chargers = _golden(spark, sf_dir)
    return anomalies.with_health(chargers, golden, events, anomalies.detect(golden, events, chargers))


@query(_HEALTH_SQL)
def charger_health(spark, sf_dir):
    """Metrics and state of each charger: faults, uptime, lags and what the anomalies make of it."""
    m = F.col("metrics")
    return _healthy(spark, sf_dir).select("cluster", m["fault_recurrence_count"].alias("faults"), m["est_uptime_pct"].alias("uptime"), F.round(m["reporting_lag_p50_days"], 6).alias("p50"), F.round(m["reporting_lag_p95_days"], 6).alias("p95"), F.col("health.state").alias("state"))


@query("SELECT user_id, count(*) AS faults FROM events WHERE event_type = 'error' GROUP BY user_id HAVING count(*) >= 3")
def chronic_sites(spark, sf_dir):
    return kpis.chronic(_healthy(spark, sf_dir)).select(F.col("cluster").alias("user_id"), F.col("metrics.fault_recurrence_count").alias("faults"))


@query("SELECT min(t) AS period_start, max(t) AS period_end, ((epoch_us(max(t)) - epoch_us(min(t))) // 86400000000 + 1)::BIGINT AS days FROM (SELECT o_orderdate::TIMESTAMP AS t FROM orders UNION ALL SELECT l_shipdate::TIMESTAMP FROM lineitem)")
def observation_period(spark, sf_dir):
    found = anomalies.observation(*(table(spark, sf_dir, n).select(F.col(c).cast("timestamp").alias("t")) for n, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))))
    return found.select(F.col("p0").cast("timestamp_ntz").alias("period_start"), F.col("p1").cast("timestamp_ntz").alias("period_end"), F.col("days").cast("long").alias("days"))
