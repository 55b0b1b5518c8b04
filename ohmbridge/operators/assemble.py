"""Raw rows to canonical records: fields are placed, values stay verbatim text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmbridge import schemas
from ohmbridge.functions import text

#: Names of the feeds, and the network of boxes that only sessions name.
SESSION_SOURCE, BOX_SOURCE, REGISTRY_SOURCE, REPORT_SOURCE = "cary", "nyc_dot", "afdc", "contractor"
BOX_NETWORK = "NYC DOT Municipal"
REGISTRY_EXTRAS = ["station_name", "ev_connector_types", "date_last_confirmed", "access_days_time", "ev_pricing", "ev_network", "status_code"]


def _cell(df: DataFrame, name: str, trim: bool = False) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    c = F.col(f"`{name}`").cast("string")
    return text.filled(F.trim(c) if trim else c)


def _provenance(source: str, ref: Column, at: str) -> Column:
    return F.struct(F.lit(source).alias("source"), F.col("file").alias("source_file"), F.lit(at).alias("ingested_at"), ref.alias("raw_ref"))


def _quality(score: Column, issues: Column | None = None) -> Column:
    none = F.array().cast("array<string>")
    return F.struct(score.cast("double").alias("score"), F.lit(None).cast("double").alias("extraction_confidence"), (issues if issues is not None else none).alias("issues"), none.alias("fixes_applied"))


def _shaped(df: DataFrame, kind: str) -> DataFrame:
    out = df
    for f in schemas.raw(kind).fields:
        if f.name not in df.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out.select(*(f.name for f in schemas.raw(kind).fields))


def sessions_plain(rows: DataFrame, at: str) -> DataFrame:
    """Layout A. ``rows``: file, n (row number within the file), issues and the header's columns."""
    g = lambda c: _cell(rows, c)
    score = F.when(F.size("issues") > 0, 0.7).otherwise(1.0)
    out = rows.select(
        F.lit("session").alias("record_type"), text.sha1_id("cary-", F.col("file"), F.col("n").cast("string")).alias("session_id"), g("start_date").alias("start_time"), g("energy_kwh").alias("energy_kwh"), g("charging_time_hh_mm_ss").alias("duration_min"),
        *(g(c).alias(c) for c in ("station_name", "address_1", "address_2", "city", "state_province", "zip_postal_code")),
        _provenance(SESSION_SOURCE, F.concat(F.lit("line:"), "n"), at).alias("provenance"), _quality(score, F.col("issues")).alias("quality"))
    return _shaped(out, "session")


def sessions_box(rows: DataFrame, at: str) -> DataFrame:
    """Layout B: a start date and time in two columns, no end date; the literal text NULL stays."""
    g = lambda c: _cell(rows, c, trim=True)
    date, start, box, port = g("Date"), g("Connected Time"), g("Charge Box ID"), g("Connector ID")
    score = F.when(F.size("issues") > 0, 0.7).otherwise(1.0)
    out = rows.select(
        F.lit("session").alias("record_type"), text.sha1_id("nyc-", F.col("file"), F.col("n").cast("string")).alias("session_id"),
        F.when(box.isNotNull(), F.concat_ws(":", box, port)).alias("charger_id"), box.alias("station_id"), F.when(date.isNotNull(), F.concat_ws(" ", date, start)).alias("start_time"),
        g("Energy Provided (kWh)").alias("energy_kwh"), g("Charge Duration (min)").alias("duration_min"), g("Location Name").alias("station_name"), g("Station Name").alias("nyc_station_alias"), start.alias("connected_time"), g("Disconnected Time").alias("disconnected_time"),
        g("Connected Duration (min)").alias("connected_duration_min"), g("Session Status").alias("session_status"), g("Invalidity Reason").alias("invalidity_reason"), g("Driver ID").alias("driver_id"),
        _provenance(BOX_SOURCE, F.concat(F.lit("line:"), "n"), at).alias("provenance"), _quality(score, F.col("issues")).alias("quality"))
    return _shaped(out, "session")


def box_chargers(sessions: DataFrame) -> DataFrame:
    """A charger for each box of each file, from the first session that names it."""
    line = F.regexp_extract("provenance.raw_ref", r"(\d+)$", 1).try_cast("long")
    kept = F.struct("station_id", "station_name", "provenance")
    first = sessions.where("charger_id is not null").groupBy(F.col("provenance.source_file").alias("file"), "charger_id").agg(F.min_by(kept, F.coalesce(line, F.lit(0))).alias("s"))
    out = first.select(F.lit("charger").alias("record_type"), "charger_id", "s.station_id", F.lit(BOX_NETWORK).alias("network"), "s.station_name", "s.provenance", _quality(F.lit(1.0)).alias("quality"))
    return _shaped(out, "charger")


def ports(features: DataFrame, at: str) -> DataFrame:
    """A charger for each physical port of each feature.

    ``features``: file, type (of geometry), coordinates (array of text) and props
    (map of text). Without usable units there is one record with the raw list of
    connectors and no charger_id.
    """
    p = lambda k: F.try_element_at("props", F.lit(k))
    units = F.coalesce(F.from_json(p("ev_charging_units"), schemas.GEO_UNITS), F.array().cast(schemas.GEO_UNITS))
    units = F.filter(units, lambda u: u.isNotNull())
    point = F.col("type") == "Point"
    base = features.select(
        "file", p("id").alias("station_id"), p("ev_network").alias("feature_network"), units.alias("units"), *(p(c).alias(c) for c in REGISTRY_EXTRAS),
        F.struct(p("street_address").alias("street"), p("city").alias("city"), p("state").alias("state"), p("zip").alias("zip")).alias("address"),
        F.when(point, F.get("coordinates", F.lit(1))).alias("lat"), F.when(point, F.get("coordinates", F.lit(0))).alias("lon"), p("status_code").alias("status"), p("open_date").alias("install_date"),
    )
    base = base.withColumn("address", F.when(F.coalesce(*(F.col(f"address.{x}") for x in schemas.ADDRESS.names)).isNotNull(), F.col("address")))
    shared = ["file", "station_id", "address", "lat", "lon", "status", "install_date", *REGISTRY_EXTRAS]
    unit = base.where(F.size("units") > 0).select(*shared, "feature_network", F.posexplode("units").alias("u", "unit"))
    conn = unit.select(*shared, "u", F.coalesce("unit.network", "feature_network").alias("network"), F.col("unit.charging_level").alias("level"), F.explode("unit.connectors").alias("connector_type", "c"))
    count = F.coalesce("c.port_count", F.lit(0))
    port = conn.where(count > 0).select(*shared, "u", "network", "level", "connector_type", F.col("c.power_kw").alias("power_kw"), F.explode(F.sequence(F.lit(0), count - 1)).alias("port"))
    port = port.withColumn("charger_id", F.when(F.col("station_id").isNotNull(), F.concat_ws("#", "station_id", "u", "connector_type", "port")))
    none = F.lit(None).cast("string")
    bare = base.where(F.size("units") == 0).select(*shared, F.col("feature_network").alias("network"), none.alias("level"), F.col("ev_connector_types").alias("connector_type"), none.alias("power_kw"), none.alias("charger_id"))
    both = port.drop("u", "port").unionByName(bare)
    ref = F.concat(F.lit("feature:"), "station_id")
    return _shaped(both.withColumns({"record_type": F.lit("charger"), "provenance": _provenance(REGISTRY_SOURCE, ref, at), "quality": _quality(F.lit(1.0))}), "charger")


def maintenance(found: DataFrame, at: str) -> DataFrame:
    """Records of what operators.extract found; ``issues`` of the finder go with them."""
    issues = F.col("issues") if "issues" in found.columns else None
    out = found.withColumns({"record_type": F.lit("maintenance"), "provenance": _provenance(REPORT_SOURCE, F.col("file"), at), "quality": _quality(F.col("confidence"), issues)})
    return _shaped(out, "maintenance")
