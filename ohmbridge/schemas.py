"""Struct types of the tiers. Raw values are text; validation types them."""

from __future__ import annotations

from pyspark.sql import types as T

S, D = T.StringType(), T.DoubleType()


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


ADDRESS = struct(street=S, city=S, state=S, zip=S)
PROVENANCE = struct(source=S, source_file=S, ingested_at=S, raw_ref=S)
QUALITY = struct(score=D, extraction_confidence=D, issues=T.ArrayType(S), fixes_applied=T.ArrayType(S))

#: Columns of each record type by tier; the second list holds what later stages read of the extra fields.
CORE = {
    "charger": ["charger_id", "station_id", "network", "address", "lat", "lon", "connector_type", "power_kw", "level", "status", "install_date"],
    "session": ["session_id", "charger_id", "station_id", "start_time", "end_time", "energy_kwh", "peak_kw", "duration_min", "fault_code"],
    "maintenance": ["event_id", "charger_id", "station_id", "event_date", "event_type", "severity", "description", "extracted_fields"],
}
EXTRA = {
    "charger": ["station_name", "ev_connector_types", "date_last_confirmed", "access_days_time", "ev_pricing", "ev_network", "status_code", "name", "city"],
    "session": ["station_name", "address_1", "address_2", "city", "state_province", "zip_postal_code", "nyc_station_alias", "connected_time", "disconnected_time", "connected_duration_min", "session_status", "invalidity_reason", "driver_id", "name"],
    "maintenance": ["station_name", "city", "name", "driver_id"],
}
NUMBERS = {"charger": ["power_kw", "lat", "lon"], "session": ["energy_kwh", "peak_kw", "duration_min"], "maintenance": []}
DATES = {"charger": ["install_date"], "session": [], "maintenance": ["event_date"]}
TIMES = {"charger": [], "session": ["start_time", "end_time"], "maintenance": []}
KINDS = {"charger": ["connector_type", "level", "status"], "session": [], "maintenance": ["event_type", "severity"]}
TYPES = ("charger", "session", "maintenance")


def _type(field: str, typed: tuple = ()) -> T.DataType:
    if field == "address":
        return ADDRESS
    if field == "extracted_fields":
        return T.MapType(S, S)
    return D if field in typed else S


def raw(record_type: str) -> T.StructType:
    """All values as text."""
    names = CORE[record_type] + EXTRA[record_type]
    return struct(record_type=S, **{n: _type(n) for n in names}, provenance=PROVENANCE, quality=QUALITY)


def validated(record_type: str) -> T.StructType:
    """Numbers as doubles, and beside them the raw text of values that could not be held."""
    names = CORE[record_type] + EXTRA[record_type]
    numbers = tuple(NUMBERS[record_type])
    held = [*NUMBERS[record_type], *DATES[record_type], *TIMES[record_type], *(k for k in KINDS[record_type] if k in ("level", "severity"))]
    return struct(record_type=S, **{n: _type(n, numbers) for n in names}, **{f"raw_{n}": S for n in held}, provenance=PROVENANCE, quality=QUALITY)


GEO_UNITS = T.ArrayType(struct(network=S, charging_level=S, connectors=T.MapType(S, struct(power_kw=S, port_count=T.IntegerType()))))
ANOMALY = struct(type=S, severity=S, detail=S, evidence=T.ArrayType(S))
CONFLICT = struct(field=S, chosen=S, rejected=T.ArrayType(S), rule=S)
MERGED = struct(source=S, raw_ref=S)
HEALTH = struct(state=S, since=S, evidence=T.ArrayType(S))
METRICS = struct(est_uptime_pct=D, fault_recurrence_count=T.LongType(), reporting_lag_p50_days=D, reporting_lag_p95_days=D)
