"""The rule catalog: enums, synonyms, thresholds, rules and weights, as data.

``catalog(override)`` gives the catalog with an override merged in: mappings
merge, anything else replaces. The catalog is compiled to Column expressions by
operators.rules and operators.standardise.
"""

from __future__ import annotations

import copy
import json

# The enums, synonyms, thresholds and weights that results depend on.
ENUMS = {
    "connector_type": ["J1772", "CCS", "CHAdeMO", "NACS", "OTHER"],
    "level": ["L1", "L2", "DCFC"],
    "status": ["ACTIVE", "INACTIVE", "MAINTENANCE", "UNKNOWN"],
    "event_type": ["INSPECTION", "REPAIR", "FAULT", "INSTALL", "COMPLAINT", "OTHER"],
    "severity": ["INFO", "MINOR", "MAJOR", "SAFETY"],
}
SYNONYMS = {
    "connector_type": {
        "J1772": ["j1772", "j-1772", "j 1772", "sae", "sae j1772", "type 1", "type1"],
        "CCS": ["ccs", "ccs1", "ccs2", "combo", "sae combo", "combined"],
        "CHAdeMO": ["chademo", "chg", "chgpt", "chg pt"],
        "NACS": ["nacs", "tesla", "tp"],
    },
    "level": {
        "L1": ["l1", "lv1", "lvl1", "level 1", "level-1", "120v", "120 v", "110v", "110 v"],
        "L2": ["l2", "lv2", "lvl2", "level 2", "level-2", "240v", "240 v", "208v", "208 v"],
        "DCFC": ["dcfc", "dc fast", "dc-fast", "level 3", "level-3", "l3", "lvl3", "fast", "dc"],
    },
    "status": {
        "ACTIVE": ["active", "available", "online", "in service", "operational", "open", "working"],
        "INACTIVE": ["inactive", "offline", "out of service", "removed", "unavailable", "not available", "closed"],
        "MAINTENANCE": ["maintenance", "under maintenance", "in maintenance", "repair", "servicing"],
        "UNKNOWN": ["unknown", "n/a", "na", "tbd", "unspecified", "none"],
    },
    "event_type": {
        "INSPECTION": ["inspection", "inspected", "site visit", "visit", "check"],
        "REPAIR": ["repair", "repaired", "fix", "fixed", "replaced", "replacement"],
        "FAULT": ["fault", "failure", "failed", "error", "malfunction", "breaker", "trip", "alarm"],
        "INSTALL": ["install", "installed", "installation", "commissioning"],
        "COMPLAINT": ["complaint", "complain", "customer", "ticket"],
        "OTHER": [],
    },
    "severity": {
        "SAFETY": ["safety", "urgent-safety", "critical", "dangerous", "hazard", "unsafe"],
        "MAJOR": ["major", "high", "serious", "urgent"],
        "MINOR": ["minor", "low", "slight", "cosmetic"],
        "INFO": ["info", "informational", "fyi", "note", "notice"],
    },
}
FALLBACKS = {"connector_type": "OTHER", "status": "UNKNOWN", "event_type": "OTHER"}
STATE_CODES = {
    "north carolina": "NC", "new york": "NY", "new jersey": "NJ", "california": "CA", "texas": "TX", "florida": "FL", "virginia": "VA",
    "south carolina": "SC", "georgia": "GA", "pennsylvania": "PA", "massachusetts": "MA", "illinois": "IL", "ohio": "OH", "maryland": "MD",
}

# Matching and dedup thresholds.
MATCH = {"geo_km": 0.2, "strong_name_km": 0.25, "name": 0.85, "strong_name": 0.92, "geo_name": 0.70}
DUPLICATE = {"start_s": 300.0, "energy_abs": 0.25, "energy_rel": 0.04, "duration_rel": 0.05}
# Anomalies, health, reports.
ANOMALY = {"cliff_days": 30.0, "cliff_sessions": 3, "concurrent_kwh": 0.5, "billing_kwh": 30.0, "over_rated": 1.1}
UPTIME_FLOOR = 0.95
CHRONIC_FAULTS = 3
SEVERITY_ORDER = ["SAFETY", "CRITICAL", "WARN", "INFO"]
HEALTH_ORDER = ["SAFETY_REVIEW", "SUSPECT_OUTAGE", "DEGRADED", "HEALTHY"]
# How far a source is trusted, by what its name contains; the first tier that fits holds.
SOURCE_TIERS = [
    ["afdc", "bts", "nrel", "dot", "alternative fuels"],
    ["cary", "town of cary", "municipal", "open data"],
    ["contractor", "report", "synthetic", "email", "digest"],
]


# Required fields, and the rules in the order of a record's issues, under the public keys of the catalog.
REQUIRED_FIELDS = {
    "charger": ["provenance.source", "provenance.source_file", "provenance.ingested_at"],
    "session": ["provenance.source", "provenance.source_file", "provenance.ingested_at"],
    "maintenance": ["event_id", "description", "provenance.source", "provenance.source_file", "provenance.ingested_at"],
}
RULES = [
    {"id": "required", "check": "required", "severity": "MAJOR"},
    {"id": "invalid_energy_kwh", "check": "numeric", "record_type": "session", "field": "energy_kwh", "severity": "MAJOR"},
    {"id": "invalid_peak_kw", "check": "numeric", "record_type": "session", "field": "peak_kw", "severity": "MAJOR"},
    {"id": "invalid_duration_min", "check": "numeric", "record_type": "session", "field": "duration_min", "severity": "MAJOR"},
    {"id": "invalid_power_kw", "check": "numeric", "record_type": "charger", "field": "power_kw", "severity": "MAJOR"},
    {"id": "invalid_latitude", "check": "numeric", "record_type": "charger", "field": "lat", "severity": "MAJOR"},
    {"id": "invalid_longitude", "check": "numeric", "record_type": "charger", "field": "lon", "severity": "MAJOR"},
    {"id": "impossible_energy_kwh", "check": "range", "record_type": "session", "field": "energy_kwh", "min": 0, "severity": "MAJOR"},
    {"id": "impossible_peak_kw", "check": "range", "record_type": "session", "field": "peak_kw", "min": 0, "severity": "MAJOR"},
    {"id": "impossible_duration", "check": "range", "record_type": "session", "field": "duration_min", "min": 0, "severity": "MAJOR"},
    {"id": "impossible_power_kw", "check": "range", "record_type": "charger", "field": "power_kw", "min": 0, "severity": "MAJOR"},
    {"id": "power_kw_out_of_range", "check": "range", "record_type": "charger", "field": "power_kw", "max": 400, "severity": "MAJOR"},
    {"id": "coordinate_out_of_range", "check": "range", "record_type": "charger", "field": "lat", "min": -90, "max": 90, "severity": "MAJOR"},
    {"id": "coordinate_out_of_range", "check": "range", "record_type": "charger", "field": "lon", "min": -180, "max": 180, "severity": "MAJOR"},
    {"id": "outside_territory", "check": "bbox", "record_type": "charger", "severity": "MAJOR"},
    {"id": "end_before_start", "check": "order", "record_type": "session", "earlier": "start_time", "later": "end_time", "severity": "MAJOR"},
    {"id": "duration_mismatch", "check": "duration_matches", "record_type": "session", "tolerance_min": 5, "severity": "MINOR"},
    {"id": "stale_report", "check": "stale", "severity": "MINOR"},
    {"id": "invalid_connector_type", "check": "enum", "record_type": "charger", "field": "connector_type", "severity": "MINOR"},
    {"id": "invalid_level", "check": "enum", "record_type": "charger", "field": "level", "severity": "MINOR"},
    {"id": "invalid_status", "check": "enum", "record_type": "charger", "field": "status", "severity": "MINOR"},
    {"id": "invalid_event_type", "check": "enum", "record_type": "maintenance", "field": "event_type", "severity": "MINOR"},
    {"id": "invalid_severity", "check": "enum", "record_type": "maintenance", "field": "severity", "severity": "MINOR"},
    {"id": "invalid_install_date", "check": "date", "record_type": "charger", "field": "install_date", "severity": "MINOR"},
    {"id": "invalid_start_time", "check": "datetime", "record_type": "session", "field": "start_time", "severity": "MINOR"},
    {"id": "invalid_end_time", "check": "datetime", "record_type": "session", "field": "end_time", "severity": "MINOR"},
    {"id": "invalid_event_date", "check": "date", "record_type": "maintenance", "field": "event_date", "severity": "MINOR"},
    {"id": "invalid_ingested_at", "check": "datetime", "field": "provenance.ingested_at", "severity": "MINOR"},
]
DEFAULT = {
    "version": 1,
    "territory": {"name": "north_carolina_default", "bbox": {"min_lat": 33.7, "max_lat": 36.6, "min_lon": -84.4, "max_lon": -75.4}},
    "enums": ENUMS,
    "stale": {"max_days": 7},
    "unit_repair": {
        "power_kw": {"watts_if_above": 400, "max_plausible": 400000},
        "peak_kw": {"watts_if_above": 400, "max_plausible": 400000},
        "energy_kwh": {"wh_if_above": 1000, "max_plausible": 1000000},
    },
    "derive": {"level_from_power_kw": {"L1_max_kw": 1.9, "L2_max_kw": 19.2}, "duration_tolerance_min": 5},
    "standardize": {"default_timezone": "America/New_York"},
    "synonyms": SYNONYMS,
    "fallbacks": FALLBACKS,
    "required_fields": REQUIRED_FIELDS,
    "rules": RULES,
    "scoring": {"weights": {"SAFETY": 0.5, "MAJOR": 0.25, "MINOR": 0.1, "INFO": 0.02}, "default_weight": 0.1, "quarantine_below": 0.4, "round_digits": 4},
}
#: Keys that a rule may have.
RULE_KEYS = {"id", "check", "severity", "record_type", "field", "min", "max", "earlier", "later", "tolerance_min", "enum", "as", "happened", "seen", "lat", "lon", "box"}


def merged(base: dict, override: dict) -> dict:
    out = dict(base)
    for k, v in override.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def catalog(override: dict | str | None = None) -> dict:
    """The catalog; ``override`` is a mapping or the path of a JSON or YAML file."""
    if isinstance(override, str):
        with open(override, encoding="utf-8") as f:
            text = f.read()
        try:
            override = json.loads(text)
        except ValueError:
            import yaml

            override = yaml.safe_load(text) or {}
    return merged(copy.deepcopy(DEFAULT), override or {})


def _unknown(given: dict, known: dict, path: str = "") -> list[str]:
    """Keys of an override that no part of the catalog reads; names of fields, enums and members are free."""
    out = []
    for k, v in given.items():
        here = f"{path}{k}"
        if k not in known and path.rstrip(".") not in ("enums", "synonyms", "fallbacks", "required_fields", "unit_repair", "scoring.weights") and not path.startswith(("synonyms.", "unit_repair.")):
            out.append(f"unknown key: {here}")
        elif isinstance(v, dict) and isinstance(known.get(k), dict):
            out += _unknown(v, known[k], here + ".")
    return out


def problems(cat: dict) -> list[str]:
    """What is wrong with a catalog, before any record is read."""
    weights = cat["scoring"]["weights"]
    out = _unknown(cat, DEFAULT)
    out += [f"rule {r.get('id')}: no {k}" for r in cat["rules"] for k in ("id", "check", "severity") if not r.get(k)]
    out += [f"rule {r.get('id')}: unknown key {k}" for r in cat["rules"] for k in r if k not in RULE_KEYS]
    out += [f"rule {r.get('id')}: unknown severity {r['severity']}" for r in cat["rules"] if r.get("severity") and r["severity"] not in weights]
    out += [f"synonyms of {f}: {name} is no member" for f, table in cat["synonyms"].items() for name in table if name not in cat["enums"].get(f, [])]
    box = cat["territory"]["bbox"]
    out += ["territory: bounds are reversed"] if box["min_lat"] > box["max_lat"] or box["min_lon"] > box["max_lon"] else []
    out += [f"weight {k}: not from 0 to 1" for k, v in weights.items() if not 0 <= v <= 1]
    return out
