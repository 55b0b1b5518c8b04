"""The rule engine: catalog rules compiled to one Column that lists a record's issue codes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ohmbridge.functions import geo, time

#: Text that Python and Spark read alike as a finite number.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(c: Column) -> Column:
    """The finite double of a text or number, else null."""
    text = c.cast("string")
    value = F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def field(path: str) -> Column:
    return F.col(path)


def _issue(code: str, broken: Column) -> Column:
    return F.when(F.coalesce(broken, F.lit(False)), F.lit(code))


def required(cat: dict, rule: dict, kind: str) -> list[Column]:
    return [_issue("missing_" + p.replace(".", "_"), field(p).isNull()) for p in cat["required_fields"].get(kind, [])]


def numeric(cat: dict, rule: dict, kind: str) -> list[Column]:
    c = field(rule["field"])
    return [_issue(rule["id"], c.isNotNull() & number(c).isNull())]


def in_range(cat: dict, rule: dict, kind: str) -> list[Column]:
    c = number(field(rule["field"]))
    low = c < rule["min"] if "min" in rule else F.lit(False)
    high = c > rule["max"] if "max" in rule else F.lit(False)
    return [_issue(rule["id"], low | high)]


def enum(cat: dict, rule: dict, kind: str) -> list[Column]:
    c = field(rule["field"])
    members = cat["enums"].get(rule.get("enum", rule["field"]), [])
    return [_issue(rule["id"], c.isNotNull() & ~c.isin(members))]


def date(cat: dict, rule: dict, kind: str) -> list[Column]:
    return [_issue(rule["id"], ~field(rule["field"]).rlike(time.ISO_DATE))]


def datetime(cat: dict, rule: dict, kind: str) -> list[Column]:
    return [_issue(rule["id"], ~field(rule["field"]).rlike(time.ISO_INSTANT))]


def _at(c: Column, dtype: str | None) -> Column:
    return c if dtype == "timestamp" else time.instant(c)


def order(cat: dict, rule: dict, kind: str) -> list[Column]:
    kind_of = rule.get("as")
    return [_issue(rule["id"], _at(field(rule["later"]), kind_of) <= _at(field(rule["earlier"]), kind_of))]


def duration_matches(cat: dict, rule: dict, kind: str) -> list[Column]:
    start, end = time.instant(field("start_time")), time.instant(field("end_time"))
    off = F.abs(number(field("duration_min")) - time.minutes_between(start, end)) > rule.get("tolerance_min", cat["derive"]["duration_tolerance_min"])
    return [_issue(rule["id"], (end > start) & off)]


def bbox(cat: dict, rule: dict, kind: str) -> list[Column]:
    lat, lon = number(field(rule.get("lat", "lat"))), number(field(rule.get("lon", "lon")))
    return [_issue(rule["id"], ~geo.in_box(lat, lon, rule.get("box", cat["territory"]["bbox"])))]


def stale(cat: dict, rule: dict, kind: str) -> list[Column]:
    if "happened" in rule:
        happened, seen = _at(field(rule["happened"]), rule.get("as")), _at(field(rule["seen"]), rule.get("as"))
    elif kind == "session":
        happened, seen = F.coalesce(time.instant(field("end_time")), time.instant(field("start_time"))), time.instant(field("provenance.ingested_at"))
    elif kind == "maintenance":
        happened, seen = time.instant(field("event_date")), time.instant(field("provenance.ingested_at"))
    else:
        return []
    return [_issue(rule["id"], F.unix_micros(seen) - F.unix_micros(happened) > int(cat["stale"]["max_days"]) * 86_400_000_000)]


#: New checks are registered here: (catalog, rule, record type) to a code-or-null Column for each issue.
CHECKS: dict[str, Callable[[dict, dict, str], list[Column]]] = {
    "required": required, "numeric": numeric, "range": in_range, "enum": enum, "date": date, "datetime": datetime,
    "order": order, "duration_matches": duration_matches, "bbox": bbox, "stale": stale,
}


def issues(cat: dict, kind: str) -> Column:
    """Codes of all rules that a record breaks, in catalog order; an unknown check is an error."""
    found = []
    for rule in cat["rules"]:
        if rule.get("record_type") in (None, kind):
            if rule["check"] not in CHECKS:
                raise KeyError(f"unknown check: {rule['check']}")
            found += CHECKS[rule["check"]](cat, rule, kind)
    if not found:
        return F.array().cast("array<string>")
    # joined, as a lambda's input would be interpreted, and each instant in it read again for every rule
    said = F.concat_ws("\u0001", *found)
    return F.when(said == "", F.array().cast("array<string>")).otherwise(F.split(said, "\u0001"))


def severity_weights(cat: dict) -> dict[str, float]:
    """Weight of each code; the first rule of a code counts. Missing fields weigh as the required rule."""
    weights, default = cat["scoring"]["weights"], cat["scoring"]["default_weight"]
    out: dict[str, float] = {}
    for rule in cat["rules"]:
        if rule["check"] == "required":
            for paths in cat["required_fields"].values():
                for p in paths:
                    out.setdefault("missing_" + p.replace(".", "_"), weights.get(rule["severity"], default))
        out.setdefault(rule["id"], weights.get(rule["severity"], default))
    return out


def score(codes: Column, confidence: Column, cat: dict) -> Column:
    """Confidence (1 if unknown) less the weight of each distinct code, from 0 to 1, rounded."""
    weights = severity_weights(cat)
    pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
    table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
    total = F.aggregate(F.array_distinct(codes), F.lit(0.0), lambda acc, x: acc + F.coalesce(F.try_element_at(table, x), F.lit(float(cat["scoring"]["default_weight"]))))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(confidence, F.lit(1.0)) - total)), int(cat["scoring"]["round_digits"]))


def quarantined(s: Column, cat: dict) -> Column:
    return s < float(cat["scoring"]["quarantine_below"])
