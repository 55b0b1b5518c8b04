"""Per-record standardisation and repair: narrow projections, no shuffle.

``clean(df, kind, catalog)`` takes raw records of one type and gives validated
ones. What was changed is listed in quality.fixes_applied as
``action:field:old→new`` with plain text values.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ohmbridge import config, schemas
from ohmbridge.functions import text, time
from ohmbridge.operators import rules

#: Short texts whose white space is collapsed.
SHORT = ("charger_id", "station_id", "network", "session_id", "fault_code", "event_id", "event_type", "severity", "connector_type", "level", "status", "city")
#: Issue codes whose field goes to raw_<field>.
STASHED = {
    "invalid_energy_kwh": "energy_kwh", "invalid_peak_kw": "peak_kw", "invalid_duration_min": "duration_min", "invalid_power_kw": "power_kw",
    "invalid_latitude": "lat", "invalid_longitude": "lon", "invalid_install_date": "install_date", "invalid_start_time": "start_time",
    "invalid_end_time": "end_time", "invalid_event_date": "event_date", "invalid_level": "level", "invalid_severity": "severity",
}


def match_enum(value: Column, table: dict[str, list[str]]) -> Column:
    """The first enum, in table order, one of whose synonyms stands as a word in the text."""
    low = text.collapse(F.lower(value))
    found = []
    for name, synonyms in table.items():
        if synonyms:
            words = "|".join(re.escape(" ".join(s.lower().split())) for s in sorted(synonyms, key=len, reverse=True))
            found.append((rf"(?<![a-z0-9])(?:{words})(?![a-z0-9])", name))
    return time.let(low, lambda x: text.ordered_case(x, found)) if found else F.lit(None).cast("string")


def repair_unit(value: Column, unit: dict) -> Column:
    """A value above the threshold, up to what is plausible, is in the thousandth unit."""
    above = unit["watts_if_above"] if "watts_if_above" in unit else unit["wh_if_above"]
    return F.when((value > above) & (value <= unit["max_plausible"]), value / 1000.0).otherwise(value)


def level_of(power: Column, cat: dict) -> Column:
    most = cat["derive"]["level_from_power_kw"]
    return F.when(power <= most["L1_max_kw"], F.lit("L1")).when(power <= most["L2_max_kw"], F.lit("L2")).when(power.isNotNull(), F.lit("DCFC"))


def zip5(value: Column) -> Column:
    return text.filled(F.regexp_extract(value, r"\b(\d{5})\b", 1))


def state_code(value: Column) -> Column:
    table = F.create_map(*(x for k, v in config.STATE_CODES.items() for x in (F.lit(k), F.lit(v))))
    return time.let(text.collapse(value), lambda plain: F.coalesce(F.try_element_at(table, F.lower(plain)), F.when(plain.rlike("^[A-Za-z]{2}$"), F.upper(plain)), plain))


class _Fixes:
    """Collects, for one projection, the new values and the texts of what they change."""

    def __init__(self):
        self.values: dict[str, Column] = {}
        self.notes: list[Column] = []
        self.made: dict[str, Column] = {}

    def once(self, value: Column) -> Column:
        """A value that several others are made of: a column of a projection below, so that it is computed once for a row."""
        name = f"__once{len(self.made)}"
        self.made[name] = value
        return F.col(name)

    def set(self, name: str, new: Column, action: str, old: Column | None = None) -> None:
        old, new = F.col(name) if old is None else old, self.once(new)
        self.values[name] = new
        self.note(name, old, new, action)

    def note(self, name: str, old: Column, new: Column, action: str) -> None:
        show = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
        self.notes.append(F.when(~old.cast("string").eqNullSafe(new.cast("string")), F.concat(F.lit(f"{action}:{name}:"), show(old), F.lit("→"), show(new))))

    def apply(self, df: DataFrame) -> DataFrame:
        notes = F.concat("__fixes", F.filter(F.array(*self.notes), lambda x: x.isNotNull())) if self.notes else F.col("__fixes")
        return df.withColumns(self.made).withColumns({**self.values, "__fixes": notes}).drop(*self.made)


def _trim(df: DataFrame, kind: str) -> DataFrame:
    """White space. A blank value stays as it is."""
    fixes = _Fixes()
    keep = lambda c: F.when(text.collapse(c) == "", c).otherwise(text.collapse(c))
    for name in SHORT:
        if name in df.columns:
            fixes.set(name, keep(F.col(name)), "trim")
    if kind == "charger":
        parts = {p: fixes.once(keep(F.col(f"address.{p}"))) for p in ("street", "city", "state", "zip")}
        for p, new in parts.items():
            fixes.note(f"address.{p}", F.col(f"address.{p}"), new, "trim")
        fixes.values["address"] = F.when(F.col("address").isNotNull(), F.struct(*(new.alias(p) for p, new in parts.items())))
    if kind == "maintenance":
        fixes.set("description", F.trim(F.regexp_replace("description", r"^\s+|\s+$", "")), "trim")
    prov = {p: fixes.once(text.collapse(F.col(f"provenance.{p}"))) for p in ("source", "source_file", "raw_ref")}
    for p, new in prov.items():
        fixes.note(f"provenance.{p}", F.col(f"provenance.{p}"), new, "trim")
    fixes.values["provenance"] = F.when(F.col("provenance").isNotNull(), F.struct(prov["source"].alias("source"), prov["source_file"].alias("source_file"), F.col("provenance.ingested_at").alias("ingested_at"), prov["raw_ref"].alias("raw_ref")))
    return fixes.apply(df)


def _values(df: DataFrame, kind: str, cat: dict) -> DataFrame:
    fixes = _Fixes()
    if kind == "charger":
        z, s = F.col("address.zip"), F.col("address.state")
        new_zip = fixes.once(F.when(F.trim(z) != "", zip5(z)).otherwise(z))
        new_state = fixes.once(state_code(s))
        fixes.note("address.zip", z, new_zip, "zip")
        fixes.note("address.state", s, new_state, "case")
        fixes.values["address"] = F.when(F.col("address").isNotNull(), F.struct(F.col("address.street").alias("street"), F.col("address.city").alias("city"), new_state.alias("state"), new_zip.alias("zip")))
    for name in schemas.NUMBERS[kind]:
        old, value = F.col(name), fixes.once(rules.number(F.col(name)))
        unit = cat["unit_repair"].get(name)
        new = repair_unit(value, unit) if unit else value
        # the text stays where there is no number, for the rules to flag
        fixes.values[name] = F.when(value.isNull(), old).otherwise(new.cast("string"))
        if unit:
            fixes.note(name, value, new, "unit_repair")
    for name in schemas.DATES[kind]:
        old = F.col(name)
        fixes.set(name, F.coalesce(F.substring(time.lenient(old, cat["standardize"]["default_timezone"]), 1, 10), old), "date")
    for name in schemas.TIMES[kind]:
        old = F.col(name)
        fixes.set(name, F.coalesce(time.lenient(old, cat["standardize"]["default_timezone"]), old), "date")
    for name in schemas.KINDS[kind]:
        old = F.col(name)
        new = F.coalesce(match_enum(old, cat["synonyms"].get(name, {})), F.lit(cat["fallbacks"].get(name)), old)
        fixes.set(name, F.when(F.trim(old) != "", new).otherwise(old), "enum")
    seen = fixes.once(F.coalesce(time.lenient(F.col("provenance.ingested_at"), cat["standardize"]["default_timezone"]), F.col("provenance.ingested_at")))
    fixes.note("provenance.ingested_at", F.col("provenance.ingested_at"), seen, "date")
    fixes.values["provenance"] = F.when(F.col("provenance").isNotNull(), F.col("provenance").withField("ingested_at", seen))
    return fixes.apply(df)


def computed_minutes() -> Column:
    start, end = time.instant(F.col("start_time")), time.instant(F.col("end_time"))
    return F.when(end > start, F.round(time.minutes_between(start, end), 2))


def _derive(df: DataFrame, kind: str, cat: dict) -> DataFrame:
    fixes = _Fixes()
    if kind == "session":
        df = df.withColumn("__made", computed_minutes())
        had, made = rules.number(F.col("duration_min")), F.col("__made")
        wrong = F.abs(had - made) > cat["derive"]["duration_tolerance_min"]
        new = F.when(F.col("duration_min").isNull(), made.cast("string")).when(wrong, made.cast("string")).otherwise(F.col("duration_min"))
        fixes.set("duration_min", new, "derive")
    elif kind == "charger":
        power = rules.number(F.col("power_kw"))
        fixes.set("level", F.coalesce(F.col("level"), level_of(power, cat)), "derive")
    return fixes.apply(df).drop("__made")


def _repaired(df: DataFrame, kind: str, cat: dict, repair) -> DataFrame:
    """Values of enum fields that no synonym resolved, as ``repair`` reads them; what is no member is not taken."""
    def reader(field: str, members: list[str]):
        def read(values: pd.Series) -> pd.Series:
            return pd.Series([repair(field, v, members) if v is not None else None for v in values], dtype=object)

        return F.pandas_udf(read, T.StringType())

    fixes = _Fixes()
    for name in schemas.KINDS[kind]:
        members = cat["enums"][name]
        old = F.col(name)
        said = reader(name, members)(F.when(old.isNotNull() & ~old.isin(members), old))
        fixes.set(name, F.when(said.isin(members), said).otherwise(old), "repair")
    return fixes.apply(df)


def clean(df: DataFrame, kind: str, cat: dict | None = None, repair=None) -> DataFrame:
    """Raw records of one type to validated records: standardise, derive, judge, stash, score.

    Adds ``quarantined`` (boolean); nothing is dropped. Columns beyond the raw
    schema pass through, and missing ones count as null. ``repair(field, value,
    members)`` may name a member for an enum value that no synonym resolves.
    """
    cat = cat or config.catalog()
    have = set(df.columns)
    for f in schemas.raw(kind).fields:
        if f.name not in have:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    df = df.withColumn("__fixes", F.array().cast("array<string>"))
    df = _derive(_values(_trim(df, kind), kind, cat), kind, cat)
    if repair is not None and schemas.KINDS[kind]:
        df = _repaired(df, kind, cat, repair)
    df = df.withColumn("__issues", rules.issues(cat, kind))
    codes = F.col("__issues")
    confidence = F.when(F.abs("quality.score") < float("inf"), F.col("quality.score"))
    out = df.withColumn("__score", rules.score(codes, confidence, cat))
    moved = {}
    for code, name in STASHED.items():
        if name in schemas.CORE[kind]:
            bad = F.array_contains(codes, code)
            moved[f"raw_{name}"] = F.when(bad, F.col(name))
            kept = F.when(~bad, F.col(name))
            moved[name] = rules.number(kept) if name in schemas.NUMBERS[kind] else kept
    complete = F.col("provenance.source").isNotNull() & F.col("provenance.source_file").isNotNull() & F.col("provenance.ingested_at").isNotNull()
    if kind == "maintenance":
        complete = complete & F.col("event_id").isNotNull() & F.col("description").isNotNull()
    all_codes = F.when(F.coalesce(complete, F.lit(False)), codes).otherwise(F.concat(codes, F.array(F.lit("model_validation_failed"))))
    fixes = F.concat(F.coalesce("quality.fixes_applied", F.array().cast("array<string>")), F.col("__fixes"))
    quality = F.struct(F.col("__score").alias("score"), F.round(confidence, int(cat["scoring"]["round_digits"])).alias("extraction_confidence"), all_codes.alias("issues"), fixes.alias("fixes_applied"))
    return out.withColumns({**moved, "quality": quality, "quarantined": rules.quarantined(F.col("__score"), cat)}).drop("__fixes", "__issues", "__score")


def validation_report(records: DataFrame) -> DataFrame:
    """Per source and issue code, per source (code null) and per code (source null): records and mean score.

    ``records``: source, score, issues of all validated records. Explode comes
    after the partial aggregation's inputs are pruned to three columns.
    """
    source = F.coalesce("source", F.lit("unknown")).alias("source")
    base = records.select(source, "score", "issues")
    per_source = base.groupBy("source").agg(F.lit(None).cast("string").alias("issue"), F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("avg_score"))
    codes = base.select("source", F.explode("issues").alias("issue")).groupingSets([["source", "issue"], ["issue"]], "source", "issue").agg(F.count("*").alias("n")).withColumn("avg_score", F.lit(None).cast("double"))
    return per_source.unionByName(codes)
