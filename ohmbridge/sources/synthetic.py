"""Messy input by rule: the same rows for the same seed, however they are partitioned.

Every choice is a hash of (row, seed, purpose), never a random stream, so that
generation is one narrow projection of spark.range(n).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmbridge.storage import write_text

# Shares of degraded rows.
BLANK, CHAOS, UNITS, EXACT, CONFLICT, LATE = 0.06, 0.35, 0.05, 0.02, 0.02, 0.04
CONFLICT_FACTOR = 1.12
# Degraded features of a registry: most names dropped, and shares of moved, contradicted, oddly dated, unit-less and repeated ones.
DROPPED, MOVED, SPAN, STATUS, DATES, NO_UNITS, TWICE = 4, 0.04, 0.01, 0.03, 0.15, 0.06, 0.02
ODD_DATES = ["2023-01-01", "1/1/23", "01.01.2023"]


def unit(seed: int, purpose: str, *of: Column) -> Column:
    """A number from 0 to 1."""
    return F.pmod(F.xxhash64(*of, F.lit(seed), F.lit(purpose)), F.lit(1 << 30)) / float(1 << 30)


def pick(seed: int, purpose: str, values: list[str], *of: Column) -> Column:
    return F.get(F.array(*(F.lit(v) for v in values)), F.floor(unit(seed, purpose, *of) * len(values)).cast("int"))


def box_sessions(spark: SparkSession, n: int, seed: int = 1, boxes: int | None = None, degrade: bool = True) -> DataFrame:
    """Rows of layout B, with dates in four forms, blank cells, wrong units, and repeated and conflicting rows."""
    boxes = boxes or max(1, n // 60)
    base = spark.range(n).withColumnRenamed("id", "i")
    u = lambda p: unit(seed, p, F.col("i"))
    box = F.floor(u("box") * boxes).cast("long")
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.floor(u("day") * 500).cast("int"))
    second = F.floor(u("second") * 86_000).cast("int")
    kwh = F.round(2 + 28 * u("kwh"), 3)
    rows = base.select("i", box.alias("b"), day.alias("d"), second.alias("s"), kwh.alias("e"), F.floor(20 + 200 * u("minutes")).cast("int").alias("m"))
    if degrade:
        again = F.when(u("again") < EXACT, F.array(F.lit(0), F.lit(1))).when(u("again") < EXACT + CONFLICT, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
        rows = rows.withColumn("copy", F.explode(again))
    else:
        rows = rows.withColumn("copy", F.lit(0))
    e = F.when(F.col("copy") == 2, F.round(F.col("e") * CONFLICT_FACTOR, 3)).otherwise(F.col("e"))
    blank = lambda p, c: F.when((unit(seed, p, F.col("i")) < BLANK) & F.lit(degrade), F.lit("")).otherwise(c)
    chaos = F.when(~F.lit(degrade) | (unit(seed, "chaos", F.col("i")) >= CHAOS), F.date_format("d", "MM/dd/yyyy"))
    form = F.floor(unit(seed, "form", F.col("i")) * 3)
    chaos = chaos.when(form == 0, F.date_format("d", "M/d/yy")).when(form == 1, F.date_format("d", "yyyy-MM-dd")).otherwise(F.date_format("d", "M/d/yyyy"))
    clock = F.format_string("%02d:%02d:%02d", (F.col("s") / 3600).cast("int"), (F.col("s") / 60).cast("int") % 60, F.col("s") % 60)
    big = F.when((unit(seed, "units", F.col("i")) < UNITS) & F.lit(degrade), F.round(e * 1000, 1)).otherwise(e)
    return rows.select(
        chaos.alias("Date"), F.concat(F.lit("A"), F.col("b") % 97).alias("Station Name"), F.concat(F.lit("Garage "), F.floor(F.col("b") / 4)).alias("Location Name"), F.concat(F.lit("EVB-"), F.col("b")).alias("Charge Box ID"),
        (1 + F.col("b") % 2).cast("string").alias("Connector ID"), blank("driver", F.concat(F.lit("D"), F.floor(unit(seed, "driver", F.col("i")) * n))).alias("Driver ID"), clock.alias("Connected Time"), F.lit("").alias("Disconnected Time"),
        blank("minutes", F.col("m").cast("string")).alias("Charge Duration (min)"), F.col("m").cast("string").alias("Connected Duration (min)"), blank("kwh", big.cast("string")).alias("Energy Provided (kWh)"), F.lit("VALID").alias("Session Status"), F.lit("NULL").alias("Invalidity Reason"),
    )


def late_part(rows: DataFrame, seed: int, share: float = LATE) -> DataFrame:
    """The rows that arrive late: a share by hash."""
    return rows.where(F.pmod(F.xxhash64(*rows.columns, F.lit(seed)), F.lit(10_000)) < int(share * 10_000))


def stations(spark: SparkSession, n: int, seed: int = 1, degrade: bool = True) -> DataFrame:
    """Registry features as the GeoJSON scan gives them (file, type, coordinates, props), with one to four ports each."""
    i = F.col("id")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    units = text('[{"network":"N","charging_level":"2","connectors":{"J1772":{"power_kw":"7.2","port_count":', 1 + i % 4, "}}}]")
    props = {
        "id": text(i), "station_name": text("Garage ", i), "street_address": text(i % 900, " Oak Ave"), "city": F.lit("Cary"), "state": F.lit("NC"), "zip": F.lit("27511"), "ev_network": F.lit("N"),
        "status_code": pick(seed, "status", ["E", "E", "E", "T"], i), "open_date": text(1_500_000_000_000 + F.floor(unit(seed, "open", i) * 2000).cast("long") * 86_400_000), "ev_connector_types": F.lit("J1772"), "ev_charging_units": units,
    }
    at = lambda p, base: F.format_string("%.6f", base + 2 * unit(seed, p, i))
    rows = spark.range(n).select(F.lit("stations.geojson").alias("file"), F.lit("Point").alias("type"), F.array(at("lon", -80.0), at("lat", 35.0)).alias("coordinates"), F.create_map(*(c for k, v in props.items() for c in (F.lit(k), v))).alias("props"))
    return degrade_features(rows, seed) if degrade else rows


def degrade_features(features: DataFrame, seed: int = 1) -> DataFrame:
    """Features with names dropped, points moved, the other status, dates in other forms, no units, and some repeated.

    Choices hash the feature itself: equal features are degraded alike.
    """
    u = lambda p: unit(seed, p, F.col("__key"))
    names = F.array_sort(F.map_keys("props"))
    chosen = F.array_compact(F.array(*(F.when(F.floor(u("drops") * (DROPPED + 1)) > k, F.get(names, F.floor(u(f"drop{k}") * F.size(names)).cast("int"))) for k in range(DROPPED))))
    kept = F.map_filter("props", lambda k, v: ~F.array_contains("__chosen", k) & ~((k == "ev_charging_units") & (u("units") < NO_UNITS)))
    value = lambda k, v: (
        F.when((k == "status_code") & v.isin("E", "T") & (u("status") < STATUS), F.when(v == "E", "T").otherwise("E"))
        .when((k == "open_date") & (u("dates") < DATES), F.coalesce(F.nullif(pick(seed, "form", [*ODD_DATES, ""], F.col("__key")), F.lit("")), v)).otherwise(v)
    )
    point = (F.col("type") == "Point") & (u("moved") < MOVED) & (F.size("coordinates") >= 2)
    moved = F.transform("coordinates", lambda c, k: F.when(k < 2, (c.try_cast("double") + SPAN * (2 * F.when(k == 0, u("x")).otherwise(u("y")) - 1)).cast("string")).otherwise(c))
    keyed = features.withColumn("__key", F.xxhash64("file", F.to_json(F.struct("type", "coordinates", "props")))).withColumn("__chosen", chosen)
    out = keyed.withColumns({"props": F.transform_values(kept, value), "coordinates": F.when(point, moved).otherwise(F.col("coordinates"))})
    return out.withColumn("__copy", F.explode(F.when(u("twice") < TWICE, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select(*features.columns)


def write_features(features: DataFrame, path: str) -> None:
    """One GeoJSON file, a feature a line, written as rows come; units are JSON in it, other values text."""
    def parts():
        yield '{"type":"FeatureCollection","features":['
        for n, r in enumerate(features.toLocalIterator()):
            props = {k: json.loads(v) if k == "ev_charging_units" and v else v for k, v in r.props.items()}
            point = [float(c) for c in r.coordinates or []]
            yield (",\n" if n else "\n") + json.dumps({"type": "Feature", "geometry": {"type": r.type, "coordinates": point}, "properties": props})
        yield "\n]}\n"

    write_text(features.sparkSession, path, parts())


STATIONS = ["Court Square", "Bay Garage", "Town Hall", "North Deck", "River Lot"]
FAULTS = ["breaker trip", "comms dropout", "display flicker", "cable insulation cracked", "gfci fault"]


def reports(spark: SparkSession, n: int, seed: int = 1, lines: int = 20) -> DataFrame:
    """(file, text): digests of ``lines`` entries, mails and inspection forms."""
    i = F.col("i")
    day = lambda p: F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), F.floor(unit(seed, p, i) * 500).cast("int")), "dd.MM.yyyy")
    entry = lambda k: F.concat(pick(seed, "st", STATIONS, i, k), F.lit(" :: "), pick(seed, "fa", FAULTS, i, k), F.lit(" :: count="), F.floor(unit(seed, "c", i, k) * 9).cast("string"), F.lit(" :: sev="), pick(seed, "sv", ["major", "minor", "safety"], i, k))
    digest = F.concat(F.lit("FAULT DIGEST\nperiod ending: "), day("d"), F.lit("\n"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(lines)), entry), "\n"))
    mail = F.concat(F.lit("Sent: "), day("m"), F.lit("\nStation: "), pick(seed, "ms", STATIONS, i), F.lit("\nSeverity: "), pick(seed, "mv", ["urgent-safety", "major", "fyi"], i), F.lit("\nThe "), pick(seed, "mf", FAULTS, i), F.lit(" at box EVB-"), F.floor(unit(seed, "mb", i) * 100).cast("string"))
    form = F.concat(F.lit("Quarterly Inspection Form\ninsp.date : "), day("f"), F.lit("\nsite/station....... "), pick(seed, "fs", STATIONS, i), F.lit("\nseverity code [minor]"))
    kind = F.floor(unit(seed, "kind", i) * 3)
    name = F.concat(F.lit("r"), i, F.when(kind == 0, F.lit("_fault")).when(kind == 1, F.lit("_email")).otherwise(F.lit("_inspection")), F.lit(".txt"))
    return spark.range(n).withColumnRenamed("id", "i").select(name.alias("file"), F.when(kind == 0, digest).when(kind == 1, mail).otherwise(form).alias("text"))


def write_boxes(rows: DataFrame, path: str) -> None:
    """Layout B as comma-separated files with headers."""
    rows.write.mode("overwrite").option("header", True).option("quoteAll", True).option("emptyValue", "").csv(path)
