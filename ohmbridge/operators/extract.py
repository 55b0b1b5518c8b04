"""Free-text reports to maintenance events, as Column expressions.

A fault digest gives one event per entry line; any other report gives one event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmbridge.functions import text

# Patterns by which reports are read.
SINGLE_FORMS = r"(?i)install completion report|quarterly inspection form|customer complaint via 311"
DIGEST_HEADER = r"(?i)fault\s+digest"
DIGEST_ENTRY = r"(?i)^\s*(.+?)\s*::\s*(.+?)(?:\s*::\s*count=(\d+))?(?:\s*::\s*sev=([A-Za-z!]+))?\s*$"
NOTE_LINE = r"(?im)^\s*NOTE\b.*$"
#: The complaint line's number by itself; not within other digits, nor on a line that names a station or an address.
LINE_311 = r"(?im)^(?!.*(?:station\s*:|site/station\.{3,}|commissioned at|location given:|addr on file:)).*?(?<!\d)311(?!\d)"
EVENT_TYPES = [
    (r"(?i)install completion|commissioned|energized", "INSTALL"),
    (r"(?i)inspection form|insp\.", "INSPECTION"),
    (r"(?i)complaint via 311", "COMPLAINT"),
    (LINE_311, "COMPLAINT"),
    (r"(?i)fault digest", "FAULT"),
    (r"(?i)breaker trip|comms dropout|overtemp|display flicker|unit resets?|ground fault|gfci|fault", "FAULT"),
    (r"(?i)latch broken|cable insulation cracked|cable too short|wont reset|won't reset|screen dead|beeping", "REPAIR"),
]
FILE_HINTS = [(r"_fault\.|^fault", "FAULT"), (r"_install\.|^install", "INSTALL"), (r"_inspection\.|^inspection", "INSPECTION"), (r"_complaint\.|^complaint", "COMPLAINT")]
SEVERITIES = [(r"(?i)safety|urgent", "SAFETY"), (r"(?i)major", "MAJOR"), (r"(?i)minor", "MINOR"), (r"(?i)fyi|routine|info", "INFO")]
SEVERITY_LABEL = r"(?i)(?:severity\s*:\s*|severity\s*code\s*\[?|priority\s*:\s*|sev\s*=\s*)([A-Za-z!-]+)"
DATE_LABELS = [
    r"(?im)period\s+ending\s*[:]?\s*(\S+.*)$", r"(?im)^sent\s*:\s*(.+)$", r"(?im)insp\.date\s*:\s*(.+)$", r"(?im)logged\s+(.+?)\s*$",
    r"(?im)^\s*(\d{1,2}[/.]\d{1,2}[/.]\d{2,4})\s*\|",
]
ANY_DATE = r"\b(\d{1,2}[./-]\d{1,2}[./-]\d{2,4}|\d{4}-\d{1,2}-\d{1,2}|[A-Z][a-z]{2,9}\s+\d{1,2},?\s+\d{4})\b"
STATIONS = [r"(?im)station\s*:\s*(.+?)\s*$", r"(?im)site/station\.{3,}\s*(.+?)\s*$", r"(?im)new unit commissioned at\s*(.+?)\s*$"]
LABELS = {
    "routed_to": r"(?im)routed\s+to:\s*(.+?)\s*$",
    "technician": r"(?im)technician\s*:\s*(.+?)\s*$",
    "crew": r"(?im)crew\s*:\s*(.+?)\s*$",
    "punch_list": r"(?im)punch\s*list\s*:\s*(.+?)\s*$",
    "followup": r"(?im)followup\s*req'?d\s*:\s*(.+?)\s*$",
    "billing_starts": r"(?im)billing\s*starts\s*(.+?)\s*$",
    "nameplate": r"(?im)nameplate\s*:\s*(.+?)\s*$",
    "address": r"(?im)addr on file:\s*(.+?)\s*$",
    "location": r"(?im)location given:\s*\"?(.+?)\"?\s*$",
}
RATINGS = [
    r"(?i)(?:nameplate|charger\s*rating|rating)\s*:?\s*([\d.]+\s*(?:kW|W|MW)(?:\s*DCFC)?|L1|L2|DCFC|L2 dual port|dual\s+J1772|dual port)",
    r"(?i)rated\s*([\d.]+\s*(?:kW|W|MW)(?:\s*DCFC)?|L1|L2|DCFC|level\s*\d)",
]
# Confidence by how many of station, date, severity and type were found.
CONFIDENCE = [0.4, 0.5, 0.65, 0.8, 0.9]
STRUCTURED_BONUS, STRUCTURED_MOST = 0.05, 0.95


def unquoted(c: Column) -> Column:
    """Trimmed, outer quotes taken off, trimmed; null if nothing is left."""
    return text.filled(F.trim(F.regexp_replace(F.trim(c), '^"+|"+$', "")))


def pick(c: Column, patterns: list[str]) -> Column:
    """What the first pattern that matches captures."""
    return F.coalesce(*(unquoted(F.regexp_extract(c, p, 1)) for p in patterns))


def severity(c: Column) -> Column:
    return text.ordered_case(c, SEVERITIES)


def event_type(c: Column, file_name: Column) -> Column:
    return F.coalesce(text.ordered_case(c, EVENT_TYPES), text.ordered_case(F.lower(file_name), FILE_HINTS), F.lit("OTHER"))


def report_date(c: Column) -> Column:
    """The labelled date, else the first that looks like one; verbatim."""
    return F.coalesce(pick(c, DATE_LABELS), unquoted(F.regexp_extract(c, ANY_DATE, 1)))


def labelled(c: Column) -> Column:
    pairs = F.create_map(*(x for k, p in LABELS.items() for x in (F.lit(k), unquoted(F.regexp_extract(c, p, 1)))))
    return F.map_filter(pairs, lambda k, v: v.isNotNull())


def confidence(station: Column, date: Column, sev: Column, structured: Column) -> Column:
    found = sum((F.when(x, 1).otherwise(0) for x in (station, date, sev)), F.lit(1))
    base = F.get(F.array(*(F.lit(x) for x in CONFIDENCE)), found)
    return F.round(F.when(structured, F.least(F.lit(STRUCTURED_MOST), base + STRUCTURED_BONUS)).otherwise(base), 2)


def _with(fields: Column, key: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.map_concat(F.map_filter(fields, lambda k, v: k != key), F.create_map(F.lit(key), value))).otherwise(fields)


def events(reports: DataFrame) -> DataFrame:
    """From (file, text), one row per event: file, index, event_id, event_date, event_type, severity, station_name, description, extracted_fields, confidence."""
    t = F.coalesce("text", F.lit(""))
    base = reports.select("file", t.alias("t")).withColumns({"lines": F.filter(F.transform(F.split("t", r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike(DIGEST_HEADER) & ~x.rlike(NOTE_LINE) & x.contains("::"))})
    base = base.withColumns({"digest": F.col("t").rlike(DIGEST_HEADER) & (F.size("lines") > 0), "date": report_date(F.col("t")), "labels": labelled(F.col("t"))})
    note = unquoted(F.regexp_replace(F.regexp_extract(F.col("t"), NOTE_LINE, 0), r"^\s*NOTE[: ]*", ""))
    d = base.where("digest").select("file", "t", "date", _with(F.col("labels"), "notes", note).alias("labels"), F.posexplode("lines").alias("index", "line"))
    part = lambda k: text.filled(F.regexp_extract("line", DIGEST_ENTRY, k))
    d = d.withColumns({"station": part(1), "desc": part(2), "count": part(3), "sev": part(4)}).where("station is not null")
    d = d.withColumn("severity", F.coalesce(severity(F.col("sev")), severity(F.col("t"))))
    digest = d.select(
        "file", "index", text.sha1_id("maint-", F.col("file"), F.col("index").cast("string"), F.col("station"), sep="#").alias("event_id"), F.col("date").alias("event_date"), F.lit("FAULT").alias("event_type"), "severity",
        unquoted(F.col("station")).alias("station_name"), F.coalesce(unquoted(F.col("desc")), F.trim("t")).alias("description"), _with(F.col("labels"), "count", F.col("count")).alias("extracted_fields"),
        confidence(F.lit(True), F.col("date").isNotNull(), F.col("severity").isNotNull(), F.lit(True)).alias("confidence"),
    )
    s = base.where("not digest").withColumns({
        "structured": F.col("t").rlike(SINGLE_FORMS) | F.col("t").rlike(DIGEST_HEADER),
        "station": F.coalesce(pick(F.col("t"), STATIONS), F.try_element_at("labels", F.lit("address")), F.try_element_at("labels", F.lit("location"))),
        "severity": F.coalesce(severity(unquoted(F.regexp_extract("t", SEVERITY_LABEL, 1))), severity(F.col("t"))),
        "rating": pick(F.col("t"), RATINGS),
    })
    single = s.select(
        "file", F.lit(0).alias("index"), text.sha1_id("maint-", F.col("file"), F.lit("0"), F.coalesce("station", F.lit("")), sep="#").alias("event_id"), F.col("date").alias("event_date"), event_type(F.col("t"), F.col("file")).alias("event_type"), "severity",
        F.col("station").alias("station_name"), F.trim(F.regexp_replace("t", r"^\s+|\s+$", "")).alias("description"), _with(F.col("labels"), "power_rating", F.col("rating")).alias("extracted_fields"),
        confidence(F.col("station").isNotNull(), F.col("structured") | F.col("date").isNotNull(), F.col("severity").isNotNull(), F.col("structured")).alias("confidence"),
    )
    return digest.unionByName(single)


EVENT_SCHEMA = "file string, index int, event_id string, event_date string, event_type string, severity string, station_name string, description string, extracted_fields map<string,string>, confidence double"


def events_by(reports: DataFrame, parse) -> DataFrame:
    """Events by an outside parser, with ``issues``; the patterns above take over where it fails.

    ``parse(text, file)`` gives a list of mappings with event_date, event_type,
    severity, station_name, description, extracted_fields and confidence. It runs
    on executors, a batch of reports at a time. A report on which it raises, or of
    which it gives nothing usable, is read by events() and marked llm_fallback.
    """
    import hashlib

    import pandas as pd

    types, severities = {"INSPECTION", "REPAIR", "FAULT", "INSTALL", "COMPLAINT", "OTHER"}, {"INFO", "MINOR", "MAJOR", "SAFETY"}
    columns = [c.split(" ")[0] for c in EVENT_SCHEMA.replace("map<string,string>", "map").split(", ")]

    def run(batches):
        for pdf in batches:
            out = []
            for file, said in zip(pdf["file"], pdf["text"], strict=True):
                try:
                    found = [e for e in parse(said or "", file) if e.get("description")]
                except Exception:
                    found = []
                for i, e in enumerate(found):
                    key = f"{file}#{i}#{e.get('station_name') or ''}"
                    out.append([file, i, "maint-" + hashlib.sha1(key.encode()).hexdigest()[:12], e.get("event_date"), e["event_type"] if e.get("event_type") in types else "OTHER", e["severity"] if e.get("severity") in severities else None,
                                e.get("station_name"), e["description"], {k: str(v) for k, v in (e.get("extracted_fields") or {}).items()}, float(e.get("confidence", 0.5))])
            yield pd.DataFrame(out, columns=columns)

    from ohmbridge.storage import materialize

    # the parser is costly and may not say the same thing twice: its answers are written once
    good = materialize(reports.select("file", "text").mapInPandas(run, EVENT_SCHEMA), "parsed-events")
    rest = events(reports.join(good.select("file").distinct(), "file", "left_anti"))
    none = F.array().cast("array<string>")
    return good.withColumn("issues", none).unionByName(rest.withColumn("issues", F.array(F.lit("llm_fallback"))))
