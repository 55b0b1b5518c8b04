"""Anomalies as a long table, reliability metrics and health states.

Each detector gives (target, key, golden_id, rule, ord, type, severity, detail,
evidence): target says whether it belongs to a charger (key: cluster) or a
session (key: group). The generic detectors take column names, so that they run
on any table of the same shape.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmbridge import config
from ohmbridge.functions import stats, text, time
from ohmbridge.storage import materialize

A = config.ANOMALY


def fences(rows: DataFrame, by: str, value: str) -> DataFrame:
    """(by, fence): the upper outlier fence of each group that has one."""
    return stats.upper_fences(rows, by, value)


def silent_groups(rows: DataFrame, by: str, at: str, end: Column, days: float = A["cliff_days"], least: int = A["cliff_sessions"]) -> DataFrame:
    """(by, n, last_at, silent_days): groups of ``least`` dated rows that have been silent for ``days`` at ``end``."""
    g = rows.where(F.col(at).isNotNull()).groupBy(by).agg(F.count("*").alias("n"), F.max(at).alias("last_at"))
    silent = (F.unix_micros(end) - F.unix_micros("last_at")) / F.lit(86_400_000_000.0)
    return g.withColumn("silent_days", silent).where((F.col("n") >= least) & (F.col("silent_days") >= days))


def overlaps(rows: DataFrame, by: str, idx: str, start: str, end: str, carry: list[str], residual: Column | None = None, bin_s: int = 86_400) -> DataFrame:
    """Pairs x, y (x before y by idx) of a group whose intervals overlap.

    Each interval is dealt to the day bins that it touches, an equi-join on
    (group, bin); a pair is taken in the bin of its later start, so once.
    """
    s, e = F.unix_micros(start) / 1_000_000, F.unix_micros(end) / 1_000_000
    # an empty or negative interval can still lie within another
    low, high = F.least(s, e), F.greatest(s, e)
    cut = rows.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumns({"__low": low, "__s": F.floor(low / bin_s), "__bin": F.explode(F.sequence(F.floor(low / bin_s), F.floor(high / bin_s)))})
    names = [idx, start, end, "__s", *carry]
    x = cut.select(by, "__bin", *(F.col(c).alias(f"x_{c}") for c in names))
    y = cut.select(by, "__bin", *(F.col(c).alias(f"y_{c}") for c in names))
    hit = (F.col(f"x_{idx}") < F.col(f"y_{idx}")) & (F.col(f"x_{start}") < F.col(f"y_{end}")) & (F.col(f"y_{start}") < F.col(f"x_{end}")) & (F.col("__bin") == F.greatest("x___s", "y___s"))
    out = x.join(y, [by, "__bin"]).where(hit)
    if residual is not None:
        out = out.where(residual)
    return out.drop("__bin", "x___s", "y___s")


def unresolved(events: DataFrame, repairs: DataFrame, by: str, at: str, port: str | None = None) -> DataFrame:
    """Events with no repair of their group at the same time or later, on the same port if the event names one."""
    r = repairs.select(F.col(by).alias("__by"), F.col(at).alias("__at"), *([F.col(port).alias("__port")] if port else []))
    cond = (F.col(by) == F.col("__by")) & (F.col("__at") >= F.col(at))
    if port:
        cond = cond & (text.filled(F.col(port)).isNull() | F.col("__port").eqNullSafe(F.col(port)))
    return events.where(F.col(at).isNotNull()).join(r, cond, "left_anti")


def repeated(rows: DataFrame, by: str, code: str, item: str, order: str, least: int = 2) -> DataFrame:
    """(by, code, n, items, first): codes that occur ``least`` times in a group, with their items in order."""
    g = rows.where(text.filled(F.col(code)).isNotNull()).groupBy(by, code).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).alias("i")))).alias("__i"), F.min(order).alias("first"))
    return g.where(F.col("n") >= least).select(by, code, "n", F.transform("__i", lambda x: x["i"]).alias("items"), "first")


def detect(sessions: DataFrame, events: DataFrame, chargers: DataFrame) -> DataFrame:
    """All anomalies of golden sessions and chargers.

    A charger without sessions has no anomalies. Rules come in the order of the
    ``rule`` number, within it by record.
    """
    s = sessions.select("group", "cluster", "survivor_idx", "session_id", "session_ids", "members", "energy_kwh", "peak_kw", "fault_code", "start_time", "end_time", F.col("golden_id").alias("gid")).withColumns({"st": time.instant(F.col("start_time")), "et": time.instant(F.col("end_time"))})
    e = events.select("cluster", "survivor_idx", "event_id", "event_date", "event_type", "severity", "charger_id").withColumn("at", time.instant(F.col("event_date")))
    # seven rules read them: their instants are read from text once
    s, e = materialize(s, "dated-sessions"), materialize(e, "dated-events")
    c = chargers.select("cluster", F.col("golden_id").alias("cgid"), F.col("charger_id").alias("cid"), "power_kw")
    known = s.where("cluster is not null")

    def rows(df: DataFrame, target: str, key: str, gid: Column, rule: int, ord_: Column, kind: str, severity: Column, detail: Column, evidence: Column) -> DataFrame:
        return df.select(F.lit(target).alias("target"), F.col(key).alias("key"), gid.alias("golden_id"), F.lit(rule).alias("rule"), ord_.cast("long").alias("ord"), F.lit(kind).alias("type"), severity.alias("severity"), detail.alias("detail"), F.filter(evidence, lambda x: x.isNotNull()).alias("evidence"))

    num = lambda c: F.format_string("%.2f", c)
    one = lambda name: F.array(F.col(name))
    out = rows(s.where(F.size("session_ids") > 1), "session", "group", F.col("gid"), 0, F.col("survivor_idx"), "duplicate_billing",
               F.when(F.coalesce("energy_kwh", F.lit(0.0)) >= A["billing_kwh"], F.lit("CRITICAL")).otherwise(F.lit("WARN")),
               F.concat(F.lit("billed twice: "), F.size("session_ids"), F.lit(" session ids ("), F.array_join("session_ids", ", "), F.lit(") are one session")), F.col("session_ids"))
    over = known.join(fences(known, "cluster", "energy_kwh"), "cluster").join(c, "cluster").where("energy_kwh > fence")
    out = out.unionByName(rows(over, "session", "group", F.col("gid"), 1, F.col("survivor_idx"), "energy_outlier", F.lit("WARN"), F.concat(F.lit("energy "), num("energy_kwh"), F.lit(" kWh above the fence of "), num("fence"), F.lit(" kWh for "), "cgid"), one("session_id")))
    period = s.select(F.max("st").alias("m")).unionByName(e.select(F.max("at").alias("m"))).agg(F.max("m").alias("period_end"))
    last = known.where("st is not null").groupBy("cluster").agg(F.max_by("session_id", F.struct("st", "survivor_idx")).alias("last_id"))
    quiet = _silent(known, period)
    why = e.where(F.col("severity").isin("MAJOR", "SAFETY")).select(F.col("cluster").alias("__c"), "at")
    quiet = quiet.join(why, (F.col("cluster") == F.col("__c")) & (F.col("at") > F.col("last_at")), "left_anti").join(last, "cluster").join(c, "cluster")
    out = out.unionByName(rows(quiet, "charger", "cluster", F.col("cgid"), 2, F.lit(0), "utilization_cliff", F.lit("CRITICAL"), F.concat(F.lit("no sessions for "), F.floor("silent_days").cast("string"), F.lit(" days (last session "), F.date_format(F.to_utc_timestamp("last_at", F.current_timezone()), "yyyy-MM-dd"), F.lit(") after "), "n", F.lit(" sessions")), one("last_id")))
    floor = A["concurrent_kwh"]
    both = overlaps(known, "cluster", "survivor_idx", "st", "et", ["session_id", "energy_kwh", "start_time", "end_time"], (F.coalesce("x_energy_kwh", F.lit(0.0)) >= floor) | (F.coalesce("y_energy_kwh", F.lit(0.0)) >= floor)).join(c, "cluster")
    out = out.unionByName(rows(both, "charger", "cluster", F.col("cgid"), 3, F.col("x_survivor_idx"), "concurrent_sessions", F.lit("CRITICAL"), F.concat(F.lit("sessions overlap on "), F.coalesce("cid", "cgid"), F.lit(": "), "x_start_time", F.lit("-"), "x_end_time", F.lit(" and "), "y_start_time", F.lit("-"), "y_end_time"), F.array("x_session_id", "y_session_id")))
    codes = repeated(known, "cluster", "fault_code", "session_id", "survivor_idx").join(c, "cluster")
    out = out.unionByName(rows(codes, "charger", "cluster", F.col("cgid"), 4, F.col("first"), "repeated_fault_code", F.lit("WARN"), F.concat(F.lit("fault code "), "fault_code", F.lit(" on "), "n", F.lit(" sessions of "), "cgid"), F.col("items")))
    hot = known.join(c.where("power_kw <> 0"), "cluster").where(F.col("peak_kw") > F.col("power_kw") * A["over_rated"])
    out = out.unionByName(rows(hot, "charger", "cluster", F.col("cgid"), 5, F.col("survivor_idx"), "power_over_rated", F.lit("SAFETY"), F.concat(F.lit("peak "), "peak_kw", F.lit(" kW above rated "), "power_kw", F.lit(" kW at "), F.coalesce("start_time", F.lit("unknown time"))), one("session_id")))
    active = known.select("cluster").distinct()
    safety = e.where("severity = 'SAFETY'").join(active, "cluster", "left_semi")
    open_ = unresolved(safety, e.where("event_type = 'REPAIR'"), "cluster", "at", "charger_id").join(c, "cluster")
    return out.unionByName(rows(open_, "charger", "cluster", F.col("cgid"), 6, F.col("survivor_idx"), "unresolved_safety_event", F.lit("SAFETY"), F.concat(F.lit("event "), "event_id", F.lit(" ("), "event_date", F.lit(") has no later repair on "), "cgid"), one("event_id")))


def _silent(known: DataFrame, period: DataFrame) -> DataFrame:
    g = known.where("st is not null").groupBy("cluster").agg(F.count("*").alias("n"), F.max("st").alias("last_at")).crossJoin(F.broadcast(period))
    silent = (F.unix_micros("period_end") - F.unix_micros("last_at")) / F.lit(86_400_000_000.0)
    return g.withColumn("silent_days", silent).where((F.col("n") >= A["cliff_sessions"]) & (F.col("silent_days") >= A["cliff_days"])).drop("period_end")


def observation(*times: DataFrame) -> DataFrame:
    """One row: the first and last time ``t`` of all frames, p0 and p1, and the days from one to the other, both counted."""
    parts = [d.agg(F.min("t").alias("a"), F.max("t").alias("b")) for d in times]
    ends = reduce(DataFrame.unionByName, parts).agg(F.min("a").alias("p0"), F.max("b").alias("p1"))
    return ends.withColumn("days", F.floor((F.unix_micros("p1") - F.unix_micros("p0")) / F.lit(86_400_000_000.0)) + 1)


def health_state(types: Column, uptime: Column) -> Column:
    """The first state whose condition holds."""
    has = lambda *t: F.arrays_overlap(types, F.array(*(F.lit(x) for x in t)))
    degraded = has("repeated_fault_code", "energy_outlier", "concurrent_sessions", "duplicate_billing") | F.coalesce(uptime < config.UPTIME_FLOOR, F.lit(False))
    return F.when(has("unresolved_safety_event", "power_over_rated"), F.lit("SAFETY_REVIEW")).when(has("utilization_cliff"), F.lit("SUSPECT_OUTAGE")).when(degraded, F.lit("DEGRADED")).otherwise(F.lit("HEALTHY"))


DECIDING = {
    "SAFETY_REVIEW": ("unresolved_safety_event", "power_over_rated"),
    "SUSPECT_OUTAGE": ("utilization_cliff",),
    "DEGRADED": ("repeated_fault_code", "energy_outlier", "concurrent_sessions", "duplicate_billing"),
}


def with_health(chargers: DataFrame, sessions: DataFrame, events: DataFrame, found: DataFrame) -> DataFrame:
    """Golden chargers with anomalies, metrics and health."""
    s = sessions.select("cluster", "fault_code", F.col("provenance.ingested_at").alias("seen"), "start_time").withColumn("st", time.instant(F.col("start_time")))
    known = s.where("cluster is not null")
    lag = time.lag_days(time.instant(F.col("seen")), F.col("st"))
    m = known.groupBy("cluster").agg(F.count_if(text.filled(F.col("fault_code")).isNotNull()).alias("faults"))
    m = m.join(lag_percentiles(known.withColumn("lag", lag), "cluster", "lag"), "cluster", "left")
    ends = observation(s.select(F.col("st").alias("t")), events.select(time.instant(F.col("event_date")).alias("t")))
    why = events.where(F.col("severity").isin("MAJOR", "SAFETY")).select(F.col("cluster").alias("__c"), time.instant(F.col("event_date")).alias("at"))
    quiet = _silent(known, ends.select(F.col("p1").alias("period_end"))).join(why, (F.col("cluster") == F.col("__c")) & (F.col("at") > F.col("last_at")), "left_anti").select("cluster", "silent_days")
    m = m.join(quiet, "cluster", "left").crossJoin(F.broadcast(ends))
    uptime = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - F.coalesce("silent_days", F.lit(0.0)) / F.greatest("days", F.lit(1)))), 4)
    m = m.select("cluster", "faults", F.when(F.col("p0").isNotNull(), uptime).alias("uptime"), "p50", "p95")
    own = found.where("target = 'charger'").groupBy(F.col("key").alias("cluster")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rule", "ord", "detail", "type", "severity", "evidence"))), lambda x: F.struct(x["type"].alias("type"), x["severity"].alias("severity"), x["detail"].alias("detail"), x["evidence"].alias("evidence"))).alias("anomalies"))
    out = chargers.join(m, "cluster", "left").join(own, "cluster", "left")
    empty = F.array().cast("array<struct<type:string,severity:string,detail:string,evidence:array<string>>>")
    out = out.withColumn("anomalies", F.coalesce("anomalies", empty))
    out = out.withColumn("__state", health_state(F.transform("anomalies", lambda a: a["type"]), F.col("uptime")))
    decide = F.create_map(*(x for k, v in DECIDING.items() for x in (F.lit(k), F.array(*(F.lit(t) for t in v)))))
    details = F.transform(F.filter("anomalies", lambda a: F.array_contains(F.coalesce(F.try_element_at(decide, F.col("__state")), F.array().cast("array<string>")), a["type"])), lambda a: a["detail"])
    since = F.array_min(F.flatten(F.transform(details, lambda d: F.regexp_extract_all(d, F.lit(r"(\d{4}-\d{2}-\d{2})"), F.lit(1)))))
    health = F.struct(F.col("__state").alias("state"), since.alias("since"), details.alias("evidence"))
    metrics = F.struct(F.col("uptime").alias("est_uptime_pct"), F.coalesce("faults", F.lit(0)).cast("long").alias("fault_recurrence_count"), F.col("p50").alias("reporting_lag_p50_days"), F.col("p95").alias("reporting_lag_p95_days"))
    return out.withColumns({"health": health, "metrics": metrics}).drop("__state", "faults", "uptime", "p50", "p95")


def with_session_anomalies(sessions: DataFrame, found: DataFrame) -> DataFrame:
    own = found.where("target = 'session'").groupBy(F.col("key").alias("group")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rule", "ord", "detail", "type", "severity", "evidence"))), lambda x: F.struct(x["type"].alias("type"), x["severity"].alias("severity"), x["detail"].alias("detail"), x["evidence"].alias("evidence"))).alias("anomalies"))
    return sessions.join(own, "group", "left")


def lag_percentiles(rows: DataFrame, by: str, lag: str) -> DataFrame:
    """(by, p50, p95) by nearest rank."""
    return stats.order_statistics(rows, by, lag, {"p50": stats.nearest_rank(50), "p95": stats.nearest_rank(95)}).drop("n")
