"""Fleet figures, city rollups, ordered views and restatements over golden records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmbridge import config
from ohmbridge.functions import stats

KPI_COLUMNS = ["chargers_deployed", "active_chargers", "inactive_chargers", "sessions_count", "sessions_missing_energy", "energy_delivered_kwh", "est_uptime_pct", "data_completeness_pct", "chargers_with_metrics", "max_fault_recurrence", "chronic_failure_sites", "anomalies_total", "maintenance_events"]


def rank_in(value: Column, order: list[str]) -> Column:
    """Position in a fixed order; what is not in it comes last."""
    place = F.array_position(F.array(*(F.lit(x) for x in order)), value)
    return F.when(value.isNull() | (place == 0), F.lit(len(order) + 1)).otherwise(place).cast("int")


def fleet_kpis(chargers: DataFrame, sessions: DataFrame, events: DataFrame) -> DataFrame:
    """One row: each record type is one aggregation, and the three rows are joined."""
    n_anomalies = lambda: F.coalesce(F.sum(F.size(F.coalesce("anomalies", F.array()))), F.lit(0))
    c = chargers.agg(
        F.count("*").alias("chargers_deployed"), F.count_if(F.upper("status") == "ACTIVE").alias("active_chargers"), F.count("metrics").alias("chargers_with_metrics"),
        F.avg("metrics.est_uptime_pct").alias("est_uptime_pct"), F.coalesce(F.max("metrics.fault_recurrence_count"), F.lit(0)).alias("max_fault_recurrence"),
        F.count_if(F.col("metrics.fault_recurrence_count") >= config.CHRONIC_FAULTS).alias("chronic_failure_sites"), n_anomalies().alias("a1"), F.sum("quality.score").alias("q1"), F.count("quality.score").alias("n1"))
    s = sessions.agg(
        F.count("*").alias("sessions_count"), F.count_if(F.col("energy_kwh").isNull()).alias("sessions_missing_energy"), F.round(F.coalesce(F.sum("energy_kwh"), F.lit(0.0)), 2).alias("energy_delivered_kwh"),
        n_anomalies().alias("a2"), F.sum("quality.score").alias("q2"), F.count("quality.score").alias("n2"))
    e = events.agg(F.count("*").alias("maintenance_events"))
    row = c.crossJoin(F.broadcast(s)).crossJoin(F.broadcast(e))
    n = F.col("n1") + F.col("n2")
    mean = F.when(n > 0, (F.coalesce("q1", F.lit(0.0)) + F.coalesce("q2", F.lit(0.0))) / n)
    return row.withColumns({"inactive_chargers": F.col("chargers_deployed") - F.col("active_chargers"), "anomalies_total": F.col("a1") + F.col("a2"), "data_completeness_pct": mean}).select(*KPI_COLUMNS)


def city_rollup(sites: DataFrame, activity: DataFrame, site: str, city: str, uptime: str, amount: str, unknown: str = "Unknown location") -> DataFrame:
    """(city, sites, mean_uptime, activities, amount): both sides are aggregated before they meet.

    ``sites`` has one row for each ``site``; an activity of an unknown site, or of
    a site without a city, counts under ``unknown``.
    """
    a = sites.groupBy(F.coalesce(city, F.lit(unknown)).alias("city")).agg(F.count("*").alias("sites"), F.avg(uptime).alias("mean_uptime"), F.count(uptime).alias("n_uptime"))
    per_site = activity.groupBy(F.col(site).alias("__site")).agg(F.count("*").alias("n"), F.sum(amount).alias("amount"))
    b = per_site.join(sites.select(F.col(site).alias("__s"), F.col(city).alias("__c")), F.col("__site").eqNullSafe(F.col("__s")), "left")
    b = b.groupBy(F.coalesce("__c", F.lit(unknown)).alias("city")).agg(F.sum("n").alias("activities"), F.coalesce(F.sum("amount"), F.lit(0.0)).alias("amount"))
    zero = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return a.join(b, "city", "full_outer").select("city", zero("sites", 0), "mean_uptime", zero("n_uptime", 0), zero("activities", 0), zero("amount", 0.0))


def last_site(sites: DataFrame, site: str, order: str) -> DataFrame:
    """One row for each site id, null included: the last by ``order``."""
    cols = [c for c in sites.columns if c != site]
    g = sites.groupBy(site).agg(F.max_by(F.struct(*cols), F.col(order)).alias("__r"))
    return g.select(site, *(F.col(f"__r.{c}").alias(c) for c in cols))


#: The figures of a restatement: (key, label, whether it is a fraction shown in points).
RESTATED = [
    ("chargers_deployed", "Chargers deployed", False), ("active_chargers", "Chargers active", False), ("sessions_count", "Sessions", False),
    ("energy_delivered_kwh", "Energy delivered (kWh)", False), ("est_uptime_pct", "Est. fleet uptime (%)", True), ("data_completeness_pct", "Data completeness (%)", True),
]


def restatement(current: DataFrame, prior: DataFrame, figures: list[tuple[str, str, bool]] = RESTATED) -> DataFrame:
    """(metric, prior, current, delta) where both sides have a figure; prior fractions are in points already."""
    now = [F.struct(F.lit(label).alias("metric"), (F.col(k).cast("double") * (100 if frac else 1)).alias("v")) for k, label, frac in figures if k in current.columns]
    old = [F.struct(F.lit(label).alias("metric"), F.col(k).cast("double").alias("v")) for k, label, _ in figures if k in prior.columns]
    a = current.select(F.explode(F.array(*now)).alias("x")).select("x.metric", F.col("x.v").alias("current"))
    b = prior.select(F.explode(F.array(*old)).alias("x")).select("x.metric", F.col("x.v").alias("prior"))
    return a.join(F.broadcast(b), "metric").where("current is not null and prior is not null").select("metric", "prior", "current", (F.col("current") - F.col("prior")).alias("delta"))


def lineage(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, metric, value): one-row frames unpivoted, one after another."""
    out = None
    for section, df in sections.items():
        cells = [F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]
        part = df.select(F.lit(section).alias("section"), F.explode(F.array(*cells)).alias("x")).select("section", "x.metric", "x.value")
        out = part if out is None else out.unionByName(part)
    return out


def severity_feed(anomalies: DataFrame, *tie: str) -> DataFrame:
    return anomalies.orderBy(rank_in(F.col("severity"), config.SEVERITY_ORDER), *tie)


def triage(chargers: DataFrame, state: str = "state", *tie: str) -> DataFrame:
    return chargers.orderBy(rank_in(F.col(state), config.HEALTH_ORDER), *tie)


def triage_places(chargers: DataFrame, state: str, tie: str) -> DataFrame:
    """The triage order as numbers from 1."""
    out = stats.numbered(chargers, [rank_in(F.col(state), config.HEALTH_ORDER), F.col(tie)], "place")
    return out.withColumn("place", F.col("place") + 1)


def chronic(chargers: DataFrame) -> DataFrame:
    """Sites of which so many sessions had a fault that they count as chronic."""
    return chargers.where(F.col("metrics.fault_recurrence_count") >= config.CHRONIC_FAULTS)


def league(rows: DataFrame, by: str = "avg_score") -> DataFrame:
    """Best first; an unknown score comes last."""
    return rows.orderBy(F.coalesce(F.col(by), F.lit(-1.0)).desc())


def map_points(rows: DataFrame, lat: str, lon: str, fallback: dict | None = None) -> DataFrame:
    """Adds x and y on the map; bounds come from the data, or from a fixed box for fewer than two points."""
    from ohmbridge.functions import geo

    box = fallback or config.DEFAULT["territory"]["bbox"]
    b = rows.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).agg(F.count("*").alias("__n"), *(f(F.col(c)).alias(f"__{k}") for k, f, c in (("min_lat", F.min, lat), ("max_lat", F.max, lat), ("min_lon", F.min, lon), ("max_lon", F.max, lon))))
    b = b.select(*(F.when(F.col("__n") >= 2, F.col(f"__{k}")).otherwise(F.lit(float(box[k]))).alias(f"__{k}") for k in box))
    x, y = geo.to_screen(F.col(lat), F.col(lon), {k: F.col(f"__{k}") for k in box})
    return rows.crossJoin(F.broadcast(b)).withColumns({"x": x, "y": y}).drop(*(f"__{k}" for k in box))
