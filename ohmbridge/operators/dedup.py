"""Duplicate sessions and events: a grouping key, a range join within it, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmbridge import config
from ohmbridge.functions import text, time
from ohmbridge.operators.graph import with_components
from ohmbridge.operators.matching import station_name, with_survivor


def close_values(ea: Column, eb: Column, da: Column, db: Column, d: dict = config.DUPLICATE) -> Column:
    """Energies agree, or both are unknown, and durations agree where both are known."""
    energy = F.when(ea.isNull() & eb.isNull(), F.lit(True)).when(ea.isNull() | eb.isNull(), F.lit(False)).otherwise(F.abs(ea - eb) <= F.greatest(F.lit(d["energy_abs"]), d["energy_rel"] * F.greatest(ea, eb)))
    duration = F.coalesce(F.abs(da - db) <= d["duration_rel"] * F.greatest(da, db, F.lit(1.0)), F.lit(True))
    return energy & duration


def close_pairs(rows: DataFrame, group: list[str], at_s: str, within_s: float, residual: Column, carry: list[str]) -> DataFrame:
    """(a, b): pairs of a group whose times, in seconds, lie within ``within_s``.

    Times are cut into bins of that width, and each row meets its own bin and the
    next: an equi-join on (group, bin), so a hot group spreads over its bins.
    ``residual`` reads the carried columns as x_<name> and y_<name>.
    """
    bins = rows.withColumn("__bin", F.floor(F.col(at_s) / within_s))
    x = bins.select(*group, F.explode(F.array(F.col("__bin"), F.col("__bin") + 1)).alias("__at"), F.col("__bin").alias("x_bin"), F.col("idx").alias("x_idx"), F.col(at_s).alias("x_s"), *(F.col(c).alias(f"x_{c}") for c in carry))
    y = bins.select(*group, F.col("__bin").alias("__at"), F.col("idx").alias("y_idx"), F.col(at_s).alias("y_s"), *(F.col(c).alias(f"y_{c}") for c in carry))
    hit = x.join(y, [*group, "__at"]).where((F.col("x_bin") < F.col("__at")) | (F.col("x_idx") < F.col("y_idx")))
    hit = hit.where((F.abs(F.col("x_s") - F.col("y_s")) <= within_s) & residual)
    return hit.select(F.least("x_idx", "y_idx").alias("a"), F.greatest("x_idx", "y_idx").alias("b")).where("a < b").distinct()


def group_sessions(sessions: DataFrame, placed: DataFrame) -> DataFrame:
    """``sessions`` with cluster (null if unresolved), group (its least idx) and survivor.

    Records with a driver or a box group by both; others by cluster and station
    name. Within a group, equal session ids, or near-equal start, energy and
    duration without conflicting identity, make one session.
    """
    s = sessions.join(placed, "idx", "left").withColumn("name_norm", text.normal(station_name(sessions)))
    start, end = time.instant(F.col("start_time")), time.instant(F.col("end_time"))
    driver, box = F.coalesce(text.key_text(F.col("driver_id")), F.lit("")), F.coalesce(text.key_text(F.col("charger_id")), F.lit(""))
    known = (driver != "") | (box != "")
    key = F.when(known, F.concat_ws("\u0001", F.lit("id"), driver, box)).otherwise(F.concat_ws("\u0001", F.lit("geo"), F.coalesce(F.col("cluster").cast("string"), F.lit("-1")), F.when(F.col("name_norm") == "", F.lit("?")).otherwise(F.col("name_norm"))))
    minutes = F.coalesce("duration_min", F.when(end >= start, time.minutes_between(start, end)))
    keyed = s.select("idx", key.alias("k"), F.trim("session_id").alias("sid"), (F.unix_micros(start) / 1e6).alias("at_s"), F.col("energy_kwh").alias("e"), minutes.alias("d"), driver.alias("driver"), box.alias("box"))
    # equal ids: a star from the first record of each
    same = keyed.where("sid <> ''").groupBy("k", "sid").agg(F.min("idx").alias("a"), F.count("*").alias("n")).where("n > 1")
    by_id = keyed.join(same.select("k", "sid", "a"), ["k", "sid"]).where("a < idx").select("a", F.col("idx").alias("b"))
    agree = F.lit(True)
    for c in ("driver", "box"):
        agree = agree & ((F.col(f"x_{c}") == "") | (F.col(f"y_{c}") == "") | (F.col(f"x_{c}") == F.col(f"y_{c}")))
    near = close_pairs(keyed.where("at_s is not null"), ["k"], "at_s", config.DUPLICATE["start_s"], agree & close_values(F.col("x_e"), F.col("y_e"), F.col("x_d"), F.col("y_d")), ["e", "d", "driver", "box"])
    out = with_components(s.drop("name_norm"), by_id.unionByName(near), "idx").withColumnRenamed("component", "group")
    return with_survivor(out)


def group_events(events: DataFrame, placed: DataFrame) -> DataFrame:
    """``events`` with cluster, group and survivor; unresolved events share one scope.

    Equal event ids, or equal date, type, severity and normalised description,
    within a cluster, are one event.
    """
    e = events.join(placed, "idx", "left")
    scope = F.coalesce("cluster", F.lit(-1).cast("long"))
    like = F.concat_ws("\u0001", *(F.coalesce(F.col(c), F.lit("\u0002")) for c in ("event_date", "event_type", "severity")), text.normal(F.col("description")))
    keyed = e.select("idx", scope.alias("k"), F.explode(F.array_compact(F.array(F.concat(F.lit("id:"), text.filled(F.trim("event_id"))), F.concat(F.lit("as:"), like)))).alias("key"))
    first = keyed.groupBy("k", "key").agg(F.min("idx").alias("a"), F.count("*").alias("n")).where("n > 1")
    links = keyed.join(first.select("k", "key", "a"), ["k", "key"]).where("a < idx").select("a", F.col("idx").alias("b"))
    return with_survivor(with_components(e, links, "idx").withColumnRenamed("component", "group"))
