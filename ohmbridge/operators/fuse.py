"""Survivorship: members of a cluster or duplicate group become one golden record.

One aggregation per record type. A field with two or more differing values takes
that of the best carrier, and the conflict is logged; a field that only one
member carries is not filled in. The best carrier is the most trusted source,
then the latest ingestion, the best score, the last record. ``compat_rank``
prefers the least trusted source instead, for comparison with older results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmbridge import schemas
from ohmbridge.functions import text
from ohmbridge.operators.matching import source_rank

CHARGER_FIELDS = ["network", "address.street", "address.city", "address.state", "address.zip", "lat", "lon", "connector_type", "power_kw", "level", "status", "install_date"]
SESSION_FIELDS = ["start_time", "end_time", "energy_kwh", "peak_kw", "duration_min", "fault_code"]


def member_rank(compat_rank: bool = False) -> Column:
    trust = source_rank(F.col("provenance.source"))
    return F.struct((trust if compat_rank else -trust).alias("trust"), F.coalesce("provenance.ingested_at", F.lit("")).alias("at"), F.coalesce("quality.score", F.lit(0.0)).alias("score"), F.col("idx").alias("idx"))


def comparable(value: Column, dtype: str) -> Column:
    """Values that count as equal have equal texts: numbers to four digits, texts trimmed and lower-cased."""
    return F.round(value, 4).cast("string") if dtype in ("double", "float") else F.lower(F.trim(value.cast("string")))


def _dtype(df: DataFrame, path: str) -> str:
    return df.select(F.col(path)).dtypes[0][1]


def _first_texts(kinds: Column, winner: Column, seen: Column) -> Column:
    """Of each value other than the winner, the text of its first carrier."""
    return F.transform(F.filter(kinds, lambda k: k != winner), lambda k: F.filter(seen, lambda x: x["cmp"] == k)[0]["v"])


def fuse(members: DataFrame, group: str, fields: list[str], compat_rank: bool = False) -> DataFrame:
    """One row for each ``group``: the best member's columns with the fields' winners in place.

    Adds merged_from, conflicts_resolved, members (how many) and first_idx.
    """
    names = [c for c in members.columns if c != group]
    rank = member_rank(compat_rank)
    aggs = [F.max_by(F.struct(*names), F.col("__rank")).alias("__best"), F.count("*").alias("members"), F.min("idx").alias("first_idx"),
            F.array_sort(F.collect_list(F.struct("idx", F.col("provenance.source").alias("source"), F.col("provenance.raw_ref").alias("raw_ref")))).alias("__from")]
    for i, path in enumerate(fields):
        value = F.col(path)
        aggs.append(F.max_by(value, F.when(value.isNotNull(), F.col("__rank"))).alias(f"__w{i}"))
        aggs.append(F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct("idx", comparable(value, _dtype(members, path)).alias("cmp"), value.cast("string").alias("v"))))).alias(f"__v{i}"))
    g = members.withColumn("__rank", rank).groupBy(group).agg(*aggs)
    conflicts, chosen = [], {}
    for i, path in enumerate(fields):
        seen = F.col(f"__v{i}")
        kinds = F.array_distinct(F.transform(seen, lambda x: x["cmp"]))
        clash = F.size(kinds) > 1
        winner = comparable(F.col(f"__w{i}"), _dtype(members, path))
        # of each other value, the first carrier's text
        rejected = _first_texts(kinds, winner, seen)
        conflicts.append(F.when(clash, F.struct(F.lit(path).alias("field"), F.col(f"__w{i}").cast("string").alias("chosen"), rejected.alias("rejected"), F.lit("survivorship").alias("rule"))))
        chosen[path] = F.when(clash, F.col(f"__w{i}")).otherwise(F.col(f"__best.{path}"))
    cols = []
    for c in names:
        if c in chosen:
            cols.append(chosen[c].alias(c))
        elif c == "address" and any(p.startswith("address.") for p in chosen):
            parts = [chosen.get(f"address.{p}", F.col(f"__best.address.{p}")).alias(p) for p in schemas.ADDRESS.names]
            cols.append(F.when(F.col("__best.address").isNotNull() | F.coalesce(*(chosen[f"address.{p}"] for p in schemas.ADDRESS.names)).isNotNull(), F.struct(*parts)).alias("address"))
        else:
            cols.append(F.col(f"__best.{c}").alias(c))
    merged = F.array_distinct(F.transform("__from", lambda x: F.struct(x["source"].alias("source"), x["raw_ref"].alias("raw_ref"))))
    log = F.filter(F.array(*conflicts), lambda x: x.isNotNull()) if conflicts else F.array().cast(f"array<{schemas.CONFLICT.simpleString()}>")
    return g.select(group, *cols, merged.alias("merged_from"), log.alias("conflicts_resolved"), "members", "first_idx")


def _one(keys: str) -> Column:
    return F.when(F.size(keys) == 1, F.col(keys)[0])


def golden_chargers(chargers: DataFrame, clusters: DataFrame, compat_rank: bool = False) -> DataFrame:
    """One row per port, with golden_id from its charger id, else its station id, else its name and place."""
    m = chargers.join(clusters, "idx")
    ids = m.groupBy("cluster").agg(F.collect_set(text.key_text(F.col("charger_id"))).alias("__c"), F.collect_set(text.key_text(F.col("station_id"))).alias("__s"))
    g = fuse(m, "cluster", CHARGER_FIELDS, compat_rank).join(ids, "cluster")
    place = F.coalesce(F.format_string("%.4f,%.4f", "lat", "lon"), F.lit("no-geo"))
    place = F.when(F.col("lat").isNull() | F.col("lon").isNull(), F.lit("no-geo")).otherwise(place)
    name = F.lower(F.trim(F.coalesce("station_name", "name", F.lit(""))))
    fallback = F.concat(F.lit("nm:"), F.concat_ws("|", name, F.coalesce("address.city", F.lit("")), F.coalesce("address.state", F.lit("")), place))
    key = F.coalesce(F.concat(F.lit("cid:"), _one("__c")), F.concat(F.lit("sid:"), _one("__s")), fallback)
    return g.withColumn("golden_id", text.sha256_id("chg-", key)).drop("__c", "__s")


def golden_sessions(groups: DataFrame, chargers: DataFrame, compat_rank: bool = False) -> DataFrame:
    """One row per session group, with the survivor's id, cluster and charger_golden_id."""
    kept = groups.where("survivor").select("group", F.col("session_id").alias("__sid"), F.col("cluster").alias("__cluster"), F.col("idx").alias("__idx"), F.col("start_time").alias("__st"), F.col("end_time").alias("__et"), F.col("energy_kwh").alias("__e"), F.coalesce("station_name", "name", F.lit("")).alias("__name"))
    ids = groups.groupBy("group").agg(F.array_sort(F.collect_set(text.filled(F.col("session_id")))).alias("session_ids"))
    g = fuse(groups.drop("survivor", "cluster"), "group", SESSION_FIELDS, compat_rank).join(kept, "group").join(ids, "group")
    c = chargers.select(F.col("cluster").alias("__cluster"), F.col("golden_id").alias("charger_golden_id"), F.col("station_id").alias("__station"))
    g = g.join(c, "__cluster", "left")
    show = lambda x: F.coalesce(F.col(x).cast("string"), F.lit("null"))
    key = F.coalesce(F.concat(F.lit("sid:"), text.key_text(F.col("__sid"))), F.concat_ws("|", "charger_golden_id", show("__st"), show("__e")))
    key = F.when(text.key_text(F.col("__sid")).isNull() & F.col("charger_golden_id").isNull(), F.concat_ws("|", F.lower(F.trim("__name")), show("__st"), show("__et"), show("__e"))).otherwise(key)
    g = g.withColumns({"golden_id": text.sha256_id("ses-", key), "station_id": F.coalesce(text.filled(F.col("station_id")), "__station"), "cluster": F.col("__cluster"), "survivor_idx": F.col("__idx")})
    return g.drop("__sid", "__cluster", "__idx", "__st", "__et", "__e", "__name", "__station")


def golden_events(groups: DataFrame, chargers: DataFrame) -> DataFrame:
    """The survivor of each event group; the id is that of the first member, survivors counting last."""
    first = groups.groupBy("group").agg(F.min_by("event_id", F.struct("survivor", "idx")).alias("__eid"), F.count("*").alias("members"))
    c = chargers.select(F.col("cluster").alias("__c"), F.col("golden_id").alias("charger_golden_id"))
    g = groups.where("survivor").drop("survivor").join(first, "group").join(c, F.col("cluster") == F.col("__c"), "left").drop("__c")
    return g.withColumn("golden_id", text.sha256_id("mnt-", F.coalesce(text.filled(F.col("__eid")), F.lit("evt")))).drop("__eid").withColumn("survivor_idx", F.col("idx"))
