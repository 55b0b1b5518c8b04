"""Entity resolution: station references, blocking, match predicates, clusters, association.

Every record carries ``idx``, a bigint that fixes the order of records: ties and
"first" go by it, never by how rows are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmbridge import config
from ohmbridge.functions import geo, text
from ohmbridge.operators import classes
from ohmbridge.operators.graph import with_components
from ohmbridge.storage import materialize

# Fixed value: how texts name a charge box.
BOX_ID = r"(?i)(?:charge\s*box|box)(?:\s*id)?\s*[:#]?\s*([A-Za-z0-9][A-Za-z0-9-]{2,})"


def source_rank(source: Column) -> Column:
    """0 for registries, 1 municipal, 2 contractors, 3 unknown: lower is more trusted."""
    low = F.lower(source)
    out = F.when(F.coalesce(low, F.lit("")) == "", F.lit(3))
    for rank, names in enumerate(config.SOURCE_TIERS):
        hit = F.lit(False)
        for n in names:
            hit = hit | low.contains(n)
        out = out.when(hit, F.lit(rank))
    return out.otherwise(F.lit(3))


def _pick(df: DataFrame, *names: str) -> Column:
    cols = []
    for n in names:
        head = n.split(".")[0]
        if head in df.columns:
            cols.append(text.filled(F.col(n).cast("string")))
    return F.coalesce(*cols) if cols else F.lit(None).cast("string")


def station_name(df: DataFrame) -> Column:
    return _pick(df, "station_name", "station", "name", "location_name")


def station_refs(df: DataFrame, kind: str) -> DataFrame:
    """(idx, charger_id, station_id, name, street, city, zip, state, lat, lon and normal forms).

    An event without either id gets the first box id that its texts name.
    """
    street = _pick(df, "address.street", "address_1", "street", "street_address")
    city = _pick(df, "address.city", "city")
    zip_code = _pick(df, "address.zip", "zip_postal_code", "postal_code")
    name = station_name(df)
    charger, station = _pick(df, "charger_id"), _pick(df, "station_id")
    if kind == "maintenance":
        said = F.concat_ws("\n", F.coalesce("description", F.lit("")), F.map_values(F.coalesce("extracted_fields", F.create_map().cast("map<string,string>"))))
        station = F.when(charger.isNull() & station.isNull(), text.filled(F.regexp_extract(said, BOX_ID, 1))).otherwise(station)
    # one zero, so that equal references are equal texts too
    coord = lambda c: F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)) if c in df.columns else F.lit(None).cast("double")
    return df.select(
        "idx", text.key_text(charger).alias("cid"), text.key_text(station).alias("sid"), name.alias("name"),
        text.normal(name).alias("name_norm"), text.normal(street).alias("street_norm"), text.normal(city).alias("city_norm"), text.normal(zip_code).alias("zip_norm"),
        coord("lat").alias("lat"), coord("lon").alias("lon"),
    )


def blocking_keys(ids: bool = True) -> Column:
    """The keys of a reference, in order of strength; without ``ids`` those of place and name alone."""
    words = F.split("name_norm", " ")
    named = F.col("name_norm") != ""
    one = lambda c: F.format_string("%.1f", c)
    by_id = [F.concat(F.lit("chg:"), "cid"), F.concat(F.lit("sid:"), "sid")] if ids else []
    keys = F.array(
        *by_id,
        F.when((F.col("city_norm") != "") & (F.col("zip_norm") != ""), F.concat(F.lit("cityzip:"), "city_norm", F.lit("|"), "zip_norm")),
        F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.concat(F.lit("geo:"), one(F.col("lat")), F.lit(","), one(F.col("lon")))),
        F.when(named, F.concat(F.lit("name3:"), F.array_join(F.slice(words, 1, 3), " "))),
        F.when(named & (F.size(words) > 3) & (F.length(words[0]) <= 4), F.concat(F.lit("name3:"), F.array_join(F.slice(words, 2, 3), " "))),
    )
    return F.filter(keys, lambda k: k.isNotNull())


def met_classes(kinds: DataFrame) -> DataFrame:
    """(p, q) with p <= q, once for each two classes, or class and itself, that share one of their ``keys``."""
    k = kinds.select("rep", F.explode("keys").alias("__k"))
    left, right = k.select("__k", F.col("rep").alias("p")), k.select("__k", F.col("rep").alias("q"))
    return left.join(right, "__k").where("p <= q").select("p", "q").distinct()


def blocked_pairs(refs: DataFrame, id_col: str = "idx", keys: Column | None = None) -> DataFrame:
    """(a, b) with a < b, once for each pair that shares a blocking key.

    Rows of the same keys are one class: classes meet by key, once, and the pairs
    of rows are written out from them.
    """
    rows = refs.select(F.col(id_col).alias("idx"), F.array_sort(F.array_distinct(keys if keys is not None else blocking_keys())).alias("keys"))
    kinds = classes.kinds_of(rows, ["keys"])
    return classes.expand(met_classes(kinds), rows, kinds, ["keys"], [])


def _side(refs: DataFrame, prefix: str, on: str) -> DataFrame:
    return refs.select(*(F.col(c).alias(on if c == "idx" else f"{prefix}_{c}") for c in refs.columns))


def _address_equal(a: str, b: str) -> Column:
    same = F.lit(True)
    for part in ("street_norm", "city_norm", "zip_norm"):
        same = same & (F.col(f"{a}_{part}") != "") & (F.col(f"{a}_{part}") == F.col(f"{b}_{part}"))
    return F.coalesce(same, F.lit(False))


def _distance(a: str, b: str) -> Column:
    return geo.haversine_km(*(F.col(f"{p}_{c}") for p in (a, b) for c in ("lat", "lon")))


def same_entity() -> Column:
    """Whether references x and y are one port; needs __sim, the names' similarity."""
    m = config.MATCH
    both_cid = F.col("x_cid").isNotNull() & F.col("y_cid").isNotNull()
    near, sim = _distance("x", "y"), F.col("__sim")
    street = (F.col("x_street_norm") != "") & (F.col("x_street_norm") == F.col("y_street_norm"))
    city = (F.col("x_city_norm") != "") & (F.col("x_city_norm") == F.col("y_city_norm"))
    return (
        F.when(both_cid, F.col("x_cid") == F.col("y_cid"))
        .when(F.col("x_sid") == F.col("y_sid"), F.lit(True))
        .when((near <= m["geo_km"]) & ((sim >= m["name"]) | _address_equal("x", "y")), F.lit(True))
        .when((sim >= m["strong_name"]) & city, (near <= m["strong_name_km"]) | ((near == float("inf")) & street))
        .otherwise(_address_equal("x", "y"))
    )


def _needs_name() -> Column:
    """Pairs that ids alone do not decide: only these pay for the character ratio."""
    both_cid = F.col("x_cid").isNotNull() & F.col("y_cid").isNotNull()
    return ~both_cid & ~F.coalesce(F.col("x_sid") == F.col("y_sid"), F.lit(False))


def cluster_chargers(chargers: DataFrame) -> DataFrame:
    """(idx, cluster): cluster is the least idx of the port's records.

    Equal charger ids, and equal station ids where a record of them has no
    charger id, link in stars, without pairs. Two records with charger ids are
    decided by these, so place and name pair only records without one with the
    others of their blocks.
    """
    refs = materialize(station_refs(chargers, "charger"), "charger-refs")
    loose = F.col("cid").isNull()

    def star(by: str, where: Column) -> DataFrame:
        first = refs.where(F.col(by).isNotNull()).groupBy(by).agg(F.min("idx").alias("a"), F.count("*").alias("n"), F.count_if(loose).alias("loose")).where((F.col("n") > 1) & where)
        return refs.join(first, by).where("a < idx").select("a", F.col("idx").alias("b"))

    keyed = refs.select("idx", loose.alias("loose"), F.explode(F.array_distinct(blocking_keys(ids=False))).alias("k"))
    met = keyed.where("loose").select("k", F.col("idx").alias("i")).join(keyed.select("k", F.col("idx").alias("j")), "k").where("i <> j")
    pairs = met.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).distinct()
    pairs = pairs.join(_side(refs, "x", "a"), "a").join(_side(refs, "y", "b"), "b").where(_needs_name())
    by_name = pairs.withColumn("__sim", text.name_similarity(F.col("x_name"), F.col("y_name"))).where(same_entity()).select("a", "b")
    links = star("cid", F.lit(True)).unionByName(star("sid", F.col("loose") > 0)).unionByName(by_name)
    return with_components(refs.select("idx"), links, "idx").withColumnRenamed("component", "cluster")


def match_class() -> Column:
    """5 same charger id, 4 same station id, 3 same address, 2 near and alike, 1 alike, 0 none; x is the record, y the charger."""
    m, sim = config.MATCH, F.col("__sim")
    return (
        F.when(F.col("x_cid") == F.col("y_cid"), 5).when(F.col("x_sid") == F.col("y_sid"), 4).when(_address_equal("x", "y"), 3)
        .when((_distance("x", "y") <= m["geo_km"]) & (sim >= m["geo_name"]), 2).when(sim >= m["name"], 1).otherwise(0)
    )


#: Classes of equal references whose cluster (some 40 bytes each) is broadcast at most.
BROADCAST_REFS = 500_000


def _ref_key(refs: DataFrame) -> Column:
    """128 bits that stand for a reference, its idx left out."""
    return F.unhex(F.md5(F.to_json(F.struct(*(c for c in refs.columns if c != "idx"))).cast("binary")))


def _classes(refs: DataFrame) -> DataFrame:
    """Each distinct reference once, with the least idx that has it: combined before rows move, however often one repeats."""
    return refs.groupBy(*(c for c in refs.columns if c != "idx")).agg(F.min("idx").alias("idx"))


def associate(records: DataFrame, kind: str, chargers: DataFrame, clusters: DataFrame) -> DataFrame:
    """(idx, cluster) of each record's best charger; records without one are left out.

    The best is that of the highest class, then similarity; of equals, the one
    found by the earlier key, then of the lower idx. Records of equal references
    have one answer, so distinct references alone are matched: by charger id, the
    rest by station id, and only what neither decides by pairs within blocks.
    """
    refs = station_refs(records, kind)
    mine, theirs = materialize(_classes(refs), "refs"), materialize(_classes(station_refs(chargers, "charger")), "charger-refs")
    by_cid = mine.join(theirs.where("cid is not null").groupBy("cid").agg(F.min("idx").alias("b")), "cid").select("idx", "b")
    rest = mine.join(by_cid, "idx", "left_anti")
    by_sid = rest.join(theirs.where("sid is not null").groupBy("sid").agg(F.min("idx").alias("b")), "sid").select("idx", "b")
    rest = rest.join(by_sid, "idx", "left_anti")
    left = rest.select(F.col("idx").alias("a"), F.posexplode(blocking_keys(ids=False)).alias("ord", "k"))
    right = theirs.select(F.col("idx").alias("b"), F.explode(F.array_distinct(blocking_keys(ids=False))).alias("k"))
    pairs = left.join(right, "k").groupBy("a", "b").agg(F.min("ord").alias("ord"))
    pairs = pairs.join(_side(mine, "x", "a"), "a").join(_side(theirs, "y", "b"), "b")
    scored = pairs.withColumn("__sim", text.name_similarity(F.col("x_name"), F.col("y_name"))).withColumn("class", match_class()).where("class >= 1")
    # best by one aggregation with map-side combine
    best = scored.groupBy("a").agg(F.max(F.struct("class", F.col("__sim").alias("sim"), (-F.col("ord")).alias("ord"), (-F.col("b")).alias("b"))).alias("m")).select(F.col("a").alias("idx"), (-F.col("m.b")).alias("b"))
    found = by_cid.unionByName(by_sid).unionByName(best).join(clusters.select(F.col("idx").alias("b"), "cluster"), "b").join(mine, "idx")
    found = materialize(found.select(_ref_key(refs).alias("__ref"), "cluster"), "placed-refs")
    few = F.broadcast(found) if found.count() <= BROADCAST_REFS else found
    return refs.select("idx", _ref_key(refs).alias("__ref")).join(few, "__ref").select("idx", "cluster")


def survivor_rank() -> list[Column]:
    """Within a duplicate group, the greatest stays: by trust, score, freshness, name, station; then the first record."""
    return [-source_rank(F.col("provenance.source")), F.coalesce("quality.score", F.lit(0.0)), F.coalesce("provenance.ingested_at", F.lit("")), F.coalesce("station_name", F.lit("")), F.coalesce("station_id", F.lit("")), (-F.col("idx")).alias("low")]


def with_survivor(records: DataFrame, group: str = "group") -> DataFrame:
    """``records`` with survivor; a group's is the maximum of one aggregation, joined back by idx, so that a group of any size is no single task."""
    best = records.groupBy(group).agg(F.max(F.struct(*survivor_rank())).alias("__m")).select((-F.col("__m.low")).alias("idx"), F.lit(True).alias("__best"))
    return records.join(best, "idx", "left").select(*records.columns, F.coalesce("__best", F.lit(False)).alias("survivor"))
