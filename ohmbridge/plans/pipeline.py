"""The stages as one plan: ingest, validate, reconcile, report.

Stages are functions of DataFrames. Validated and golden records are written as
Parquet; a manifest of input listings and settings lets a rerun skip stages whose
inputs have not changed. Late data is handled by running again: ids are stable on
a superset of the inputs.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmbridge import config, schemas, storage
from ohmbridge.functions import stats
from ohmbridge.operators import anomalies, assemble, dedup, extract, fuse, kpis, matching, standardise
from ohmbridge.sources import files, sinks
from ohmbridge.storage import materialize

Records = dict[str, DataFrame]


def ingest(spark: SparkSession, path: str, ingested_at: str) -> Records:
    """Canonical raw records of all files of a folder."""
    found: dict[str, list[DataFrame]] = {t: [] for t in schemas.TYPES}
    listing = files.detect(spark, path)
    # files of one shape are one scan, however many there are
    shapes: dict[tuple, list[files.RawFile]] = {}
    for f in listing:
        if f.kind == "csv":
            shapes.setdefault((f.delimiter, tuple(f.header), f.header_is_row), []).append(f)
    for group in shapes.values():
        rows = files.read_delimited(spark, group)
        if "Charge Box ID" in group[0].header:
            s = assemble.sessions_box(rows, ingested_at)
            found["charger"].append(assemble.box_chargers(s))
        else:
            s = assemble.sessions_plain(rows, ingested_at)
        found["session"].append(s)
    geo = [f.path for f in listing if f.kind == "geojson"]
    if geo:
        found["charger"].append(assemble.ports(files.read_geojson(spark, geo), ingested_at))
    texts = [f.path for f in listing if f.kind == "text"]
    if texts:
        found["maintenance"].append(assemble.maintenance(extract.events(files.read_reports(spark, texts)), ingested_at))
    return {t: _union(spark, t, parts) for t, parts in found.items()}


def _union(spark: SparkSession, kind: str, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schemas.raw(kind))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate(raw: Records, cat: dict | None = None) -> Records:
    cat = cat or config.catalog()
    return {t: standardise.clean(df, t, cat) for t, df in raw.items()}


def validation_report(valid: Records) -> DataFrame:
    parts = [df.select(F.col("provenance.source").alias("source"), F.col("quality.score").alias("score"), F.col("quality.issues").alias("issues")) for df in valid.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return standardise.validation_report(out)


def with_index(df: DataFrame) -> DataFrame:
    """``idx``: a dense order of records by file, line and id, the same for any partitioning."""
    line = F.regexp_extract(F.coalesce("provenance.raw_ref", F.lit("")), r"(\d+)$", 1).try_cast("long")
    ids = [c for c in ("session_id", "event_id", "charger_id") if c in df.columns]
    order = [F.coalesce("provenance.source_file", F.lit("")), F.coalesce(line, F.lit(0)), *(F.coalesce(c, F.lit("")) for c in ids), F.xxhash64(*(c for c, t in df.dtypes if not t.startswith("map")))]
    return stats.numbered(df, order, "idx")


def totals(valid: Records) -> DataFrame:
    """One row: records, quarantined ones, and the mean score over all types."""
    parts = [df.agg(F.count("*").alias("n"), F.count_if("quarantined").alias("q"), F.sum("quality.score").alias("s")) for df in valid.values()]
    return reduce(DataFrame.unionByName, parts).agg(F.sum("n").alias("records"), F.sum("q").alias("quarantined"), F.round(F.sum("s") / F.nullif(F.sum("n"), F.lit(0)), 4).alias("avg_score"))


def reconcile(valid: Records, compat_rank: bool = False) -> Records:
    """Golden chargers, sessions and events, with anomalies, metrics and health."""
    r = {t: materialize(with_index(df.drop("quarantined")), f"valid-{t}") for t, df in valid.items()}
    clusters = materialize(matching.cluster_chargers(r["charger"]), "clusters")
    placed = {t: materialize(matching.associate(r[t], t, r["charger"], clusters), "placed") for t in ("session", "maintenance")}
    c = materialize(fuse.golden_chargers(r["charger"], clusters, compat_rank), "golden-chargers")
    groups = materialize(dedup.group_sessions(r["session"], placed["session"]), "session-groups")
    s = materialize(fuse.golden_sessions(groups, c, compat_rank), "golden-sessions")
    e = materialize(fuse.golden_events(dedup.group_events(r["maintenance"], placed["maintenance"]), c), "golden-events")
    found = materialize(anomalies.detect(s, e, c), "anomalies")
    return {"charger": materialize(anomalies.with_health(c, s, e, found), "golden"), "session": materialize(anomalies.with_session_anomalies(s, found), "golden"), "maintenance": e, "anomalies": found}


def reconciliation_report(valid: Records, golden: Records) -> dict:
    """Counts, anomalies by type and reporting lags by source."""
    from ohmbridge.functions import time as tm

    n_in = sum(df.count() for df in valid.values())
    sizes = {t: golden[t].agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("members") - 1), F.lit(0)).alias("d")).first() for t in schemas.TYPES}
    conflicts = sum(golden[t].agg(F.coalesce(F.sum(F.size("conflicts_resolved")), F.lit(0))).first()[0] for t in ("charger", "session"))
    lag = lambda df, at: df.select(F.col("provenance.source").alias("source"), tm.lag_days(tm.instant(F.col("provenance.ingested_at")), tm.instant(F.col(at))).alias("lag"))
    lags = anomalies.lag_percentiles(lag(golden["session"], "start_time").unionByName(lag(golden["maintenance"], "event_date")), "source", "lag")
    return {
        "records_in": n_in, "golden_records_out": sum(v["n"] for v in sizes.values()), "duplicates_removed": sum(v["d"] for v in sizes.values()), "clusters": sizes["charger"]["n"], "conflicts_resolved": conflicts,
        "anomalies": {x["type"]: x["n"] for x in golden["anomalies"].groupBy("type").agg(F.count("*").alias("n")).collect()},
        "per_source_lag_days": {x["source"]: {"p50": x["p50"], "p95": x["p95"]} for x in lags.collect()},
    }


def report(golden: Records) -> dict:
    k = kpis.fleet_kpis(golden["charger"], golden["session"], golden["maintenance"]).first().asDict()
    states = {x["s"]: x["n"] for x in golden["charger"].groupBy(F.col("health.state").alias("s")).agg(F.count("*").alias("n")).collect()}
    severities = {x["severity"]: x["n"] for x in golden["anomalies"].groupBy("severity").agg(F.count("*").alias("n")).collect()}
    return {"kpis": k, "health_states": states, "anomaly_severity": severities}


def write_golden(golden: Records, path: str, limit: int | None = None) -> None:
    """Chargers, then sessions, then events, as JSON lines."""
    sinks.write_jsonl([(golden["charger"], ["first_idx"]), (golden["session"], ["survivor_idx"]), (golden["maintenance"], ["survivor_idx"])], path, limit)


def listing_digest(spark: SparkSession, path: str) -> str:
    """A digest of names, sizes and times of a folder's files."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))
    return hashlib.sha256(json.dumps(rows).encode()).hexdigest()


@dataclass
class Run:
    """One run over a folder: stage timings, row counts, and what was skipped.

    The manifest, a JSON file beside the outputs on any file system, has a digest
    for each stage: of its inputs, its settings and the stage before. With
    ``resume``, a stage of an equal digest whose outputs are there is skipped.
    """

    spark: SparkSession
    raw_dir: str
    out_dir: str
    ingested_at: str | None
    rules: dict | str | None = None
    resume: bool = True
    retries: int = 1
    health: dict = field(default_factory=dict)

    def _path(self, name: str) -> str:
        return f"{self.out_dir.rstrip('/')}/{name}"

    def _stage(self, name: str, digest: str, tables: list[str], work) -> dict:
        """What a stage says of itself, from the manifest if nothing has changed."""
        had = self.manifest.get(name, {})
        if self.resume and had.get("digest") == digest and all(storage.exists(self.spark, self._path(f"{t}/_SUCCESS")) for t in tables):
            self.health[name] = {**had["health"], "skipped": True}
            return had["said"]
        began, tries = time.time(), 0
        while True:
            try:
                counts, said = work()
                break
            except Exception:
                tries += 1
                if tries > self.retries:
                    raise
        self.health[name] = {**counts, "llm_calls": 0, "llm_tokens": 0, "duration_s": round(time.time() - began, 3), "skipped": False}
        self.manifest[name] = {"digest": digest, "health": self.health[name], "said": json.loads(json.dumps(said, default=str))}
        # after each stage, so that a run that fails later goes on from here
        storage.write_text(self.spark, self._path("manifest.json"), json.dumps(self.manifest, default=str))
        return said

    def execute(self) -> dict:
        cat = config.catalog(self.rules)
        self.manifest = json.loads(storage.read_text(self.spark, self._path("manifest.json")) or "{}")
        digest = lambda *x: hashlib.sha256(json.dumps(x, sort_keys=True).encode()).hexdigest()
        inputs = listing_digest(self.spark, self.raw_dir)
        # without a set time, a run over the same inputs keeps that of the run before
        at = self.ingested_at or (self.manifest.get("at") if self.manifest.get("inputs") == inputs else None) or datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
        self.manifest |= {"inputs": inputs, "at": at}
        valid_digest = digest(inputs, cat, at)
        golden_digest = digest(valid_digest, "golden")
        valid = {t: f"validated/{t}" for t in schemas.TYPES}
        golden = {t: f"golden/{t}" for t in (*schemas.TYPES, "anomalies")}

        def do_validate():
            made = {t: self._store(df, valid[t]) for t, df in validate(ingest(self.spark, self.raw_dir, at), cat).items()}
            n = totals(made).first()
            rows = validation_report(made).collect()
            said = {"records_out": n.records, "quarantined": n.quarantined, "per_source": {r.source: {"records": r.n, "avg_score": r.avg_score} for r in rows if r.source and not r.issue}, "per_issue": {r.issue: r.n for r in rows if r.issue and not r.source}}
            return {"records_out": n.records, "quarantined": n.quarantined}, said

        def do_reconcile():
            had = {t: self._load(p) for t, p in valid.items()}
            made = {t: self._store(df, golden[t]) for t, df in reconcile(had).items()}
            said = reconciliation_report(had, made)
            return {"records_in": said["records_in"], "records_out": said["golden_records_out"]}, said

        def do_report():
            return {"records_in": said["golden_records_out"]}, report({t: self._load(p) for t, p in golden.items()})

        checked = self._stage("validation", valid_digest, list(valid.values()), do_validate)
        said = self._stage("reconciliation", golden_digest, list(golden.values()), do_reconcile)
        figures = self._stage("reporting", digest(golden_digest, "report"), [], do_report)
        result = {"validation": checked, "reconciliation": said, **figures, "health": self.health}
        return {**result, "skipped": True} if all(h["skipped"] for h in self.health.values()) else result

    def _load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self._path(name))
        return self.spark.read.schema(df.schema).parquet(self._path(name))
