"""Command line: ``python -m ohmbridge.plans.cli STAGE --in ... --out ...``.

Success is exit code 0 and, as the last line on standard error, a JSON object of
metrics; failure is a non-zero code and an error object.
"""

from __future__ import annotations

import argparse
import datetime
import json
import sys

from pyspark.sql import SparkSession

from ohmbridge import config, schemas
from ohmbridge.plans import pipeline, report
from ohmbridge.sources import files, sinks
from ohmbridge.storage import materialize

#: No stage calls a language model by itself.
LLM = {"llm_calls": 0, "llm_tokens": 0}
STAGES = ("ingest", "validate", "reconcile", "report", "run")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ohmbridge")
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--in", "--raw-dir", dest="source", required=True)
    p.add_argument("--out", "--artifacts-dir", dest="out", required=True)
    p.add_argument("--no-llm", action="store_true", help="accepted; no stage calls a language model unless a hook is given in code")
    p.add_argument("--log-json", action="store_true", help="stage messages on standard error as JSON objects")
    p.add_argument("--validation-report", help="report stage: the validation stage's JSON report")
    p.add_argument("--health", help="report stage: the pipeline's health as JSON")
    p.add_argument("--report", help="where the stage's JSON report goes")
    p.add_argument("--rules", help="catalog override, JSON or YAML")
    p.add_argument("--limit", type=int, help="rows written at most; 0 means none")
    p.add_argument("--ingested-at")
    p.add_argument("--report-date", default=None)
    p.add_argument("--restates")
    p.add_argument("--prior-kpis")
    p.add_argument("--no-resume", action="store_true")
    return p


def _say(a: argparse.Namespace, stage: str, what: dict) -> None:
    print(json.dumps({"stage": stage, **what}) if a.log_json else f"{stage}: " + ", ".join(f"{k} {v}" for k, v in what.items()), file=sys.stderr)


def _read(spark: SparkSession, path: str, tier: str) -> dict:
    return files.read_records(spark, path, tier)


def run(spark: SparkSession, a: argparse.Namespace) -> dict:
    at = a.ingested_at or datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
    made: dict = {}
    if wrong := config.problems(config.catalog(a.rules)):
        raise ValueError("; ".join(wrong))
    if a.stage == "run":
        out = pipeline.Run(spark, a.source, a.out, a.ingested_at, rules=a.rules, resume=not a.no_resume).execute()
        n = out["reconciliation"]
        for name, h in out["health"].items():
            _say(a, name, h)
        return {"records_in": n["records_in"], "records_out": n["golden_records_out"], **LLM}
    if a.stage == "ingest":
        got = {t: materialize(df, "raw") for t, df in pipeline.ingest(spark, a.source, at).items()}
        sinks.write_jsonl([(got[t], ["provenance.source_file", "provenance.raw_ref"]) for t in schemas.TYPES], a.out, a.limit)
        n_in = n_out = sum(df.count() for df in got.values())
    elif a.stage == "validate":
        # validated once, then counted, reported and written
        got = {t: materialize(df, "validated") for t, df in pipeline.validate(_read(spark, a.source, "raw"), config.catalog(a.rules)).items()}
        sinks.write_jsonl([(got[t].drop("quarantined"), ["provenance.source_file", "provenance.raw_ref"]) for t in schemas.TYPES], a.out, a.limit)
        n_in = n_out = sum(df.count() for df in got.values())
        rows = pipeline.validation_report(got).collect()
        skipped = {str(r.record_type): r.n for r in files.unknown_records(spark, a.source).collect()}
        made = {"records_skipped": skipped, "records_in": n_in, "records_out": n_out, "quarantined": sum(df.where("quarantined").count() for df in got.values()), "per_source": {r.source: {"records": r.n, "avg_score": r.avg_score, "issues": {x.issue: x.n for x in rows if x.source == r.source and x.issue}} for r in rows if r.source and not r.issue}, "per_issue": {r.issue: r.n for r in rows if r.issue and not r.source}}
    else:
        valid = {t: materialize(df, "validated") for t, df in _read(spark, a.source, "validated").items()}
        golden = pipeline.reconcile(valid)
        made = pipeline.reconciliation_report(valid, golden)
        n_in, n_out = made["records_in"], made["golden_records_out"]
        if a.stage == "reconcile":
            pipeline.write_golden(golden, a.out, a.limit)
        else:
            report.write_pages(golden, a.out, a.report_date or at[:10], report.load_report(a.validation_report), made, report.load_report(a.health), restates=a.restates, prior=report.load_report(a.prior_kpis))
    if a.report and made:
        sinks.write_report(made, a.report)
    return {"records_in": n_in, "records_out": n_out if a.limit is None else min(n_out, a.limit), **LLM}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        metrics = run(spark or SparkSession.builder.appName("ohmbridge").getOrCreate(), a)
    except Exception as e:
        print(json.dumps({"error": True, "stage": a.stage, "message": type(e).__name__, "detail": str(e)[:500]}), file=sys.stderr)
        return 1
    print(json.dumps({"metrics": metrics}), file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
