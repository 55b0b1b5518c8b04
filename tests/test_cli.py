import json

from ohmbridge.plans import cli, report
from test_sources import AT, raw  # noqa: F401


def last(capsys):
    return json.loads(capsys.readouterr().err.strip().splitlines()[-1])


def test_stages_by_command_line(spark, raw, tmp_path, capsys):  # noqa: F811
    p = lambda n: str(tmp_path / n)
    assert cli.main(["ingest", "--in", raw, "--out", p("canonical"), "--ingested-at", AT], spark) == 0
    n = last(capsys)["metrics"]["records_out"]
    assert n == 8 + 5 + 4 and spark.read.text(p("canonical")).count() == n
    assert cli.main(["validate", "--in", p("canonical"), "--out", p("valid"), "--report", p("validation.json")], spark) == 0
    v = json.loads((tmp_path / "validation.json").read_text())
    assert v["records_in"] == n and sum(s["records"] for s in v["per_source"].values()) == n
    assert cli.main(["reconcile", "--in", p("valid"), "--out", p("golden"), "--report", p("reconciliation.json"), "--limit", "4"], spark) == 0
    assert spark.read.text(p("golden")).count() == 4
    (tmp_path / "prior.json").write_text(json.dumps({"chargers_deployed": 1, "est_uptime_pct": 50.0}))
    assert cli.main(["report", "--in", p("valid"), "--out", p("pages"), "--restates", "2024-01-01", "--prior-kpis", p("prior.json"), "--report-date", "2024-06-01"], spark) == 0
    pages = {f.name: f.read_text() for f in (tmp_path / "pages").iterdir()}
    assert sorted(pages) == ["compliance_report.csv", "compliance_report.html", "customers.html", "dashboard.html", "safety.html"]
    assert "RESTATEMENT,Chargers deployed" in pages["compliance_report.csv"] and "2024-01-01" in pages["compliance_report.html"]
    capsys.readouterr()
    assert cli.main(["ingest", "--in", p("nowhere"), "--out", p("x")], spark) == 1
    assert last(capsys)["error"] is True


def test_safety_page_lists_all_states(spark, raw, tmp_path, capsys, monkeypatch):  # noqa: F811
    p = lambda n: str(tmp_path / n)
    held, write = {}, report.write_pages
    monkeypatch.setattr(report, "write_pages", lambda *a, **k: held.update(write(*a, **k)) or held)
    assert cli.main(["ingest", "--in", raw, "--out", p("canonical"), "--ingested-at", AT], spark) == 0
    assert cli.main(["validate", "--in", p("canonical"), "--out", p("valid"), "--report", p("validation.json")], spark) == 0
    assert cli.main(["report", "--in", p("valid"), "--out", p("pages"), "--report-date", "2024-06-01"], spark) == 0
    page = (tmp_path / "pages/safety.html").read_text()
    assert held["health_states"].get("HEALTHY") and all(page.count(f"<tr><td>{s or ''}</td>") == n for s, n in held["health_states"].items())


def test_summaries_fall_back():
    k = {"chargers_deployed": 2, "active_chargers": 1, "est_uptime_pct": None, "sessions_count": 3, "energy_delivered_kwh": 4.0, "data_completeness_pct": 0.5, "anomalies_total": 0, "chronic_failure_sites": 0}

    def broken(text):
        raise RuntimeError

    plain, tried, said = report.summaries(k, {}, {}), report.summaries(k, {}, {}, broken), report.summaries(k, {}, {}, str.upper)
    assert plain == tried and not any(s["reworded"] for s in tried) and all(s["reworded"] for s in said)
    assert report.percent(0.837) == "83.7%" and report.number(None) == "N/A" and report.restated_rows({"est_uptime_pct": 0.5}, {"est_uptime_pct": 60.0}) == [("Est. fleet uptime (%)", "60.0", "50.0", "-10.0")]
