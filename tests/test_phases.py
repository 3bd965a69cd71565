import json

import pytest
from pyspark.sql import functions as F

from builders import invoice, model
from tallyfold import phases
from tallyfold.operators import audit, scoring
from tallyfold.sources import model as tables
from tallyfold.sources import store


def folder(spark, tmp_path):
    """Two customers with an order every nine days and a few repeats."""
    rows = []
    for i in range(24):
        day = f"2025-{1 + i // 3:02d}-{2 + 9 * (i % 3):02d}"
        rows.append(invoice(f"{i + 1:06d}", day, customer="C1" if i % 2 else "C2", lines=(("P1", 1 + i % 5, 1000), ("P2", 2, 500))))
    m = model(spark, *rows)
    out = tmp_path / "raw"
    out.mkdir()
    for name in tables.SCHEMAS:
        m.table(name).toPandas().to_csv(out / f"{name}.csv", index=False)
    return str(out)


def test_answers_are_kept(spark, tmp_path):
    asked = []
    states = spark.createDataFrame([("1", '{"a": 1}'), ("2", '{"a": 1}'), ("3", '{"a": 2}')], "invoice_number string, state string")

    def scorer(name, batch):
        return batch.map(lambda s: 0.25 if "1" in s else 0.75)

    path = str(tmp_path / "cache")
    first = scoring.ask_kept(states, "m", scoring.with_usage(scorer), path).collect()
    assert {(r.invoice_number, r.p, r.cached) for r in first} == {("1", 0.25, False), ("2", 0.25, False), ("3", 0.75, False)}
    again = scoring.ask_kept(states, "m", scoring.with_usage(lambda n, b: 1 / 0), path)
    assert {(r.invoice_number, r.p, r.cached, r.model) for r in again.collect()} == {("1", 0.25, True, "m"), ("2", 0.25, True, "m"), ("3", 0.75, True, "m")}
    assert scoring.usage(again).first().asDict() == {"answers": 3, "cached": 3, "input_tokens": 0, "output_tokens": 0}
    assert scoring.usage(scoring.ask_kept(states, "other", scoring.with_usage(scorer), path)).first().input_tokens == 4
    with pytest.raises(Exception, match="within 0..1"):
        scoring.ask_kept(states, "m", scoring.with_usage(lambda n, b: b.map(lambda s: 2.0)), str(tmp_path / "bad"))
    assert not asked


def test_phases_write_their_documents(spark, tmp_path):
    raw, out = folder(spark, tmp_path), str(tmp_path / "out")
    for phase in ("audit", "check", "features", "score", "report"):
        phases.main([phase, "--data", raw, "--out", out, "--env", str(tmp_path / "none")], spark)
    read = {name: json.load(open(f"{out}/{name}.json")) for name in ("audit", "check", "features", "score", "report")}
    judged = {r["id"]: r for r in read["audit"]["results"]}
    assert judged["row_counts"]["status"] == "differs" and judged["invoice_number_order"]["status"] == "match" and read["audit"]["tally"]["error"] == 0
    assert sum(r["n"] for r in read["check"]["routes"] if r["split"] != "all") == 24
    assert spark.read.json(f"{out}/findings").count() == 24 and spark.read.json(f"{out}/feature-rows").count() == 24
    page = open(f"{out}/report.html").read()
    assert page.startswith("<!doctype html>") and "final routes" in page and "This phase was not run" in page
    dry = phases.main(["score", "--data", raw, "--out", out, "--dry-run", "--limit", "1"], spark)
    assert set(dry["score"]["dry_run"]) == {"calls", "tokens"}


def test_env_file(tmp_path):
    (tmp_path / ".env").write_text("# no\nexport A='x y'\nB = 2\nC=\nnothing\nD=kept\n")
    assert phases.load_env(str(tmp_path / ".env"), {"D": "old"}) == {"A": "x y", "B": "2", "C": "", "D": "old"}
    assert phases.load_env(str(tmp_path / "none"), {"D": "old"}) == {"D": "old"}


def test_verdicts_follow_the_expectations(spark):
    m = model(spark, invoice("000001", "2025-03-10"), invoice("000002", "2025-03-10"))
    counts = {r.table_name: r.n for r in audit.row_counts(m).collect()}
    fits = audit.Expected(rows=counts, first_day="2025-03-10", last_day="2025-03-10", schedules=1, near_pairs=1, sent_twice=0)
    got = {r.check_id: r.status for r in audit.verdicts(m, fits).collect()}
    assert got["row_counts"] == got["period"] == got["payment_schedules"] == got["near_duplicates"] == got["times_sent"] == got["commission_rounding"] == "match"
    assert got["splits"] == "info" and len(got) == 19
    tally = {r.status: r.n for r in audit.tally(audit.verdicts(m, fits)).collect()}
    assert sum(tally.values()) == 19 and tally["info"] == 6
    off = audit.verdicts(m, audit.Expected()).where(F.col("check_id") == "row_counts").first()
    assert off.status == "differs" and off.deviations == sum(counts.get(t) != n for t, n in audit.EXPECTED_ROWS.items())


def test_the_model_is_built_once(spark):
    sf = "/root/testdata/sf0.001"
    assert tables.model_of(spark, sf) is tables.model_of(spark, sf)
    assert store.state_of(spark, [f"{sf}/nothing.parquet"])[0][1] == -1
