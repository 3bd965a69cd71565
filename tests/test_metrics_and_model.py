import json
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyfold.functions import metrics
from tallyfold.functions.running import running_count, running_max
from tallyfold.operators import audit, features, planting, report, rules, scoring
from tallyfold.sources import model as tables

from builders import invoice, model


def scores(spark, *rows):
    return spark.createDataFrame(list(rows), "p double, positive boolean")


@pytest.mark.parametrize(("rows", "want"), [
    ([(0.9, True), (0.1, False)], 1.0), ([(0.1, True), (0.9, False)], 0.0), ([(0.5, True), (0.5, False)], 0.5), ([(0.5, True), (0.5, False), (0.9, True), (0.1, False)], 0.875), ([(0.5, True)], None),
])
def test_auc(spark, rows, want):
    assert metrics.auc(scores(spark, *rows), "p", "positive").first()[0] == want


def test_wilson(spark):
    low, high = metrics.wilson(F.col("k"), F.col("n"))
    got = spark.createDataFrame([(5, 10), (0, 10), (0, 0)], "k long, n long").select(low, F.when(F.col("n") > 0, high)).collect()
    assert round(got[0][0], 4) == 0.2366 and round(got[0][1], 4) == 0.7634 and got[1][0] == 0 and got[2][0] is None


def test_threshold(spark):
    df = scores(spark, *[(p, True) for p in (0.9, 0.8, 0.7, 0.6, 0.5)], (0.95, False))
    assert metrics.choose_threshold(df, "p", "positive", 0.8) == 0.6 and metrics.choose_threshold(df, "p", "positive", 1) == 0.5
    with pytest.raises(ValueError):
        metrics.choose_threshold(df, "p", "positive", 0)
    with pytest.raises(ValueError):
        metrics.choose_threshold(df.where("not positive"), "p", "positive", 0.5)


@pytest.mark.parametrize(("rows", "want"), [([("a", "x", 5), ("a", "y", 5), ("b", "x", 5), ("b", "y", 5)], 0.0), ([("a", "x", 5), ("b", "y", 5)], 1.0), ([("a", "x", 5), ("a", "y", 0), ("b", "y", 5)], 1.0), ([("a", "x", 5)], 0.0)])
def test_cramers_v(spark, rows, want):
    assert abs(metrics.cramers_v(spark.createDataFrame(rows, "a string, b string, n long"), "a", "b", "n").first()[0] - want) < 1e-7


def test_running_aggregates_over_chunks(spark):
    rows = [("k", f"{i:06d}", (i * 7919) % 100) for i in range(1, 300)]
    df = spark.createDataFrame(rows, "k string, invoice_number string, v long").withColumn("invoice_number", F.concat("invoice_number", F.lit("0000")))
    counted = running_count(df, ["k"], [F.col("invoice_number")], "c").orderBy("invoice_number").collect()
    assert [r.c for r in counted] == list(range(1, 300))
    most = running_max(df, ["k"], F.col("v"), "m").orderBy("invoice_number").collect()
    assert [r.m for r in most] == [None, *[max(v for _, _, v in rows[:i]) for i in range(1, 299)]]


def test_loader(spark, tmp_path):
    m = model(spark, invoice("000010"), invoice("000009"))
    with pytest.raises(FileNotFoundError, match="customers"):
        tables.read_csv_set(spark, str(tmp_path))
    for name in tables.SCHEMAS:
        m.table(name).toPandas().to_csv(tmp_path / f"{name}.csv", index=False)
    read = tables.check_model(tables.read_csv_set(spark, str(tmp_path)))
    assert sorted(r[0] for r in read.invoices.select("invoice_number").collect()) == ["000009", "000010"]
    assert tables.bundles(read).where(F.size("lines") == 1).count() == 2
    orphan = model(spark, invoice("000001"))
    orphan.invoice_lines = orphan.invoice_lines.withColumn("invoice_number", F.lit("000404"))
    with pytest.raises(ValueError, match="000404"):
        tables.check_model(orphan)


def test_audit_reports_failures_and_goes_on(spark):
    m = model(spark, invoice("000001"))
    out = {r["id"]: r for r in audit.run(m, {"row_counts": audit.row_counts, "broken": lambda m: 1 / 0, "orphan_counts": audit.orphan_counts, "schema": audit.schema_differences})}
    assert out["broken"]["status"] == "error" and out["orphan_counts"]["status"] == "match" and out["schema"]["status"] == "match"
    m.invoices = m.invoices.drop("times_sent").withColumn("extra", F.lit(1))
    assert {(r.column_name, r.problem) for r in audit.schema_differences(m).collect()} == {("times_sent", "missing"), ("extra", "extra")}


def ambiguous(spark):
    return model(spark, invoice("000001"), invoice("000002", "2025-03-11", lines=(("P2", 1, 500),)))


def test_states_hold_no_identities(spark):
    m = ambiguous(spark)
    rows = features.with_features(rules.triage(m), features.build(m)).where("route = 'model'")
    state = scoring.states(rows, m).first().state
    assert set(json.loads(state)) == {"current", "previous", "comparison", "customer_history"}
    for word in ("000001", "000002", "C1", "S1", "invoice_number", "customer_id"):
        assert f'"{word}' not in state
    with pytest.raises(Exception, match="no previous invoice"):
        scoring.states(features.with_features(rules.triage(m), features.build(m)), m).collect()


def test_cached_answers_are_not_asked_again(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b")], "invoice_number string, state string")
    asked = spark.sparkContext.accumulator(0)

    def scorer(model, states):
        asked.add(len(states))
        return pd.Series([0.5] * len(states))

    first = scoring.ask(df, "m", scorer).cache()
    assert {r.invoice_number: (r.p, r.cached) for r in first.collect()} == {n: (0.5, False) for n in "123"} and asked.value == 2
    again = scoring.ask(df, "m", scorer, first)
    assert all(r.cached for r in again.collect()) and asked.value == 2
    assert not any(r.cached for r in scoring.ask(df, "other", scorer, first).collect())


def test_route_after_the_model(spark):
    got = spark.createDataFrame([(0.38,), (0.39,)], "p double").select(scoring.route_after_model(F.col("p"))).collect()
    assert [r[0] for r in got] == ["auto_approve", "human_review"]
    with pytest.raises(ValueError):
        scoring.route_after_model(F.lit(0.1), 1.5)


def test_planted_cases(spark):
    rows = []
    import datetime

    for c in ("C1", "C2"):
        for i in range(70):
            d = datetime.date(2025, 1, 2) + datetime.timedelta(days=5 * i)
            rows.append((d, c, (("P1", 1 + i % 7, 1000), ("P2", 1 + i % 3, 500), ("P1", 2 + i, 1000))))
            rows.append((datetime.date(2026, 1, 2) + datetime.timedelta(days=3 * i), c, (("P1", 1 + i % 7, 1000), ("P2", 1 + i % 3, 500), ("P1", 2 + i, 1000))))
    m = model(spark, *[invoice(f"{k:06d}", d.isoformat(), c, lines=ls) for k, (d, c, ls) in enumerate(sorted(rows), 1)])
    routes = m.invoices.select("invoice_number", F.lit("auto_approve").alias("route")).cache()
    args = dict(per_label=4, seed=7, weights={0: 0, 1: 3, 2: 2}, changed=2)
    cases = planting.plant(m, routes, **args).cache()
    got = cases.collect()
    assert {(s, k): sum(1 for r in got if (r.split, r.kind) == (s, k)) for s in ("tune", "test") for k in planting.LABELS} == {(s, k): n for s in ("tune", "test") for k, n in {"moved": 4, "split": 2, "rebill": 2, "rebill_changed": 2}.items()}
    used = [n for r in got for n in r.source_invoices]
    assert len(used) == len(set(used)) and all(1 <= r.gap_days <= 2 for r in got)
    for r in got:
        assert (r.current.billing_date - r.previous.billing_date).days == r.gap_days and r.current.line_count == len(r.current.lines) > 0
        assert r.current.invoice_total_cents == sum(x.line_amount_cents for x in r.current.lines)
        if r.kind == "split":
            assert 0 < len(r.previous.lines) and r.previous.invoice_number.endswith("~part")
    assert sorted(r.case_id for r in planting.plant(m, routes, **args).collect()) == sorted(r.case_id for r in got)
    with pytest.raises(ValueError, match="not enough"):
        planting.plant(m, routes, per_label=500, seed=1, weights={1: 1})
    with pytest.raises(ValueError):
        planting.plant(m, routes, per_label=1, seed=1, weights={3: 1})
    scored = planting.score_cases(cases, F.lit(0.5), ["rebill"])
    assert scored.where("kind = 'rebill_changed'").count() == 0
    assert {r.auc for r in planting.kind_against_moved(cases.withColumn("p", F.lit(0.5)), "p").collect()} == {0.5}


def test_kind_shares_and_real_load(spark):
    side = "struct<billing_date:date,lines:array<struct<product_id:string>>>"
    case = lambda split, kind, gap, a, b: (split, kind, gap, (date(2024, 1, 1), [(x,) for x in a]), (date(2024, 1, 1 + gap), [(x,) for x in b]))
    cases = spark.createDataFrame(
        [case("tune", "rebill", 1, "ab", "a"), case("tune", "rebill", 2, "abcd", "a"), case("tune", "moved", 0, "abc", "abd"), case("tune", "moved", 0, "a", "b"), case("test", "split", 1, "a", "b")],
        f"split string, kind string, gap_days int, previous {side}, current {side}",
    )
    got = {(r.split, r.kind): tuple(r)[2:] for r in planting.kind_shares(cases, planting.comparison_score(cases), 0.4).collect()}
    assert len(got) == 8 and got["test", "rebill"] == (0, None, None, None, None)
    assert got["tune", "rebill"] == (2, 1.0, 1.0, pytest.approx(0.325), 0.5)
    assert got["tune", "moved"] == (2, 0.0, 0.5, 0.25, 0.5) and got["test", "split"] == (1, 0.0, 0.0, 0.0, 0.0)
    answers = spark.createDataFrame([("tune", 0.4), ("tune", 0.3), ("demo", 0.9)], "split string, p double")
    assert {tuple(r) for r in planting.real_load(answers, 0.4).collect()} == {("tune", 2, 1, 1), ("test", 0, 0, 0)}


def test_report(spark, tmp_path):
    assert report.format_cell(None) == "—" and "1,000" in report.format_table([{"n": 1000, "s": "x"}])
    assert report.display_path("/elsewhere/secret/out.json", "/project") == "out.json" and report.display_path("/project/a/b", "/project") == "a/b"
    page = report.render({"<Queue>": report.html_table([{"a": "<b>"}]), "Scores": report.histogram_svg([(3, 2)], 0.39)})
    assert "&lt;Queue&gt;" in page and "&lt;b&gt;" in page and "<svg" in page and report.render({}, fragment=True) == ""
    tables.write_summary({"a": 1}, str(tmp_path / "x.json"))
    assert json.loads((tmp_path / "x.json").read_text()) == {"a": 1}
