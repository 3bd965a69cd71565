import pytest
from pyspark.sql import functions as F

from tallyfold.functions.scalars import installment_part, line_commission, strict_date
from tallyfold.operators import rules

from builders import DAYS30, FOUR, THREE, day, invoice, model


def outcomes(spark, rule, *invoices):
    return {r.invoice_number: (r.outcome, r.reasons) for r in rules.RULES[rule](model(spark, *invoices)).collect()}


def test_clean_invoice_passes_every_rule(spark):
    m = model(spark, invoice("000001", lines=(("P1", 10, 1000), ("P2", 3, 2501))))
    assert all(r.outcome == "pass" for r in rules.evaluate(m).collect())


def test_commission_rounds_half_up(spark):
    got = spark.createDataFrame([(9,), (10,), (29,), (30,), (343570,)], "a long").select(line_commission(F.col("a"))).collect()
    assert [r[0] for r in got] == [0, 1, 1, 2, 17179]


@pytest.mark.parametrize(("total", "n", "want"), [(100, 3, [34, 33, 33]), (101, 4, [26, 25, 25, 25]), (771270, 3, [257090] * 3), (500, 1, [500])])
def test_installment_split(spark, total, n, want):
    got = spark.range(1, n + 1).select(installment_part(F.lit(total), F.lit(n), F.col("id"))).collect()
    assert sorted((r[0] for r in got), reverse=True) == want


def test_strict_dates(spark):
    ok = spark.createDataFrame([("2025-02-28",)], "d string").select(strict_date(F.col("d"))).first()[0]
    assert ok == day("2025-02-28")
    for bad in ("2025-02-30", "2025-13-01", "2025-2-3", "2025"):
        with pytest.raises(Exception):  # noqa: B017
            spark.createDataFrame([(bad,)], "d string").select(strict_date(F.col("d"))).collect()


def test_line_arithmetic(spark):
    head, lines, dues = invoice("000001", lines=(("P1", 10, 1000), ("P2", 0, 0)))
    lines[0]["line_amount_cents"] = 9999
    outcome, reasons = outcomes(spark, "line_arithmetic", (head, lines, dues))["000001"]
    assert outcome == "flag" and len(reasons) == 3 and reasons[0].startswith("line 1")


def test_invoice_total(spark):
    none = invoice("000001", lines=())
    wrong = invoice("000002", line_count=3, invoice_total_cents=5)
    twice = invoice("000003", lines=(("P1", 1, 1000), ("P2", 1, 1000)))
    twice[1][1]["line_number"] = 1
    got = outcomes(spark, "invoice_total", none, wrong, twice)
    assert [len(got[n][1]) for n in ("000001", "000002", "000003")] == [1, 2, 1]


@pytest.mark.parametrize(("price", "outcome", "notes"), [(1000, "pass", 1), (999, "flag", 1), (1100, "pass", 1), (1101, "flag", 1)])
def test_price_band(spark, price, outcome, notes):
    got = outcomes(spark, "price_list", invoice("000001", "2025-03-10"), invoice("000002", "2026-03-10", lines=(("P1", 1, price),)))
    assert got["000002"][0] == outcome and len(got["000002"][1]) == notes


@pytest.mark.parametrize(("price", "outcome"), [(1210, "pass"), (1211, "flag")])
def test_price_band_over_a_gap_year(spark, price, outcome):
    assert outcomes(spark, "price_list", invoice("000001", "2023-03-10"), invoice("000002", "2025-03-10", lines=(("P1", 1, price),)))["000002"][0] == outcome


@pytest.mark.parametrize(("prices", "current"), [([1200, 1000, 1200], 1200), ([1000, 1200], 1000), ([1000, 1200, 1200], 1200)])
def test_list_price_is_the_mode_first_seen_among_equals(spark, prices, current):
    past = [invoice(f"{i:06d}", lines=(("P1", 1, p),)) for i, p in enumerate(prices, 1)]
    got = rules.list_prices(model(spark, *past, invoice("000099"))).where("invoice_number = '000099'").first()
    assert got.current == current


def test_list_price_ignores_the_invoice_itself_and_zero_references(spark):
    got = outcomes(spark, "price_list", invoice("000001", lines=(("P1", 1, 1000), ("P1", 1, 2000))), invoice("000002", lines=(("P2", 1, 0),)), invoice("000003", "2026-01-01", lines=(("P2", 1, 5),)), invoice("000004", "2027-01-01", lines=(("P2", 1, 0),)))
    assert got["000001"][0] == "pass" and got["000003"][0] == "flag" and got["000004"][0] == "flag"


def test_list_price_when_dates_run_against_numbers(spark):
    got = outcomes(spark, "price_list", invoice("000001", "2024-01-01", lines=(("P1", 1, 1000),)), invoice("000002", "2026-01-01", lines=(("P1", 1, 1100),)), invoice("000003", "2025-01-01", lines=(("P1", 1, 1101),)))
    assert got["000003"][0] == "flag" and "2024" in got["000003"][1][0]


@pytest.mark.parametrize("schedule", [DAYS30, THREE, FOUR])
def test_payment_schedules_pass(spark, schedule):
    assert outcomes(spark, "payment_schedule", invoice("000001", schedule=schedule, lines=(("P1", 1, 1000),)))["000001"] == ("pass", [])


def test_payment_schedule_failures(spark):
    unknown = invoice("000001", schedule="weekly")
    late = invoice("000002", schedule=THREE)
    late[2][1]["due_date"] = day("2025-06-01")
    uneven = invoice("000003", schedule=THREE, lines=(("P1", 1, 100),))
    uneven[2][0]["amount_cents"], uneven[2][2]["amount_cents"] = 33, 34
    short = invoice("000004", schedule=THREE)
    short[2].pop()
    got = outcomes(spark, "payment_schedule", unknown, late, uneven, short)
    assert [len(got[f"00000{i}"][1]) for i in (1, 2, 3, 4)] == [1, 1, 1, 2]


def test_party_consistency(spark):
    head, lines, dues = invoice("000001")
    lines[0] |= {"seller_id": "S2", "product_name": "else"}
    dues[0]["customer_id"] = "C2"
    strange = invoice("000002", customer_id="C7")
    got = outcomes(spark, "party_consistency", (head, lines, dues), strange)
    assert len(got["000001"][1]) == 3 and got["000002"][1][0] == "unknown customer C7"


@pytest.mark.parametrize(("date", "customer", "outcome"), [("2025-03-17", "C1", "flag"), ("2025-03-18", "C1", "pass"), ("2025-03-11", "C2", "pass")])
def test_duplicate_lines(spark, date, customer, outcome):
    lines = (("P1", 10, 1000), ("P2", 1, 500))
    got = outcomes(spark, "duplicate_lines", invoice("000001", lines=lines), invoice("000002", date, customer, lines=lines[::-1]))
    assert got["000002"][0] == outcome


@pytest.mark.parametrize(("date", "lines", "rebilled", "near"), [
    ("2025-03-12", (("P1", 3, 1000),), "flag", "ambiguous"), ("2025-03-13", (("P1", 3, 1000),), "pass", "pass"),
    ("2025-03-11", (("P1", 3, 1000), ("P2", 1, 500)), "pass", "ambiguous"), ("2025-03-11", (), "pass", "ambiguous"),
])
def test_rules_on_the_invoice_before(spark, date, lines, rebilled, near):
    pair = invoice("000001"), invoice("000002", date, lines=lines)
    assert outcomes(spark, "rebilled_products", *pair)["000002"][0] == rebilled
    assert outcomes(spark, "near_duplicate_window", *pair)["000002"][0] == near


def test_number_order_is_by_length_first(spark):
    got = outcomes(spark, "near_duplicate_window", invoice("9", "2025-03-10"), invoice("10", "2025-03-11"))
    assert got["10"][0] == "ambiguous" and got["9"][0] == "pass"


def test_routes_and_summaries(spark):
    m = model(spark, invoice("000001", sent=2, line_count=9), invoice("000002", "2025-03-11", lines=(("P2", 1, 500),)), invoice("000003", customer="C2", line_count=9), invoice("000004", "2026-02-01", "C9", lines=(("P9", 1, 500),)))
    triaged = rules.triage(m).cache()
    assert {r.invoice_number: r.route for r in triaged.collect()} == {"000001": "excluded", "000002": "model", "000003": "human_review", "000004": "auto_approve"}
    routes = {(r.split, r.route): r.n for r in rules.route_summary(triaged).collect()}
    assert len(routes) == 16 and routes["all", "excluded"] == 1 and routes["demo", "model"] == 0 and routes["test", "auto_approve"] == 1
    by_rule = {(r.split, r.rule, r.outcome): r.n for r in rules.rule_summary(triaged).collect()}
    assert len(by_rule) == 4 * 9 * 3 and by_rule["all", "invoice_total", "flag"] == 2
    assert rules.triage(m, {"commission": rules.commission}).select(F.size("results").alias("k")).distinct().collect()[0].k == 1


def test_duplicate_numbers_raise(spark):
    with pytest.raises(Exception, match="duplicate invoice number"):
        rules.triage(model(spark, invoice("000001"), invoice("000001"))).collect()


def test_queries_over_all_rules(spark):
    from tallyfold.plans.queries import QUERIES, SOME
    from tallyfold.sources.model import from_tpch

    sf = "/root/testdata/sf0.001"
    m = from_tpch(spark, sf)
    others = ["line_arithmetic", "invoice_total", "party_consistency"]
    assert not set(others) & set(SOME)
    flagged = rules.evaluate(m, {n: rules.RULES[n] for n in others}).where("outcome = 'flag'").select("invoice_number").distinct()
    routes = QUERIES["routes"](spark, sf).join(flagged, "invoice_number").groupBy("route").count().collect()
    assert routes and {r.route for r in routes} <= {"human_review", "excluded"}


def test_findings_query_counts_what_did_not_pass(spark):
    from tallyfold.plans.queries import QUERIES
    from tallyfold.sources.model import model_of

    sf = "/root/testdata/sf0.001"
    failed = rules.evaluate(model_of(spark, sf)).groupBy("invoice_number").agg(F.count_if(F.col("outcome") != "pass").alias("want"))
    rows = QUERIES["findings"](spark, sf).join(failed, "invoice_number", "left").collect()
    assert rows and all(r.n_findings == r.want for r in rows)
    noted = rules.findings(rules.triage(model(spark, invoice("000001")))).first()
    assert [f.outcome for f in noted.findings] == ["pass"]  # a note of a passed rule stays a finding
