import random

from tallyfold.operators import features, rules

from builders import DAYS30, invoice, model


def built(spark, *invoices):
    return {r.invoice_number: r.asDict() for r in features.build(model(spark, *invoices)).collect()}


def test_registry_names_the_columns(spark):
    assert features.build(model(spark, invoice("000001"))).columns == ["invoice_number", *features.REGISTRY]


def test_first_invoice_has_nulls(spark):
    f = built(spark, invoice("000001"))["000001"]
    assert f["prev_invoice_number"] is None and f["union_matches_past_basket"] is None and f["tenure_days"] is None
    assert f["prior_invoice_count"] == 0 and f["new_products"] == 1 and f["invoices_last_7_days"] == 0


def test_against_the_invoice_before(spark):
    first = invoice("000001", lines=(("P1", 2, 1000), ("P2", 1, 1000)))
    f = built(spark, first, invoice("000002", "2025-03-12", schedule=DAYS30, lines=(("P1", 1, 1000), ("P1", 1, 1000))))["000002"]
    assert (f["gap_days"], f["shared_products"], f["product_jaccard"], f["shared_same_qty"]) == (2, 1, 0.5, 1)
    assert f["total_ratio"] == 0.6667 and f["same_payment_schedule"] is False and f["union_matches_past_basket"] is False


def test_zero_totals_give_no_ratio(spark):
    f = built(spark, invoice("000001", lines=(("P1", 1, 0),)), invoice("000002", "2025-03-12"))["000002"]
    assert f["total_ratio"] is None and f["total_vs_median"] is None


def test_union_matches_an_earlier_basket(spark):
    both = (("P1", 1, 1000), ("P2", 1, 1000))
    f = built(spark, invoice("000001", lines=both), invoice("000002", "2025-04-01", lines=both[:1]), invoice("000003", "2025-04-02", lines=both[1:]))
    assert f["000003"]["union_matches_past_basket"] is True and f["000002"]["union_matches_past_basket"] is False


def test_history(spark):
    dates = ["2025-01-01", "2025-01-02", "2025-01-12", "2025-01-15"]
    past = [invoice(f"{i:06d}", d, lines=(("P1", 1, t),)) for i, (d, t) in enumerate(zip(dates, (1000, 4000, 2000, 3000), strict=True), 1)]
    f = built(spark, *past, invoice("000005", "2025-01-19", lines=(("P1", 1, 3000), ("P2", 1, 3000))))["000005"]
    assert (f["tenure_days"], f["median_gap_days"], f["prior_short_gap_share"], f["invoices_last_7_days"], f["total_vs_median"], f["new_products"]) == (18, 3.0, 0.3333, 2, 2.4, 1)


def test_no_future_leaks_and_order_does_not_matter(spark):
    rng = random.Random(5)
    days = sorted(rng.choices(range(1, 28), k=9))
    rows = [invoice(f"{i:06d}", f"2025-03-{d:02d}", rng.choice(["C1", "C2"]), lines=tuple((rng.choice(["P1", "P2"]), rng.randint(1, 3), 1000) for _ in range(rng.randint(1, 3)))) for i, d in enumerate(days, 1)]
    whole = built(spark, *rows)
    assert built(spark, *rng.sample(rows, len(rows))) == whole
    routes = {r.invoice_number: r.route for r in rules.triage(model(spark, *rows)).collect()}
    for k in (3, 6):
        assert built(spark, *rows[:k]) == {n: whole[n] for n in list(sorted(whole))[:k]}
        assert {r.invoice_number: r.route for r in rules.triage(model(spark, *rows[:k])).collect()} == {n: routes[n] for n in sorted(routes)[:k]}
