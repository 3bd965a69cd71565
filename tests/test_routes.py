"""Routes without reasons, and the short cuts of rules, against the plainer ways."""

import random
from collections import Counter

import pytest
from builders import invoice, model

from tallyfold.operators import features, rules
from tallyfold.sources.model import from_tpch
from tallyfold.sources.store import stored


def test_routes_are_those_of_triage(spark):
    tpch = from_tpch(spark, "/root/testdata/sf0.001", stored)
    some = {n: rules.RULES[n] for n in ("invoice_total", "payment_schedule", "party_consistency", "duplicate_lines", "near_duplicate_window")}
    want = {tuple(r) for r in rules.triage(tpch, some).select("invoice_number", "split", "route").collect()}
    got = rules.routes(tpch, some)
    assert {tuple(r) for r in got.collect()} == want and len({r for _, _, r in want}) > 2
    # of what passed, no rule leaves a trace: the routes are a stored table of three columns
    assert got.columns == ["invoice_number", "split", "route"] and got.inputFiles()
    asked = got.where("route = 'model'")
    few = features.of_customers(tpch, asked)
    assert 0 < few.invoices.count() < tpch.invoices.count()
    built = {r.invoice_number: r for r in features.build(few).collect()}
    for r in features.build(tpch).join(asked, "invoice_number", "left_semi").collect():
        assert built[r.invoice_number] == r


def test_routes_raise_for_duplicate_numbers(spark):
    with pytest.raises(Exception, match="duplicate invoice number"):
        rules.routes(model(spark, invoice("000001"), invoice("000001")), {"near_duplicate_window": rules.near_duplicate_window})


def _expected(rows):
    """(current, ref_year, ref_price) by (number, line): all smaller numbers counted anew for each line."""
    out = {}
    for number, line, product, year, _ in rows:
        past = [(n, k, y, p) for n, k, q, y, p in rows if q == product and n < number]

        def top(y, past=past):
            own = [(n, k, p) for n, k, z, p in past if z == y]
            count, first = Counter(p for _, _, p in own), {p: (n, k) for n, k, p in sorted(own, reverse=True)}
            return min(count, key=lambda p: (-count[p], first[p])) if count else None

        current = top(year)
        before = max((y for _, _, y, _ in past if y < year), default=None) if current is None else None
        out[number, line] = (current, before, top(before) if before else None)
    return out


def test_list_prices_against_counting(spark):
    rng = random.Random(3)
    invoices = []
    for i in range(160):
        lines = tuple((rng.choice(["P1", "P2"]), 1, rng.choice([100, 100, 110, 120])) for _ in range(rng.randint(1, 3)))
        # numbers of several chunks; now and then a date that runs against them
        invoices.append(invoice(f"{i * 617:08d}", date=f"{rng.choice([2023, 2024, 2025]) if i % 9 == 0 else 2023 + i // 60}-03-10", lines=lines))
    rows = [(r["invoice_number"], r["line_number"], r["product_id"], r["billing_date"].year, r["unit_price_cents"]) for _, ls, _ in invoices for r in ls]
    got = {(r.invoice_number, r.line_number): (r.current, r.ref_year, r.ref_price) for r in rules.list_prices(model(spark, *invoices)).collect()}
    assert got == _expected(rows)


def test_installments_are_judged_by_sums_only_where_those_are_exact(spark):
    rows = [invoice(f"{i:06d}", schedule="3 installments (30, 60 and 90 days)", lines=(("P1", 1, 1000),)) for i in range(4)]
    (_, _, good), (_, _, swapped), (_, _, shifted), (_, _, uneven) = rows
    for dues, amounts in ((swapped, (333, 334, 333)), (uneven, (335, 332, 333))):
        for d, a in zip(dues, amounts, strict=True):
            d["amount_cents"] = a
    for d, k in zip(shifted, (1, 2, 4), strict=True):
        d["installment_number"] = k
    got = {r.invoice_number: list(r.reasons) for r in rules.payment_schedule(model(spark, *rows)).collect()}
    even = "amounts are not split evenly, larger first"
    assert got == {"000000": [], "000001": [even], "000002": ["installment numbers are not 1..n"], "000003": [even]} and good


def test_triage_has_one_row_for_each_invoice_when_rules_are_shuffled_alike(spark):
    """Each rule's verdicts come out of a join by invoice number; their union is not shuffled by it."""
    tpch = from_tpch(spark, "/root/testdata/sf0.01", stored)
    rows = rules.triage(tpch, {n: rules.RULES[n] for n in ("duplicate_lines", "rebilled_products")}).collect()
    assert len(rows) == len({r.invoice_number for r in rows}) == tpch.invoices.count()
    assert all([x.rule for x in r.results] == ["duplicate_lines", "rebilled_products"] for r in rows)
