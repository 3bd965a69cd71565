"""Hand-built invoice models; amounts are worked out here, not by the code under test."""

import datetime

from tallyfold.sources.model import SCHEMAS, Model

UPFRONT, DAYS30 = "Upfront", "30 Days"
THREE, FOUR = "3 installments (30, 60 and 90 days)", "4 installments (Upfront, 30, 60 and 90 days)"
OFFSETS = {UPFRONT: [0], DAYS30: [30], THREE: [30, 60, 90], FOUR: [0, 30, 60, 90]}
CUSTOMERS = [("C1", "S1", "Agro"), ("C2", "S2", "Agro"), ("C9", "S9", "Home")]
PRODUCTS = [("P1", "foliar 1 L", "foliar", "Agro"), ("P2", "foliar 5 L", "foliar", "Agro"), ("P9", "soil 2 kg", "soil", "Home")]


def day(text):
    return datetime.date.fromisoformat(text)


def invoice(number, date="2025-03-10", customer="C1", schedule=UPFRONT, sent=1, lines=(("P1", 10, 1000),), **changes):
    """(header, lines, installments) as dicts; `changes` replaces header fields."""
    seller, unit = next((s, u) for c, s, u in CUSTOMERS if c == customer)
    names = {p: (n, c) for p, n, c, _ in PRODUCTS}
    rows = []
    for i, (p, q, price) in enumerate(lines, 1):
        amount = q * price
        rows.append(dict(invoice_number=number, line_number=i, billing_date=day(date), customer_id=customer, seller_id=seller, business_unit=unit, product_id=p, product_name=names[p][0], product_category=names[p][1], package_quantity=q, unit_price_cents=price, line_amount_cents=amount, commission_amount_cents=round(amount / 20 + 1e-9)))
    total = sum(r["line_amount_cents"] for r in rows)
    head = dict(invoice_number=number, billing_date=day(date), billing_month=date[:7], customer_id=customer, seller_id=seller, business_unit=unit, payment_schedule=schedule, line_count=len(rows), invoice_total_cents=total, commission_total_cents=sum(r["commission_amount_cents"] for r in rows), first_delivery_month=None, last_delivery_month=None, times_sent=sent, from_pending_delivery=False)
    offsets = OFFSETS.get(schedule, [0])
    parts = [0] * len(offsets)
    for cent in range(total % len(offsets)):
        parts[cent] += 1
    dues = [dict(invoice_number=number, customer_id=customer, installment_number=i + 1, due_date=day(date) + datetime.timedelta(days=o), amount_cents=total // len(offsets) + parts[i]) for i, o in enumerate(offsets)]
    return head | changes, rows, dues


def model(spark, *invoices):
    def frame(name, rows):
        names = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMAS[name])

    heads = [h for h, _, _ in invoices]
    customers = [dict(customer_id=c, customer_name=c, segment="seg", city="x", state="y", seller_id=s, business_unit=u, first_billing_date=None, last_billing_date=None, invoice_count=0, total_sales_cents=0) for c, s, u in CUSTOMERS]
    products = [dict(product_id=p, product_name=n, product_category=c, business_unit=u) for p, n, c, u in PRODUCTS]
    sellers = [dict(seller_id=s, business_unit=u, territory="t", territory_city_count=1, customer_count=1) for _, s, u in CUSTOMERS]
    return Model(frame("invoices", heads), frame("invoice_lines", [r for _, ls, _ in invoices for r in ls]), frame("scheduled_installments", [d for _, _, ds in invoices for d in ds]), frame("customers", customers), frame("products", products), frame("sellers", sellers), frame("monthly_sales", []), test_from="2026-01-01", demo_from="2026-09-01")
