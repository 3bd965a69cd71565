"""The nine rules, routing and the summary.

A rule is a function of the model that returns one row per invoice: (invoice_number, outcome, reasons). An invoice sees
only invoices with smaller numbers (by length, then text): of the same customer for repeats, of all for list prices.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.running import chunks_of
from tallyfold.functions.scalars import (
    DUPLICATE_DAYS,
    MAX_YEARLY_CHANGE,
    NEAR_DAYS,
    RATIO_EPSILON,
    SPACING_DAYS,
    add_days,
    days_between,
    installment_part,
    line_commission,
    number_order,
    signature,
    signed_percent,
)
from tallyfold.sources.model import SCHEDULES, Model
from tallyfold.sources.store import dropped, few, plain_unions, stored

NONE = "array<string>"


def _say(pattern: str, *columns) -> Column:
    return F.format_string(pattern, *columns)


def _found(*pairs: tuple[Column, Column]) -> Column:
    """The texts whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, t) for c, t in pairs]))


def _by_line(lines: DataFrame, reasons: Column, order: str = "line_number") -> DataFrame:
    """Reasons of all lines of an invoice, in line order."""
    rows = lines.select("invoice_number", F.struct(F.col(order).alias("at"), reasons.alias("said")).alias("x")).where(F.size("x.said") > 0)
    return rows.groupBy("invoice_number").agg(F.flatten(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["said"])).alias("line_reasons"))


def _verdict(invoices: DataFrame, reasons: Column, found: str = "flag") -> DataFrame:
    said = F.coalesce(reasons, F.array().cast(NONE))
    return invoices.select("invoice_number", F.when(F.size(said) > 0, found).otherwise("pass").alias("outcome"), said.alias("reasons"))


def _concat(*parts: Column) -> Column:
    return F.concat(*[F.coalesce(p, F.array().cast(NONE)) for p in parts])


def narrowed(m: Model, numbers: DataFrame) -> Model:
    """`m` with the invoices, lines and installments of `numbers` (invoice_number) only."""
    of = lambda df: df.join(few(numbers), "invoice_number", "left_semi")
    return dataclasses.replace(m, invoices=of(m.invoices), invoice_lines=of(m.invoice_lines), scheduled_installments=of(m.scheduled_installments))


def _differing(m: Model, suspects: DataFrame, rule: Callable[[Model], DataFrame]) -> DataFrame:
    """`rule` of the suspects; all other invoices pass. A suspect that is none passes by the rule itself."""
    suspects = stored(suspects.select("invoice_number").distinct(), "suspects")
    found = rule(narrowed(m, suspects)).where("outcome <> 'pass'")
    rest = m.invoices.select("invoice_number").join(found.withColumnRenamed("outcome", "found"), "invoice_number", "left")
    return rest.select("invoice_number", F.coalesce("found", F.lit("pass")).alias("outcome"), F.coalesce("reasons", F.array().cast(NONE)).alias("reasons"))


def _numbered(number: Column) -> list[Column]:
    """Aggregates of fixed size that say whether numbers are 1..n: see _in_order."""
    inside = number.between(1, 62)
    bit = F.expr("shiftleft(1L, __at)")
    return [F.count("*").alias("n"), F.bit_or(F.when(inside, bit)).alias("bits"), F.count_if(~F.coalesce(inside, F.lit(False))).alias("beyond")]


def _in_order() -> Column:
    """Numbers are 1..n, for n up to 62; false where that is not known."""
    return F.coalesce((F.col("beyond") == 0) & (F.col("bits") == F.expr("shiftleft(1L, cast(least(n, 62) as int)) - 1") * 2) & (F.col("n") <= 62), F.lit(False))


def _hashes(*columns: Column) -> list[Column]:
    """128 bits of hashes of values and of which are null."""
    parts = [x for c in columns for x in (c, c.isNull())]
    return [F.xxhash64(F.lit(i), *parts) for i in range(2)]


def line_arithmetic(m: Model) -> DataFrame:
    """Quantity at least 1, price over 0, amount = quantity x price."""
    q, p, a = F.col("package_quantity"), F.col("unit_price_cents"), F.col("line_amount_cents")
    said = _found(
        (q < 1, _say("line %d: quantity %d is not positive", "line_number", q)),
        (p <= 0, _say("line %d: price %d is not positive", "line_number", p)),
        (a != q * p, _say("line %d: amount %d is not %d x %d = %d", "line_number", a, q, p, q * p)),
    )
    return _verdict(m.invoices.join(_by_line(m.invoice_lines, said), "invoice_number", "left"), F.col("line_reasons"))


def invoice_total(m: Model) -> DataFrame:
    """Total = sum of lines; line_count = number of lines; lines are numbered 1..n.

    Numbers are gathered only where sums of fixed size don't show that all is well.
    """
    lines = m.invoice_lines.withColumn("__at", F.col("line_number").cast("int")).groupBy("invoice_number").agg(F.sum("line_amount_cents").alias("s"), *_numbered(F.col("line_number")))
    own = m.invoices.select("invoice_number", "invoice_total_cents", "line_count").join(lines, "invoice_number", "left")
    well = _in_order() & (F.col("invoice_total_cents") == F.col("s")) & (F.col("line_count") == F.col("n"))
    return _differing(m, own.where(~F.coalesce(well, F.lit(False))), _invoice_total)


def _invoice_total(m: Model) -> DataFrame:
    lines = m.invoice_lines.groupBy("invoice_number").agg(F.sum("line_amount_cents").alias("s"), F.count("*").alias("k"), F.sort_array(F.collect_list("line_number")).alias("numbers"))
    own = m.invoices.join(lines, "invoice_number", "left").withColumns({"s": F.coalesce("s", F.lit(0)), "k": F.coalesce("k", F.lit(0))})
    numbered = (F.col("k") > 0) & (F.col("numbers") != F.sequence(F.lit(1).cast("long"), F.greatest("k", F.lit(1))))
    said = _found(
        (F.col("k") == 0, F.lit("no lines")),
        (F.col("invoice_total_cents") != F.col("s"), _say("total %d is not the sum of lines %d", "invoice_total_cents", "s")),
        (F.col("line_count") != F.col("k"), _say("line_count %d, but %d lines", "line_count", "k")),
        (numbered, F.concat(F.lit("line numbers "), F.array_join(F.col("numbers").cast(NONE), ", "))),
    )
    return _verdict(own, said)


def commission(m: Model) -> DataFrame:
    """5 % of every line, rounded half up; the invoice's commission is the sum of its lines'."""
    a, c = F.col("line_amount_cents"), F.col("commission_amount_cents")
    by_line = _by_line(m.invoice_lines, _found((c != line_commission(a), _say("line %d: commission %d, expected %d", "line_number", c, line_commission(a)))))
    sums = m.invoice_lines.groupBy("invoice_number").agg(F.sum("commission_amount_cents").alias("s"))
    own = m.invoices.join(sums, "invoice_number", "left").join(by_line, "invoice_number", "left").withColumn("s", F.coalesce("s", F.lit(0)))
    head = _found((F.col("commission_total_cents") != F.col("s"), _say("commission %d is not the sum of lines %d", "commission_total_cents", "s")))
    return _verdict(own, _concat(F.col("line_reasons"), head))


def list_prices(m: Model) -> DataFrame:
    """Lines with `current`, the list price of their product and year as seen before, and `ref` (year, price) of an earlier year.

    The list price is the most frequent price so far, the one seen first among equals. Prices are counted by chunks of
    invoice numbers. A price can only become the list price in a chunk where it reaches the largest count before the
    chunk; where no other one does, the list price holds for the whole chunk, and lines are put in order in the remaining
    chunks only. There a price's count never falls, so the list price is that of the largest (count after the line, first
    seen earlier) among all earlier lines. A year's first lines look back at the earlier years' largest counts.
    """
    year = ["product_id", "year"]
    price, chunk = [*year, "price"], [*year, "chunk"]
    lines = m.invoice_lines.select("invoice_number", "line_number", "product_id", F.year("billing_date").alias("year"), F.col("unit_price_cents").alias("price"))
    lines = lines.where("product_id is not null and year is not null and price is not null and invoice_number is not null").withColumn("chunk", chunks_of(m.invoices))
    so_far = lambda keys: Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)

    counts = lines.groupBy(*price, "chunk").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(so_far(price)), F.lit(0))).withColumn("count", F.col("before") + F.col("n"))
    counts = stored(counts, "price-counts")
    most = stored(counts.groupBy(*chunk).agg(F.max("count").alias("top")).withColumn("top", F.max("top").over(so_far(year))), "price-tops")
    able = stored(counts.join(few(most), chunk).where("top is null or count >= top").select(*price, "chunk"), "price-able")
    leading = few(able.select(*price).distinct())

    # of prices that can lead: their age, and the largest (count, age) by chunk
    leaders = stored(counts.join(leading, price), "price-leaders")
    began = leaders.groupBy(*price).agg(F.min("chunk").alias("chunk"))
    seen = lines.join(few(stored(began, "price-began")), [*price, "chunk"]).groupBy(*price).agg(F.min(F.struct(F.length("invoice_number"), "invoice_number", "line_number")).alias("seen"))
    ages = few(stored(seen.select(*price, (-F.row_number().over(Window.partitionBy(*year).orderBy("seen"))).alias("age")), "price-ages"))
    best = F.struct("count", "age", "price")
    by_chunk = stored(leaders.join(ages, price).groupBy(*chunk).agg(F.max(best).alias("best")), "price-chunks")
    at = most.select(*chunk).join(by_chunk, chunk, "left").withColumn("lead", F.max("best").over(so_far(year))).drop("best")
    others = able.join(at, chunk).where("lead is null or price <> lead.price").select(*chunk).distinct().withColumn("mixed", F.lit(True))
    state = few(stored(at.join(others, chunk, "left").select(*chunk, "lead", F.coalesce("mixed", F.lit(False)).alias("mixed")), "price-states"))

    # lines in order, where the list price may change
    fine = lines.join(state, chunk).where("mixed").join(counts.select(*price, "chunk", "before"), [*price, "chunk"]).join(ages, price, "left")
    rank = F.row_number().over(Window.partitionBy(*price, "chunk").orderBy(*number_order(F.col("invoice_number")), "line_number"))
    fine = stored(fine.withColumn("count", F.col("before") + rank).withColumn("event", F.when(F.col("age").isNotNull(), best)).drop("before", "count", "age"), "price-events")
    inner = Window.partitionBy(*chunk)
    fine = fine.withColumn("rank", F.dense_rank().over(inner.orderBy(*number_order(F.col("invoice_number")))))
    inner = F.max("event").over(inner.orderBy("rank").rangeBetween(Window.unboundedPreceding, -1))
    fine = stored(fine.withColumn("current", F.greatest("lead", inner)).drop("lead", "rank", "mixed"), "price-events")

    # the first lines of a year: the latest year before, by chunks before theirs and by lines of their own chunk
    asked = stored(fine.where("current is null").select(*chunk, "invoice_number").distinct(), "price-first")
    asked = few(asked.select("product_id", F.col("year").alias("own"), F.col("chunk").alias("at"), F.col("invoice_number").alias("of")))
    earlier = by_chunk.join(asked, "product_id").where("year < own and chunk < at").select("own", "product_id", "of", F.struct("year", "best.count", "best.age", "best.price").alias("ref"))
    within = fine.where("event is not null").join(asked, "product_id").where(F.expr("year < own and chunk = at") & (F.struct(F.length("invoice_number"), "invoice_number") < F.struct(F.length("of"), "of")))
    within = within.select("own", "product_id", "of", F.struct("year", "event.count", "event.age", "event.price").alias("ref"))
    refs = earlier.unionByName(within).groupBy("own", "product_id", "of").agg(F.max("ref").alias("ref"))
    refs = few(stored(refs.select("product_id", F.col("own").alias("year"), F.col("of").alias("invoice_number"), "ref"), "price-refs"))
    columns = ["invoice_number", "line_number", "product_id", "year", "price"]
    first = fine.join(refs, ["product_id", "year", "invoice_number"], "left").select(*columns, F.col("current.price").alias("current"), F.when(F.col("current").isNull(), F.col("ref.year")).alias("ref_year"), F.when(F.col("current").isNull(), F.col("ref.price")).alias("ref_price"))
    later = lines.join(state, chunk).where("not mixed").select(*columns, F.col("lead.price").alias("current"), F.lit(None).cast("int").alias("ref_year"), F.lit(None).cast("long").alias("ref_price"))
    return later.unionByName(first)


def price_list(m: Model) -> DataFrame:
    """Unit price = list price of the year; a year's first price is 0 to 10 % a year above the last list price.

    Flags suppress notes; a first price inside the band, or of a new product, is a note.
    """
    at = _say("line %d (%s)", "line_number", "product_id")
    years = F.col("year") - F.col("ref_year")
    # a zero reference: any price but zero is out of the band, zero against zero is a note
    change = F.when(F.col("ref_price") != 0, F.col("price") / F.col("ref_price"))
    most = F.pow(F.lit(1 + MAX_YEARLY_CHANGE), years)
    outside = F.when(F.col("ref_price") == 0, F.col("price") != 0).otherwise((change < 1 - RATIO_EPSILON) | (change > most + RATIO_EPSILON))
    first = F.col("current").isNull()
    flags = _found(
        (~first & (F.col("price") != F.col("current")), F.concat(at, _say(": price %d, list price of %d is %d", "price", "year", "current"))),
        (first & F.col("ref_year").isNotNull() & outside, F.concat(at, _say(": first price %d of %d against %d in %d, ", "price", "year", "ref_price", "ref_year"), F.coalesce(signed_percent(change - 1), F.lit("no ratio")))),
    )
    notes = _found(
        (first & F.col("ref_year").isNull(), F.concat(at, F.lit(": never billed before"))),
        (first & F.col("ref_year").isNotNull() & ~outside, F.concat(at, _say(": first price %d of %d against %d in %d", "price", "year", "ref_price", "ref_year"))),
    )
    lines = list_prices(m).select("invoice_number", F.struct("line_number", flags.alias("flags"), notes.alias("notes")).alias("x"))
    per = lines.where("size(x.flags) > 0 or size(x.notes) > 0").groupBy("invoice_number").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    pick = lambda f: F.flatten(F.transform("xs", lambda x: x[f]))
    own = m.invoices.select("invoice_number").join(per, "invoice_number", "left").select("invoice_number", F.coalesce(pick("flags"), F.array().cast(NONE)).alias("flags"), F.coalesce(pick("notes"), F.array().cast(NONE)).alias("notes"))
    flagged = F.size("flags") > 0
    return own.select("invoice_number", F.when(flagged, "flag").otherwise("pass").alias("outcome"), F.when(flagged, F.col("flags")).otherwise(F.col("notes")).alias("reasons"))


def payment_schedule(m: Model) -> DataFrame:
    """A known schedule with its count, dates 30 days apart, and amounts that sum up and differ by a cent at most.

    Installments are put in order only where sums of fixed size don't show that all is well: numbers 1..n; one first date
    when 30 days are taken off for each installment before; and, of amounts a cent apart, the larger ones first, as then
    the sum of amount x number is the least possible.
    """
    k, amount = F.col("installment_number"), F.col("amount_cents")
    begin = F.unix_date("due_date") - (k - 1) * SPACING_DAYS
    dues = m.scheduled_installments.where("due_date is not null and amount_cents between 0 and 1000000000000000 and installment_number between 1 and 62")
    aggregates = [F.sum("amount_cents").alias("s"), F.sum(amount * k).alias("weighted"), F.min("amount_cents").alias("least"), F.max("amount_cents").alias("most"), F.min(begin).alias("first"), F.max(begin).alias("last")]
    known = dues.withColumn("__at", k.cast("int")).groupBy("invoice_number").agg(*aggregates, *_numbered(k))
    # an installment that is left out above makes its invoice a suspect
    odd = m.scheduled_installments.where("coalesce(due_date is null or not (amount_cents between 0 and 1000000000000000) or not (installment_number between 1 and 62), true)").select("invoice_number")
    own = m.invoices.join(F.broadcast(_spec(m)), "payment_schedule", "left").select("invoice_number", F.unix_date("billing_date").alias("day"), "invoice_total_cents", "want", "first_days").join(known, "invoice_number", "left")
    n, s = F.col("n"), F.col("s")
    base = F.floor(s / n).cast("long")
    more = s - base * n
    even = (F.col("most") - F.col("least") <= 1) & (F.col("weighted") == base * (n * (n + 1) / 2).cast("long") + (more * (more + 1) / 2).cast("long"))
    well = _in_order() & (n == F.col("want")) & (F.col("first") == F.col("last")) & (F.col("first") == F.col("day") + F.col("first_days")) & (s == F.col("invoice_total_cents")) & even
    return _differing(m, own.where(~F.coalesce(well, F.lit(False))).select("invoice_number").unionByName(odd), _payment_schedule)


def _spec(m: Model) -> DataFrame:
    return m.invoices.sparkSession.createDataFrame([(k, *v) for k, v in SCHEDULES.items()], "payment_schedule string, want int, first_days int")


def _payment_schedule(m: Model) -> DataFrame:
    spec = _spec(m)
    order = Window.partitionBy("invoice_number").orderBy("installment_number")
    dues = m.scheduled_installments.select("invoice_number", "installment_number", "due_date", "amount_cents").withColumn("k", F.row_number().over(order))
    head = m.invoices.join(spec, "payment_schedule", "left").select("invoice_number", "billing_date", "payment_schedule", "invoice_total_cents", "want", "first_days")
    size = Window.partitionBy("invoice_number")
    rows = dues.join(head, "invoice_number").withColumns({"n": F.count("*").over(size), "s": F.sum("amount_cents").over(size)})
    due = add_days(F.col("billing_date"), F.col("first_days") + (F.col("k") - 1) * SPACING_DAYS)
    part = installment_part(F.col("s"), F.col("n"), F.col("k"))
    item = F.struct("k", "installment_number", (F.col("amount_cents") != part).alias("uneven"), F.when(F.col("due_date") != due, _say("installment %d: due %s, expected %s", "installment_number", F.col("due_date").cast("string"), due.cast("string"))).alias("late"))
    per = rows.groupBy("invoice_number").agg(F.max("n").alias("n"), F.max("s").alias("s"), F.sort_array(F.collect_list(item)).alias("items"))
    own = head.join(per, "invoice_number", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "s": F.coalesce("s", F.lit(0))})
    misnumbered = F.exists("items", lambda x: x["installment_number"] != x["k"])
    late = F.array_compact(F.transform("items", lambda x: x["late"]))
    whole = F.col("s") == F.col("invoice_total_cents")
    said = _concat(
        _found((F.col("n") != F.col("want"), _say("%d installments, %s has %d", "n", "payment_schedule", "want")), (misnumbered, F.lit("installment numbers are not 1..n"))),
        late,
        _found((~whole, _say("installments sum to %d, total is %d", "s", "invoice_total_cents")), (whole & F.exists("items", lambda x: x["uneven"]), F.lit("amounts are not split evenly, larger first"))),
    )
    return _verdict(own, F.when(F.col("want").isNull(), F.array(F.concat(F.lit("unknown payment_schedule "), F.coalesce("payment_schedule", F.lit("null"))))).otherwise(said))


def party_consistency(m: Model) -> DataFrame:
    """Seller and unit are the customer's; lines and installments repeat the header; products are the catalogue's.

    Whole lines meet their header only where hashes of 128 bits, the least and the largest of an invoice, differ from it.
    """
    fields = [F.col(f) for f in ("billing_date", "customer_id", "seller_id", "business_unit")]
    product = m.products.select("product_id", F.col("product_name").alias("p_name"), F.col("product_category").alias("p_category"), F.col("business_unit").alias("p_unit"), F.lit(True).alias("p_known"))
    lines = m.invoice_lines.join(few(product), "product_id", "left")
    named = F.coalesce((F.col("product_name") == F.col("p_name")) & (F.col("product_category") == F.col("p_category")), F.lit(False))
    ends = lambda hashes, name: [f(h).alias(f"{name}_{f.__name__}{i}") for i, h in enumerate(hashes) for f in (F.min, F.max)]
    by_line = lines.groupBy("invoice_number").agg(*ends(_hashes(*fields, F.col("p_unit")), "line"), F.max(~named).alias("misnamed"))
    by_due = m.scheduled_installments.groupBy("invoice_number").agg(*ends(_hashes(F.col("customer_id")), "due"))
    heads = m.invoices.select("invoice_number", "customer_id", "seller_id", "business_unit", *[h.alias(f"h{i}") for i, h in enumerate(_hashes(*fields, F.col("business_unit")))], *[h.alias(f"c{i}") for i, h in enumerate(_hashes(F.col("customer_id")))])
    apart = lambda name, own: [F.col(f"{name}_{f}{i}") != F.col(f"{own}{i}") for f in ("min", "max") for i in range(2)]
    own = heads.select("invoice_number", "h0", "h1", "c0", "c1").join(by_line, "invoice_number", "left").join(by_due, "invoice_number", "left")
    suspects = own.where(F.coalesce(reduce(lambda a, b: a | b, [*apart("line", "h"), *apart("due", "c"), F.col("misnamed")]), F.lit(False))).select("invoice_number")
    party = m.customers.select("customer_id", F.col("seller_id").alias("c_seller"), F.col("business_unit").alias("c_unit"), F.lit(True).alias("known"))
    odd = heads.join(party, "customer_id", "left").where("known is null or seller_id <> c_seller or business_unit <> c_unit").select("invoice_number")
    return _differing(m, suspects.unionByName(odd), _party_consistency)


def _party_consistency(m: Model) -> DataFrame:
    known = m.customers.select("customer_id", F.col("seller_id").alias("c_seller"), F.col("business_unit").alias("c_unit"), F.lit(True).alias("known"))
    own = m.invoices.join(known, "customer_id", "left")
    header = _found(
        (F.col("known").isNull(), F.concat(F.lit("unknown customer "), F.col("customer_id"))),
        (F.col("seller_id") != F.col("c_seller"), _say("seller %s, the customer's is %s", "seller_id", "c_seller")),
        (F.col("business_unit") != F.col("c_unit"), _say("business unit %s, the customer's is %s", "business_unit", "c_unit")),
    )
    own = own.withColumn("header", header)
    fields = ["billing_date", "customer_id", "seller_id", "business_unit"]
    heads = m.invoices.select("invoice_number", *[F.col(f).alias(f"h_{f}") for f in fields])
    product = m.products.select("product_id", F.col("product_name").alias("p_name"), F.col("product_category").alias("p_category"), F.col("business_unit").alias("p_unit"), F.lit(True).alias("p_known"))
    lines = m.invoice_lines.join(heads, "invoice_number").join(product, "product_id", "left")
    said = _found(
        *[(F.col(f) != F.col(f"h_{f}"), _say(f"line %d: {f} %s, invoice %s", "line_number", F.col(f).cast("string"), F.col(f"h_{f}").cast("string"))) for f in fields],
        (F.col("p_known").isNull(), _say("line %d: unknown product %s", "line_number", "product_id")),
        (F.col("p_unit") != F.col("h_business_unit"), _say("line %d: %s belongs to %s", "line_number", "product_id", "p_unit")),
        ((F.col("product_name") != F.col("p_name")) | (F.col("product_category") != F.col("p_category")), _say("line %d: %s is billed as %s / %s", "line_number", "product_id", "product_name", "product_category")),
    )
    due = m.scheduled_installments.join(heads.select("invoice_number", "h_customer_id"), "invoice_number")
    said_due = _found((F.col("customer_id") != F.col("h_customer_id"), _say("installment %d: customer %s", "installment_number", "customer_id")))
    by_due = _by_line(due, said_due, "installment_number").withColumnRenamed("line_reasons", "due_reasons")
    own = own.join(_by_line(lines, said), "invoice_number", "left").join(by_due, "invoice_number", "left")
    return _verdict(own, _concat(F.col("header"), F.col("line_reasons"), F.col("due_reasons")))


def baskets(m: Model) -> DataFrame:
    """Invoices with the signature of their lines and the sorted set of their products."""
    lines = m.invoice_lines.groupBy("invoice_number").agg(signature(F.col("product_id"), F.col("package_quantity")).alias("signature"), F.sort_array(F.collect_set("product_id")).alias("products"))
    own = m.invoices.join(lines, "invoice_number", "left")
    return own.withColumns({"signature": F.coalesce("signature", F.lit("")), "products": F.coalesce("products", F.array().cast(NONE))})


def customer_order() -> Window:
    return Window.partitionBy("customer_id").orderBy(*number_order(F.col("invoice_number")))


def duplicate_lines(m: Model) -> DataFrame:
    """The same products and quantities as an earlier invoice of the customer at most 7 days before.

    Texts of lines are gathered only for invoices whose customer has another one with the same sums of line hashes.
    """
    line = lambda i: F.sum(F.shiftright(F.xxhash64(F.lit(i), F.concat_ws(" x ", "product_id", F.col("package_quantity").cast("string"))), 24)).alias(f"h{i}")
    lines = m.invoice_lines.groupBy("invoice_number").agg(F.count("*").alias("k"), line(0), line(1))
    sums = [F.coalesce(c, F.lit(0)).alias(c) for c in ("k", "h0", "h1")]
    own = m.invoices.select("invoice_number", "customer_id").join(lines, "invoice_number", "left").select("invoice_number", "customer_id", *sums)
    alike = own.withColumn("alike", F.count("*").over(Window.partitionBy("customer_id", "k", "h0", "h1"))).where("alike > 1 and customer_id is not null")
    return _differing(m, alike, _duplicate_lines)


def _duplicate_lines(m: Model) -> DataFrame:
    own = stored(baskets(m).select("invoice_number", "customer_id", "signature", "billing_date"), "signatures")
    number = F.struct(F.length("invoice_number").alias("k"), "invoice_number")
    of = ["customer_id", "signature"]
    # invoices 0 to 7 days apart meet in the older one's period of 8 days or the one after it
    period = lambda day: F.floor(F.unix_date(day) / (DUPLICATE_DAYS + 1))
    past = own.select(*of, F.col("invoice_number").alias("n"), F.col("billing_date").alias("d"))
    near = past.withColumn("period", F.explode(F.array(period(F.col("d")), period(F.col("d")) + 1)))
    apart = days_between(F.col("d"), F.col("billing_date"))
    earlier = F.struct(F.length("n"), "n") < F.struct(F.length("invoice_number"), "invoice_number")
    hits = own.withColumn("period", period(F.col("billing_date"))).join(near, [*of, "period"]).where(earlier & apart.between(0, DUPLICATE_DAYS)).drop("period")
    # where dates run against numbers, an earlier number may have a later date; only invoices that have such a one look for it
    latest = F.max("billing_date").over(Window.partitionBy(*of).orderBy(number).rowsBetween(Window.unboundedPreceding, -1))
    behind = own.withColumn("latest", latest).where(F.col("latest") > F.col("billing_date")).drop("latest")
    hits = hits.unionByName(behind.join(past, of).where(earlier & (apart < 0)))
    said = F.transform(F.sort_array(F.collect_list(F.struct(F.length("n").alias("k"), "n", "d"))), lambda x: F.concat(F.lit("same products and quantities as "), x["n"], F.lit(" of "), x["d"].cast("string")))
    return _verdict(m.invoices.join(hits.groupBy("invoice_number").agg(said.alias("said")), "invoice_number", "left"), F.col("said"))


def near_previous(m: Model) -> DataFrame:
    """Invoices at most 2 days after the customer's invoice before, with that one: prev (number, date), and the gap in days."""
    own = m.invoices.select("invoice_number", "customer_id", "billing_date")
    prev = F.lag(F.struct("invoice_number", "billing_date")).over(customer_order())
    return own.withColumn("prev", prev).withColumn("gap", days_between(F.col("prev.billing_date"), F.col("billing_date"))).where(F.col("gap") <= NEAR_DAYS).select("invoice_number", "prev", "gap")


def _found_only(m: Model, found: DataFrame, outcome: str = "flag") -> DataFrame:
    """A verdict on all invoices from the reasons of some."""
    return _verdict(m.invoices.select("invoice_number").join(found, "invoice_number", "left"), F.col("said"), outcome)


def rebilled_products(m: Model) -> DataFrame:
    """At most 2 days after the customer's invoice before, with only products of that one."""
    near = stored(near_previous(m), "near")
    numbers = stored(near.select("invoice_number").unionByName(near.select(F.col("prev.invoice_number").alias("invoice_number"))).distinct(), "near")
    bought = m.invoice_lines.join(few(numbers), "invoice_number", "left_semi").groupBy("invoice_number").agg(F.sort_array(F.collect_set("product_id")).alias("products"))
    bought = stored(bought, "near")
    before = bought.select(F.col("invoice_number").alias("prev_number"), F.col("products").alias("prev_products"))
    own = near.withColumn("prev_number", F.col("prev.invoice_number")).join(bought, "invoice_number").join(before, "prev_number")
    hit = (F.size("products") > 0) & (F.size(F.array_except("products", "prev_products")) == 0)
    said = _found((hit, F.concat(F.lit("every product ("), F.array_join("products", ", "), F.lit(") was on "), F.col("prev.invoice_number"), F.lit(" of "), F.col("prev.billing_date").cast("string"))))
    return _found_only(m, own.select("invoice_number", said.alias("said")))


def near_duplicate_window(m: Model) -> DataFrame:
    """At most 2 days after the customer's invoice before: ambiguous."""
    days = F.when(F.col("gap") == 1, "day").otherwise("days")
    near = near_previous(m)
    return _found_only(m, near.select("invoice_number", _found((F.lit(True), _say("%d %s after %s", "gap", days, "prev.invoice_number"))).alias("said")), "ambiguous")


Rule = Callable[[Model], DataFrame]
RULES: dict[str, Rule] = {
    "line_arithmetic": line_arithmetic, "invoice_total": invoice_total, "commission": commission, "price_list": price_list, "payment_schedule": payment_schedule,
    "party_consistency": party_consistency, "duplicate_lines": duplicate_lines, "rebilled_products": rebilled_products, "near_duplicate_window": near_duplicate_window,
}
ROUTES = ["auto_approve", "model", "human_review", "excluded"]
OUTCOMES = ["pass", "flag", "ambiguous"]
SPLITS = ["tune", "test", "demo", "all"]


def evaluate(m: Model, rules: dict[str, Rule] | None = None) -> DataFrame:
    """(invoice_number, rule, outcome, reasons) of every invoice and rule."""
    plain_unions(m.invoices.sparkSession)
    parts = [rule(m).select("invoice_number", F.lit(name).alias("rule"), "outcome", "reasons") for name, rule in (rules or RULES).items()]
    return reduce(DataFrame.unionByName, parts)


def triage(m: Model, rules: dict[str, Rule] | None = None) -> DataFrame:
    """(invoice_number, split, route, results). Sent more than once: excluded; any flag: human_review; any doubt: model.

    Duplicate invoice numbers raise.
    """
    results = evaluate(m, rules).groupBy("invoice_number").agg(F.sort_array(F.collect_list(F.struct("rule", "outcome", "reasons"))).alias("results"))
    some = lambda what: F.exists("results", lambda r: r["outcome"] == what)
    route = F.when(F.col("times_sent") > 1, "excluded").when(some("flag"), "human_review").when(some("ambiguous"), "model").otherwise("auto_approve")
    twice = F.exists("results", lambda r: F.size(F.filter("results", lambda s: s["rule"] == r["rule"])) > 1)
    checked = F.when(twice, F.raise_error(F.concat(F.lit("duplicate invoice number "), F.col("invoice_number"))).cast("string")).otherwise(route)
    return m.invoices.select("invoice_number", m.split().alias("split"), "times_sent").join(results, "invoice_number").select("invoice_number", "split", checked.alias("route"), "results")


def routes(m: Model, rules: dict[str, Rule] | None = None) -> DataFrame:
    """(invoice_number, split, route) of triage(), without the reasons.

    Rules are worked out one after the other, and of each only the invoices that did not pass are stored, so that the
    shuffle files of one rule go before the next one's are written. Duplicate invoice numbers raise.
    """
    found = F.when(F.col("outcome") == "flag", 2).otherwise(1).alias("found")
    parts = [stored(rule(m).where("outcome in ('flag', 'ambiguous')").select("invoice_number", found), "outcomes") for rule in (rules or RULES).values()]
    own = m.invoices.select("invoice_number", "billing_date", "times_sent", F.lit(0).alias("found"), F.lit(1).alias("here"))
    rows = reduce(DataFrame.unionByName, [p.select("invoice_number", F.lit(None).cast("date").alias("billing_date"), F.lit(None).cast("long").alias("times_sent"), "found", F.lit(0).alias("here")) for p in parts], own)
    rows = rows.where("invoice_number is not null").groupBy("invoice_number").agg(F.max("billing_date").alias("billing_date"), F.max("times_sent").alias("times_sent"), F.max("found").alias("found"), F.sum("here").alias("here"))
    route = F.when(F.col("times_sent") > 1, "excluded").when(F.col("found") == 2, "human_review").when(F.col("found") == 1, "model").otherwise("auto_approve")
    checked = F.when(F.col("here") > 1, F.raise_error(F.concat(F.lit("duplicate invoice number "), F.col("invoice_number"))).cast("string")).otherwise(route)
    out = stored(rows.select("invoice_number", m.split().alias("split"), checked.alias("route")), "routes")
    for part in parts:
        dropped(part)
    return out


def _filled(counts: DataFrame, domain: list[str], by: list[str]) -> DataFrame:
    spark = counts.sparkSession
    rows = spark.createDataFrame([tuple(x.split("\t")) for x in domain], ", ".join(f"{c} string" for c in by))
    return rows.join(counts, by, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def route_summary(triaged: DataFrame) -> DataFrame:
    """(split, route, n) over all splits and `all`, zeros included."""
    sets = triaged.groupBy("split", "route").agg(F.count("*").alias("n"))
    whole = sets.groupBy("route").agg(F.sum("n").alias("n")).select(F.lit("all").alias("split"), "route", "n")
    return _filled(sets.unionByName(whole), [f"{s}\t{r}" for s in SPLITS for r in ROUTES], ["split", "route"])


def rule_summary(triaged: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """(split, rule, outcome, n) over all splits and `all`, zeros included; excluded invoices count."""
    long = triaged.select("split", F.explode("results").alias("r")).groupBy("split", F.col("r.rule").alias("rule"), F.col("r.outcome").alias("outcome")).agg(F.count("*").alias("n"))
    whole = long.groupBy("rule", "outcome").agg(F.sum("n").alias("n")).select(F.lit("all").alias("split"), "rule", "outcome", "n")
    return _filled(long.unionByName(whole), [f"{s}\t{r}\t{o}" for s in SPLITS for r in rules or RULES for o in OUTCOMES], ["split", "rule", "outcome"])


def findings(triaged: DataFrame) -> DataFrame:
    """Results that are not a plain pass."""
    return triaged.withColumn("findings", F.filter("results", lambda r: (r["outcome"] != "pass") | (F.size(r["reasons"]) > 0))).drop("results")


def passes_with_notes(triaged: DataFrame) -> DataFrame:
    rows = triaged.select("split", F.explode("results").alias("r"))
    return rows.groupBy("split", F.col("r.rule").alias("rule")).agg(F.count_if((F.col("r.outcome") == "pass") & (F.size("r.reasons") > 0)).alias("n"))
