"""Point-in-time features: each invoice against its customer's earlier invoices only.

`invoices_last_7_days` counts by date and expects a customer's dates to follow the invoice order, as the audit's
`number_order_inversions` verifies; everything else goes by invoice order alone.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalars import NEAR_DAYS, days_between, number_order, ratio, rounded
from tallyfold.sources.model import Model
from tallyfold.sources.store import few, stored

from .rules import SPLITS, customer_order

#: Columns of build() in this order (fixed ids), each with its definition; P is the customer's invoice before this one, by
#: number, and the past all the customer's invoices with smaller numbers.
REGISTRY = {
    "prev_invoice_number": "number of P; null without a past",
    "gap_days": "billing date less that of P",
    "shared_products": "size of the intersection of the two product sets",
    "product_jaccard": "intersection over union of the product sets, 4 places",
    "shared_same_qty": "products of the intersection whose quantities, added over lines, agree",
    "total_ratio": "invoice total / total of P, 4 places; null for a total of 0",
    "same_payment_schedule": "whether schedule labels agree with P",
    "union_matches_past_basket": "whether the union of the product sets is the product set of an invoice before P",
    "prior_invoice_count": "size of the past",
    "tenure_days": "billing date less the first of the past",
    "median_gap_days": "median of the gaps within the past",
    "prior_short_gap_share": "part of those gaps of 0, 1 or 2 days, 4 places",
    "invoices_last_7_days": "invoices of the past dated within 7 days of this one",
    "total_vs_median": "invoice total / median total of the past, 4 places",
    "new_products": "products of this invoice on none of the past",
    "line_count": "header column",
    "invoice_total_cents": "header column",
    "payment_schedule": "header column",
}


def build(m: Model) -> DataFrame:
    """invoice_number and the columns of REGISTRY for every invoice."""
    per_product = m.invoice_lines.groupBy("invoice_number", "product_id").agg(F.sum("package_quantity").alias("q"))
    basket = per_product.groupBy("invoice_number").agg(F.sort_array(F.collect_list("product_id")).alias("products"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("product_id", "q")))).alias("quantities"))
    inv = m.invoices.join(basket, "invoice_number", "left")
    none = F.array().cast("array<string>")
    inv = inv.withColumns({"products": F.coalesce("products", none), "quantities": F.coalesce("quantities", F.create_map().cast("map<string,bigint>"))})

    w = customer_order()
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    number = F.struct(F.length("invoice_number").alias("k"), "invoice_number")
    prev = F.lag(F.struct(number.alias("at"), "invoice_number", "billing_date", "products", "quantities", "invoice_total_cents", "payment_schedule")).over(w)
    by_day = Window.partitionBy("customer_id").orderBy(F.datediff("billing_date", F.lit("1970-01-01").cast("date"))).rangeBetween(Window.unboundedPreceding, -8)
    own = inv.withColumns({
        "prev": prev, "gap": days_between(F.lag("billing_date").over(w), F.col("billing_date")), "prior": F.row_number().over(w) - 1,
        "first_date": F.first("billing_date").over(w), "past_total": F.percentile("invoice_total_cents", F.lit(0.5)).over(past), "older": F.count("*").over(by_day),
    })
    own = own.withColumns({"past_gap": F.percentile("gap", F.lit(0.5)).over(past), "gaps": F.count("gap").over(past), "short": F.count(F.when(F.col("gap") <= NEAR_DAYS, 1)).over(past)})

    bought = per_product.join(m.invoices.select("invoice_number", "customer_id"), "invoice_number")
    seen = F.min(number).over(Window.partitionBy("customer_id", "product_id"))
    new = bought.withColumn("seen", seen).where(F.col("seen") == number).groupBy("invoice_number").agg(F.count("*").alias("new_products"))

    has = F.col("prev").isNotNull()
    own = own.withColumn("both", F.when(has, F.sort_array(F.array_union("products", F.col("prev.products")))))
    # the first invoice with these products decides whether any is older than the one before: one row for each basket
    old = inv.groupBy("customer_id", F.col("products").alias("both")).agg(F.min(number).alias("oldest"))
    own = own.join(old, ["customer_id", "both"], "left").withColumn("matched", F.col("oldest") < F.col("prev.at"))

    shared = F.array_intersect("products", F.col("prev.products"))
    same = F.filter(shared, lambda p: F.col("quantities")[p] == F.col("prev.quantities")[p])
    first = F.col("prior") == 0
    return own.join(new, "invoice_number", "left").select(
        "invoice_number",
        F.col("prev.invoice_number").alias("prev_invoice_number"), F.col("gap").alias("gap_days"),
        F.when(has, F.size(shared)).alias("shared_products"), F.when(has, ratio(F.size(shared), F.size("both"))).alias("product_jaccard"),
        F.when(has, F.size(same)).alias("shared_same_qty"), ratio(F.col("invoice_total_cents"), F.col("prev.invoice_total_cents")).alias("total_ratio"),
        F.when(has, F.col("payment_schedule") == F.col("prev.payment_schedule")).alias("same_payment_schedule"),
        F.when(has, F.coalesce("matched", F.lit(False))).alias("union_matches_past_basket"),
        F.col("prior").alias("prior_invoice_count"), F.when(~first, days_between(F.col("first_date"), F.col("billing_date"))).alias("tenure_days"),
        F.col("past_gap").alias("median_gap_days"), F.when(F.col("gaps") > 0, rounded(F.col("short") / F.col("gaps"), 4)).alias("prior_short_gap_share"),
        (F.col("prior") - F.col("older")).alias("invoices_last_7_days"), ratio(F.col("invoice_total_cents"), F.col("past_total")).alias("total_vs_median"),
        F.coalesce("new_products", F.lit(0)).alias("new_products"), "line_count", "invoice_total_cents", "payment_schedule",
    )


def of_customers(m: Model, numbers: DataFrame) -> Model:
    """`m` with the whole histories of the customers of `numbers` (invoice_number): all that their features depend on."""
    who = m.invoices.join(few(numbers.select("invoice_number")), "invoice_number", "left_semi").select(F.col("customer_id").alias("__of")).distinct()
    heads = stored(m.invoices.join(few(stored(who, "customers")), F.col("customer_id").eqNullSafe(F.col("__of")), "left_semi"), "histories")
    lines = m.invoice_lines.select("invoice_number", "product_id", "package_quantity").join(few(heads.select("invoice_number")), "invoice_number", "left_semi")
    return replace(m, invoices=heads, invoice_lines=stored(lines, "history-lines"))


def with_features(triaged: DataFrame, features: DataFrame) -> DataFrame:
    """Triage and features side by side; an invoice without features raises."""
    both = triaged.join(features.withColumn("__has", F.lit(True)), "invoice_number", "left")
    missing = F.raise_error(F.concat(F.lit("no features for "), F.col("invoice_number"))).cast("boolean")
    return both.where(F.coalesce("__has", missing)).drop("__has")


def summary(rows: DataFrame) -> DataFrame:
    """Of model-routed rows, by split and over all: counts, medians and shares of the main features."""
    own = rows.where("route = 'model'")
    aggregates: list[Column] = [F.count("*").alias("n")]
    aggregates += [F.percentile(c, F.lit(0.5)).alias(f"median_{c}") for c in ("gap_days", "product_jaccard", "total_ratio", "total_vs_median")]
    aggregates += [F.avg(F.col(c).cast("int")).alias(f"share_{c}") for c in ("same_payment_schedule", "union_matches_past_basket")]
    by = own.groupBy("split").agg(*aggregates).unionByName(own.agg(*aggregates).withColumn("split", F.lit("all")))
    domain = rows.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return domain.join(by, "split", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def latest_first(invoices: DataFrame) -> DataFrame:
    return invoices.orderBy(*[c.desc() for c in number_order(F.col("invoice_number"))])
