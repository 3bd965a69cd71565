"""The seven tables of the invoice model: their schemas, a CSV loader with checks, and the same tables from TPC-H-like data.

All monetary columns are whole cents. Nothing is inferred: invoice numbers keep their zeros, months stay text.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.scalars import add_days, installment_part, line_commission, split_of

from .store import few, state_of, stored

# Columns of the delivered tables.
SCHEMAS = {
    "invoices": "invoice_number string, billing_date date, billing_month string, customer_id string, seller_id string, business_unit string, payment_schedule string, line_count long, invoice_total_cents long, commission_total_cents long, first_delivery_month string, last_delivery_month string, times_sent long, from_pending_delivery boolean",
    "invoice_lines": "invoice_number string, line_number long, billing_date date, customer_id string, seller_id string, business_unit string, product_id string, product_name string, product_category string, package_quantity long, unit_price_cents long, line_amount_cents long, commission_amount_cents long",
    "scheduled_installments": "invoice_number string, customer_id string, installment_number long, due_date date, amount_cents long",
    "customers": "customer_id string, customer_name string, segment string, city string, state string, seller_id string, business_unit string, first_billing_date date, last_billing_date date, invoice_count long, total_sales_cents long",
    "products": "product_id string, product_name string, product_category string, business_unit string",
    "sellers": "seller_id string, business_unit string, territory string, territory_city_count long, customer_count long",
    "monthly_sales": "month string, business_unit string, seller_id string, invoice_count long, sales_cents long, commission_cents long",
}
# Keys, references and schedules of the delivered tables.
KEYS = {
    "invoices": ["invoice_number"], "invoice_lines": ["invoice_number", "line_number"], "scheduled_installments": ["invoice_number", "installment_number"],
    "customers": ["customer_id"], "products": ["product_id"], "sellers": ["seller_id"],
}
#: (child, parent, column) of the referential checks.
REFERENCES = [
    ("invoice_lines", "invoices", "invoice_number"), ("scheduled_installments", "invoices", "invoice_number"), ("invoices", "customers", "customer_id"),
    ("invoices", "sellers", "seller_id"), ("invoice_lines", "products", "product_id"), ("customers", "sellers", "seller_id"), ("scheduled_installments", "customers", "customer_id"),
]
#: label: (installments, days to the first)
SCHEDULES = {
    "Upfront": (1, 0),
    "30 Days": (1, 30),
    "3 installments (30, 60 and 90 days)": (3, 30),
    "4 installments (Upfront, 30, 60 and 90 days)": (4, 0),
}
TEST_FROM, DEMO_FROM = "2000-01-01", "2001-01-01"


@dataclass
class Model:
    invoices: DataFrame
    invoice_lines: DataFrame
    scheduled_installments: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    monthly_sales: DataFrame
    test_from: str = TEST_FROM
    demo_from: str = DEMO_FROM

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def split(self, day: str = "billing_date"):
        return split_of(F.col(day), self.test_from, self.demo_from)

    def register(self) -> None:
        """Temporary views of the tables' own names."""
        for name in SCHEMAS:
            self.table(name).createOrReplaceTempView(name)


def read_csv_set(spark: SparkSession, folder: str) -> Model:
    """The seven CSV files of `folder`; missing ones are named before anything is read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = {name: f"{folder}/{name}.csv" for name in SCHEMAS}
    missing = [p for p in paths.values() if not hadoop(p).getFileSystem(conf).exists(hadoop(p))]
    if missing:
        raise FileNotFoundError(f"missing: {', '.join(missing)}")
    read = spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    return Model(**{name: read.schema(SCHEMAS[name]).csv(path) for name, path in paths.items()})


def check_model(model: Model) -> Model:
    """Raises on nulls in keys, on duplicate keys and on lines or installments without an invoice."""
    for name, keys in KEYS.items():
        df = model.table(name)
        bad = df.where(" or ".join(f"{k} is null" for k in keys))
        if not bad.isEmpty():
            raise ValueError(f"{name}: a null in {', '.join(keys)}")
        if not df.groupBy(*keys).count().where("count > 1").isEmpty():
            raise ValueError(f"{name}: duplicate {', '.join(keys)}")
    for child in ("invoice_lines", "scheduled_installments"):
        orphan = model.table(child).join(model.invoices, "invoice_number", "left_anti").select("invoice_number").first()
        if orphan:
            raise ValueError(f"{child}: unknown invoice {orphan[0]}")
    if not model.invoices.where("from_pending_delivery is null").isEmpty():
        raise ValueError("invoices: from_pending_delivery is not a boolean")
    return model


def bundles(model: Model) -> DataFrame:
    """One row per invoice with its lines and installments nested in order; raises as check_model does."""
    check_model(model)
    lines = model.invoice_lines.groupBy("invoice_number").agg(F.sort_array(F.collect_list(F.struct("line_number", "product_id", "package_quantity", "unit_price_cents", "line_amount_cents"))).alias("lines"))
    dues = model.scheduled_installments.groupBy("invoice_number").agg(F.sort_array(F.collect_list(F.struct("installment_number", "due_date", "amount_cents"))).alias("installments"))
    return model.invoices.join(lines, "invoice_number", "left").join(dues, "invoice_number", "left")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_summary(document: dict, path: str) -> None:
    """A small result document, from the driver."""
    with open(path, "w") as out:
        json.dump(document, out, indent=2, default=str)


#: The raw tables of from_tpch().
RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
#: Models of this process, by application and state of the raw files.
_MODELS: dict[tuple, Model] = {}


def model_of(spark: SparkSession, sf_dir: str) -> Model:
    """from_tpch() with its large tables stored once a session, and anew when the raw files have changed."""
    key = (spark.sparkContext.applicationId, sf_dir, state_of(spark, [f"{sf_dir}/{t}.parquet" for t in RAW]))
    if key not in _MODELS:
        _MODELS[key] = from_tpch(spark, sf_dir, stored)
    return _MODELS[key]


def from_tpch(spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame, str], DataFrame] = lambda df, kind: df) -> Model:
    """The model over orders and lineitem, with deviations spread over it by the keys so that every rule has cases.

    `keep` may store the tables that the others are made of. An invoice is an order; its number is the date and the order key, so that number order is date order. Products are
    part types by region; sellers are nations; schedules follow the order priority, of which one has no known schedule.
    """
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    place = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("seller_id"), F.col("r_name").alias("business_unit"))
    party = read("customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    schedule = F.create_map(*[F.lit(x) for pair in zip(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"), SCHEDULES, strict=True) for x in pair])
    # keys only are shuffled; names and numbers are spelt from them afterwards
    keys = read("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.col("o_orderdate").cast("date").alias("billing_date"))
    keys = keys.join(read("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))

    def spelt(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey")).withColumns({
            "invoice_number": F.concat(F.date_format("billing_date", "yyyyMMdd"), F.lit("-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")),
            "customer_id": F.col("o_custkey").cast("string"),
        })

    # rows that agree in these columns give the same lines, whatever their order; of the ship dates only the ends count
    item = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.col("l_shipdate").cast("date").alias("ship_date"))
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    raw = F.round(F.col("l_extendedprice") * 100).cast("long")
    supplier = read("supplier").join(F.broadcast(place.withColumnRenamed("seller_id", "other_seller")), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "other_seller")
    own = (
        item.withColumn("line_number", F.row_number().over(order).cast("long"))
        .join(keys.select("o_orderkey", "billing_date", "o_custkey", "c_nationkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(few(read("part").select("p_partkey", "p_type")), F.col("l_partkey") == F.col("p_partkey"))
        .join(few(supplier), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    own = spelt(own)
    quantity = F.col("l_quantity").cast("long")
    list_price = (10000 + 500 * (F.year("billing_date") - 1992) + 37 * F.length("p_type")).cast("long")
    price = F.when(F.col("l_partkey") % 10 == 0, F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)")).otherwise(list_price)
    amount = F.when(F.col("l_partkey") % 20 == 1, raw).otherwise(F.col("package_quantity") * F.col("unit_price_cents"))
    commission = F.when(F.col("l_partkey") % 25 == 0, F.floor(F.col("line_amount_cents") * 5 / F.lit(100)).cast("long")).otherwise(line_commission(F.col("line_amount_cents")))
    lines = (
        own.withColumns({"package_quantity": quantity, "unit_price_cents": price})
        .withColumn("line_amount_cents", amount)
        .select(
            "o_orderkey", "invoice_number", "line_number", "billing_date", "customer_id",
            F.when(F.col("l_suppkey") % 40 == 0, F.col("other_seller")).otherwise(F.col("seller_id")).alias("seller_id"), "business_unit",
            F.concat("p_type", F.lit("@"), "business_unit").alias("product_id"),
            F.concat("p_type", F.when(F.col("l_partkey") % 30 == 0, " X").otherwise("")).alias("product_name"), F.col("p_type").alias("product_category"),
            "package_quantity", "unit_price_cents", "line_amount_cents", commission.alias("commission_amount_cents"),
            "ship_date",
        )
    )
    lines = keep(lines, "invoice-lines")
    sums = lines.groupBy("o_orderkey").agg(
        F.count("*").alias("lines"), F.sum("line_amount_cents").alias("amount"), F.sum("commission_amount_cents").alias("commission"),
        F.min("ship_date").alias("first_ship"), F.max("ship_date").alias("last_ship"),
    )
    key = F.col("o_orderkey")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    invoices = spelt(keys.join(sums, "o_orderkey", "left")).select(
        "invoice_number", "billing_date", F.date_format("billing_date", "yyyy-MM").alias("billing_month"), "customer_id", "seller_id", "business_unit",
        F.coalesce(schedule[F.col("o_orderpriority")], F.col("o_orderpriority")).alias("payment_schedule"),
        (zero("lines") + F.when(key % 97 == 0, 1).otherwise(0)).alias("line_count"),
        F.when(key % 10 == 0, F.round(F.col("o_totalprice") * 100).cast("long")).otherwise(zero("amount")).alias("invoice_total_cents"),
        (zero("commission") + F.when(key % 17 == 0, 1).otherwise(0)).alias("commission_total_cents"),
        F.date_format("first_ship", "yyyy-MM").alias("first_delivery_month"), F.date_format("last_ship", "yyyy-MM").alias("last_delivery_month"),
        F.when(key % 500 == 0, 2).otherwise(1).cast("long").alias("times_sent"),
        (F.col("billing_date") >= F.lit(DEMO_FROM).cast("date")).alias("from_pending_delivery"),
        key.alias("o_orderkey"),
    )

    invoices = keep(invoices, "invoices")
    spec = spark.createDataFrame([(k, *v) for k, v in SCHEDULES.items()], "payment_schedule string, installments int, first_days int")
    dues = (
        invoices.join(spec, "payment_schedule", "left")
        .withColumns({"installments": F.coalesce("installments", F.lit(1)), "first_days": F.coalesce("first_days", F.lit(0))})
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("installments"))))
        .select(
            "invoice_number", "customer_id", F.col("k").cast("long").alias("installment_number"),
            add_days(F.col("billing_date"), F.col("first_days") + (F.col("k") - 1) * 30 + F.when(F.col("o_orderkey") % 41 == 0, 1).otherwise(0)).alias("due_date"),
            (installment_part(F.col("invoice_total_cents"), F.col("installments"), F.col("k")) + F.when((F.col("o_orderkey") % 43 == 0) & (F.col("k") == 1), 1).otherwise(0)).alias("amount_cents"),
        )
    )
    whole = invoices.groupBy("customer_id").agg(F.min("billing_date").alias("first_billing_date"), F.max("billing_date").alias("last_billing_date"), F.count("*").alias("n"), F.sum("invoice_total_cents").alias("total_sales_cents"))
    customers = party.select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"),
        F.col("seller_id").alias("city"), F.col("business_unit").alias("state"), "seller_id", "business_unit", "c_custkey",
    ).join(whole, "customer_id", "left").select(
        "customer_id", "customer_name", "segment", "city", "state", "seller_id", "business_unit", "first_billing_date", "last_billing_date",
        (F.col("n") + F.when(F.col("c_custkey") % 50 == 0, 1).otherwise(0)).alias("invoice_count"), "total_sales_cents",
    )
    customers = keep(customers, "customers")
    products = read("part").select("p_type").distinct().crossJoin(read("region").select("r_name")).select(
        F.concat("p_type", F.lit("@"), "r_name").alias("product_id"), F.col("p_type").alias("product_name"), F.col("p_type").alias("product_category"), F.col("r_name").alias("business_unit"),
    )
    by_seller = party.groupBy("seller_id").agg(F.count("*").alias("customer_count"))
    sellers = place.join(by_seller, "seller_id", "left").select("seller_id", "business_unit", F.col("business_unit").alias("territory"), F.lit(1).cast("long").alias("territory_city_count"), zero("customer_count").alias("customer_count"))
    monthly = invoices.groupBy(F.col("billing_month").alias("month"), "business_unit", "seller_id").agg(
        F.count("*").alias("invoice_count"), F.sum("invoice_total_cents").alias("sales_cents"), F.sum("commission_total_cents").alias("commission_cents"),
    ).where("not (month = '1996-02' and seller_id like '%1')").withColumn("sales_cents", F.col("sales_cents") + F.when(F.col("month") == "1997-03", 1).otherwise(0))
    return Model(invoices.drop("o_orderkey"), lines.drop("o_orderkey", "ship_date"), dues, customers, products, sellers, monthly)


#: from_tpch() for DuckDB: common table expressions to stand before a query.
MODEL_SQL = """
WITH place AS (SELECT n_nationkey, n_name AS seller_id, r_name AS business_unit FROM nation JOIN region ON n_regionkey = r_regionkey),
party AS (SELECT c.*, p.seller_id, p.business_unit FROM customer c JOIN place p ON c_nationkey = n_nationkey),
heads AS (
  SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m%d') || '-' || lpad(o_orderkey::VARCHAR, 12, '0') AS invoice_number,
    o_orderdate::DATE AS billing_date, strftime(o_orderdate, '%Y-%m') AS billing_month, o_custkey::VARCHAR AS customer_id, seller_id, business_unit,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Upfront' WHEN '2-HIGH' THEN '30 Days' WHEN '3-MEDIUM' THEN '3 installments (30, 60 and 90 days)'
      WHEN '4-NOT SPECIFIED' THEN '4 installments (Upfront, 30, 60 and 90 days)' ELSE o_orderpriority END AS payment_schedule
  FROM orders JOIN party ON o_custkey = c_custkey
), l0 AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line_number FROM lineitem
), l1 AS (
  SELECT l0.*, p_type, h.invoice_number, h.billing_date, h.customer_id, h.seller_id, h.business_unit, sp.seller_id AS other_seller,
    l_quantity::BIGINT AS package_quantity, round(l_extendedprice * 100)::BIGINT AS raw,
    CASE WHEN l_partkey % 10 = 0 THEN round(l_extendedprice * 100)::BIGINT // l_quantity::BIGINT ELSE 10000 + 500 * (year(h.billing_date) - 1992) + 37 * length(p_type) END AS unit_price_cents
  FROM l0 JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN place sp ON s_nationkey = sp.n_nationkey JOIN heads h ON l_orderkey = h.o_orderkey
), l2 AS (SELECT *, CASE WHEN l_partkey % 20 = 1 THEN raw ELSE package_quantity * unit_price_cents END AS line_amount_cents FROM l1),
invoice_lines AS (
  SELECT l_orderkey, invoice_number, line_number, billing_date, customer_id, CASE WHEN l_suppkey % 40 = 0 THEN other_seller ELSE seller_id END AS seller_id, business_unit,
    p_type || '@' || business_unit AS product_id, p_type || CASE WHEN l_partkey % 30 = 0 THEN ' X' ELSE '' END AS product_name, p_type AS product_category,
    package_quantity, unit_price_cents, line_amount_cents,
    CASE WHEN l_partkey % 25 = 0 THEN line_amount_cents * 5 // 100 ELSE (line_amount_cents * 5 + 50) // 100 END AS commission_amount_cents
  FROM l2
), sums AS (SELECT l_orderkey, count(*) AS n, sum(line_amount_cents)::BIGINT AS amount, sum(commission_amount_cents)::BIGINT AS commission FROM invoice_lines GROUP BY 1),
invoices AS (
  SELECT o_orderkey, invoice_number, billing_date, billing_month, customer_id, seller_id, business_unit, payment_schedule,
    coalesce(n, 0) + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS line_count,
    CASE WHEN o_orderkey % 10 = 0 THEN round(o_totalprice * 100)::BIGINT ELSE coalesce(amount, 0) END AS invoice_total_cents,
    coalesce(commission, 0) + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS commission_total_cents,
    CASE WHEN o_orderkey % 500 = 0 THEN 2 ELSE 1 END::BIGINT AS times_sent, billing_date >= DATE '2001-01-01' AS from_pending_delivery,
    CASE WHEN billing_date < DATE '2000-01-01' THEN 'tune' WHEN billing_date < DATE '2001-01-01' THEN 'test' ELSE 'demo' END AS split
  FROM heads LEFT JOIN sums ON o_orderkey = l_orderkey
), spec(payment_schedule, installments, first_days) AS (
  VALUES ('Upfront', 1, 0), ('30 Days', 1, 30), ('3 installments (30, 60 and 90 days)', 3, 30), ('4 installments (Upfront, 30, 60 and 90 days)', 4, 0)
), scheduled_installments AS (
  SELECT invoice_number, customer_id, k AS installment_number,
    billing_date + (first_days + (k - 1) * 30 + CASE WHEN o_orderkey % 41 = 0 THEN 1 ELSE 0 END)::INT AS due_date,
    invoice_total_cents // m + CASE WHEN k <= invoice_total_cents % m THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 43 = 0 AND k = 1 THEN 1 ELSE 0 END AS amount_cents
  FROM (SELECT *, unnest(range(1, m + 1)) AS k FROM (SELECT i.*, coalesce(installments, 1) AS m, coalesce(s.first_days, 0) AS first_days FROM invoices i LEFT JOIN spec s USING (payment_schedule)))
), whole AS (
  SELECT customer_id, min(billing_date) AS first_billing_date, max(billing_date) AS last_billing_date, count(*) AS n, sum(invoice_total_cents)::BIGINT AS total_sales_cents FROM invoices GROUP BY 1
), customers AS (
  SELECT c_custkey::VARCHAR AS customer_id, c_name AS customer_name, c_mktsegment AS segment, seller_id, business_unit, first_billing_date, last_billing_date,
    n + CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS invoice_count, total_sales_cents
  FROM party LEFT JOIN whole ON c_custkey::VARCHAR = whole.customer_id
), products AS (SELECT p_type || '@' || r_name AS product_id, p_type AS product_name, p_type AS product_category, r_name AS business_unit FROM (SELECT DISTINCT p_type FROM part), region),
sellers AS (SELECT seller_id, business_unit FROM place),
monthly_sales AS (
  SELECT billing_month AS month, business_unit, seller_id, count(*) AS invoice_count,
    sum(invoice_total_cents)::BIGINT + CASE WHEN billing_month = '1997-03' THEN 1 ELSE 0 END AS sales_cents, sum(commission_total_cents)::BIGINT AS commission_cents
  FROM invoices WHERE NOT (billing_month = '1996-02' AND seller_id LIKE '%1') GROUP BY billing_month, business_unit, seller_id
)
"""
