"""Running aggregates over long keys, in two levels so that no task needs all rows of a key.

Rows of a key are cut into chunks by the invoice number without its last characters; chunks follow each other in invoice
order. A window runs within each chunk, another over the chunks' totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scalars import number_order

DROPPED = 4


def chunk_of(number: Column, dropped: int = DROPPED) -> Column:
    """A value that grows with the invoice order; by default some 10,000 numbers at most share one."""
    size = F.length(number)
    return F.concat(F.lpad(size.cast("string"), 4, "0"), F.substring(number, F.lit(1), F.greatest(size - dropped, F.lit(0))))


#: Chunks that chunks_of() allows, about.
CHUNKS = 5_000


def chunks_of(invoices: DataFrame, number: str = "invoice_number") -> Column:
    """chunk_of() with as many last characters dropped as `invoices` need for at most CHUNKS chunks, or nearly all."""
    drops = list(range(DROPPED, 2 * DROPPED + 10, 2))
    found = invoices.agg(*[F.approx_count_distinct(chunk_of(F.col(number), d)).alias(str(d)) for d in drops]).first()
    return chunk_of(F.col(number), next((d for d in drops if found[str(d)] <= CHUNKS), drops[-1]))


def running_count(df: DataFrame, keys: list[str], order: list[Column], out: str, number: str = "invoice_number") -> DataFrame:
    """`out`: 1, 2, ... within `keys` by `order`, of which the invoice number is the first part."""
    own = df.withColumn("__chunk", chunk_of(F.col(number)))
    totals = own.groupBy(*keys, "__chunk").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "__chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy(*keys, "__chunk").orderBy(*order))
    return own.withColumn(out, rank).join(totals, [*keys, "__chunk"]).withColumn(out, F.col(out) + F.col("__before")).drop("__chunk", "__before")


def running_max(df: DataFrame, keys: list[str], value: Column, out: str, number: str = "invoice_number") -> DataFrame:
    """`out`: the largest `value` of rows with smaller invoice numbers within `keys`; null for the first."""
    own = df.withColumns({"__chunk": chunk_of(F.col(number)), "__value": value})
    totals = own.groupBy(*keys, "__chunk").agg(F.max("__value").alias("__most"))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "__chunk", F.max("__most").over(before).alias("__before"))
    part = Window.partitionBy(*keys, "__chunk")
    own = own.withColumn("__rank", F.dense_rank().over(part.orderBy(*number_order(F.col(number)))))
    own = own.withColumn("__inner", F.max("__value").over(part.orderBy("__rank").rangeBetween(Window.unboundedPreceding, -1)))
    return own.join(totals, [*keys, "__chunk"]).withColumn(out, F.greatest("__inner", "__before")).drop("__chunk", "__value", "__rank", "__inner", "__before")
