"""The model tier: the state that a scorer sees, a pluggable scorer behind an answer cache, and the route that follows."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.scalars import number_order
from tallyfold.sources.model import Model
from tallyfold.sources.store import stored

from .rules import SPLITS

#: A score below it approves; at or above it, a person reviews.
THRESHOLD = 0.39
QUESTION = {"id": "same_order", "kind": "probability", "text": "Do the two invoices bill the same order?"}
#: (model name, states as JSON) -> probabilities
Scorer = Callable[[str, pd.Series], pd.Series]


def states(selected: DataFrame, m: Model) -> DataFrame:
    """(invoice_number, state) for rows with features: four sections, without ids, names or places.

    Raises when a row has no previous invoice, or one that is not known. `selected` is read several times: hand over a
    stored one. Only lines of selected invoices and those before them are gathered, once.
    """
    numbers = [selected.select(F.col(c).alias("invoice_number")) for c in ("invoice_number", "prev_invoice_number")]
    wanted = numbers[0].unionByName(numbers[1]).where("invoice_number is not null").distinct()
    of = lambda df: df.join(wanted, "invoice_number", "left_semi")
    lines = of(m.invoice_lines).groupBy("invoice_number").agg(F.sort_array(F.collect_list(F.struct("line_number", "product_category", "package_quantity", "unit_price_cents", "line_amount_cents"))).alias("lines"))
    heads = of(m.invoices.select("invoice_number", "billing_date", "from_pending_delivery", "invoice_total_cents", "payment_schedule"))
    pending = stored(heads.join(lines, "invoice_number", "left"), "pending")

    def section(prefix: str) -> Column:
        c = lambda x: F.col(f"{prefix}.{x}")
        return F.struct(c("billing_date").cast("string").alias("billing_date"), c("invoice_total_cents").alias("total_cents"), c("payment_schedule").alias("payment_schedule"), c("from_pending_delivery").alias("from_pending_delivery"), c("lines").alias("lines"))

    own = selected.alias("s").join(pending.alias("c"), F.col("s.invoice_number") == F.col("c.invoice_number")).join(pending.alias("p"), F.col("s.prev_invoice_number") == F.col("p.invoice_number"), "left")
    guard = F.when(F.col("p.invoice_number").isNull() | F.col("c.from_pending_delivery").isNull(), F.raise_error(F.concat(F.lit("no previous invoice or flag for "), F.col("s.invoice_number"))).cast("string"))
    f = lambda *names: F.struct(*[F.col(f"s.{n}").alias(n) for n in names])
    state = F.struct(
        section("c").alias("current"), section("p").alias("previous"),
        f("gap_days", "shared_products", "product_jaccard", "shared_same_qty", "total_ratio", "same_payment_schedule", "union_matches_past_basket").alias("comparison"),
        f("prior_invoice_count", "tenure_days", "median_gap_days", "prior_short_gap_share", "invoices_last_7_days", "total_vs_median", "new_products").alias("customer_history"),
    )
    return own.select(F.col("s.invoice_number").alias("invoice_number"), F.coalesce(guard, F.to_json(state, {"ignoreNullFields": "false"})).alias("state"))


def select_for_model(rows: DataFrame, split: str | None = None, limit: int | None = None) -> DataFrame:
    """Model-routed rows, of one split or all, the first `limit` in invoice order."""
    own = rows.where("route = 'model'")
    own = own.where(F.col("split") == split) if split else own
    own = own.orderBy(*number_order(F.col("invoice_number")))
    return own.limit(limit) if limit else own


def estimate_tokens(df: DataFrame) -> DataFrame:
    """Rows and tokens (a quarter of the characters, rounded up) that scoring would send."""
    return df.agg(F.count("*").alias("calls"), F.coalesce(F.sum(F.ceil(F.length("state") / 4)), F.lit(0)).alias("tokens"))


def cache_key(model: str) -> Column:
    """Of the requested model, the question and the state, in one canonical spelling."""
    head = json.dumps({"model": model, "question": QUESTION}, sort_keys=True)
    return F.sha2(F.concat(F.lit(head), F.lit("\n"), F.col("state")), 256)


def ask(df: DataFrame, model: str, scorer: Scorer, cache: DataFrame | None = None) -> DataFrame:
    """`df` (invoice_number, state) with key, p and cached; equal states are asked once, cached ones never."""
    keyed = df.withColumn("key", cache_key(model))
    wanted = keyed.select("key", "state").dropDuplicates(["key"])
    known = None
    if cache is not None:
        known = cache.select("key", "p").dropDuplicates(["key"])
        wanted = wanted.join(known, "key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "p": scorer(model, batch["state"]).astype(float)})

    answers = wanted.mapInPandas(run, "key string, p double").withColumn("cached", F.lit(False))
    if known is not None:
        answers = answers.unionByName(known.withColumn("cached", F.lit(True)))
    return keyed.join(answers, "key")


CACHE = "key string, requested string, model string, p double, input_tokens long, output_tokens long"
#: (model name, states as JSON) -> the model that answered, p, input_tokens and output_tokens of each state
FullScorer = Callable[[str, pd.Series], pd.DataFrame]


def with_usage(scorer: Scorer) -> FullScorer:
    """A plain scorer that reports itself as the model and a quarter of a state's characters as its tokens."""

    def full(model: str, states: pd.Series) -> pd.DataFrame:
        tokens = states.map(lambda s: -(-len(s) // 4))
        return pd.DataFrame({"model": model, "p": scorer(model, states).astype(float), "input_tokens": tokens, "output_tokens": 0})

    return full


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The answers kept at `path`, JSON lines; none if there is no such folder. Of a key's answers the first by text counts."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    kept = spark.read.schema(CACHE).option("mode", "FAILFAST").json(path) if there else spark.createDataFrame([], CACHE)
    rest = [c for c in kept.columns if c != "key"]
    return kept.where("p between 0 and 1").groupBy("key").agg(F.min(F.struct(*rest)).alias("x")).select("key", "x.*")


def ask_kept(df: DataFrame, model: str, scorer: FullScorer, path: str) -> DataFrame:
    """ask() with answers kept at `path`: new ones are appended before any is used, so a broken run asks none twice.

    Adds the model that answered, its tokens, p and cached. A probability outside 0..1 raises.
    """
    spark = df.sparkSession
    keyed = df.withColumn("key", cache_key(model))
    before = stored(read_cache(spark, path), "answers")
    wanted = keyed.select("key", "state").dropDuplicates(["key"]).join(before, "key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = scorer(model, batch["state"]).reset_index(drop=True)
            if not out["p"].between(0, 1).all():
                raise ValueError("a scorer's probability must be within 0..1")
            yield pd.DataFrame({"key": batch["key"].reset_index(drop=True), "requested": model, **{c: out[c] for c in ("model", "p", "input_tokens", "output_tokens")}})

    wanted.mapInPandas(run, CACHE).write.mode("append").json(path)
    known = before.select("key", F.lit(True).alias("cached"))
    return keyed.join(read_cache(spark, path).drop("requested"), "key").join(known, "key", "left").withColumn("cached", F.coalesce("cached", F.lit(False)))


def usage(answers: DataFrame) -> DataFrame:
    """Answers, how many came from the cache, and the tokens of those that did not, once for each state."""
    once = answers.groupBy("key").agg(F.count("*").alias("n"), F.any_value("cached").alias("cached"), F.any_value("input_tokens").alias("i"), F.any_value("output_tokens").alias("o"))
    fresh = lambda c: F.coalesce(F.sum(F.when(~F.col("cached"), F.col(c))), F.lit(0))
    return once.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("answers"), F.coalesce(F.sum(F.when(F.col("cached"), F.col("n"))), F.lit(0)).alias("cached"), fresh("i").alias("input_tokens"), fresh("o").alias("output_tokens"))


def offline_scorer(model: str, states: pd.Series) -> pd.Series:
    """A stand-in without a network: the likeness of the baskets, less for a longer gap."""

    def one(state: str) -> float:
        c = json.loads(state)["comparison"]
        return max(0.0, min(1.0, (c["product_jaccard"] or 0.0) * (1 - 0.1 * (c["gap_days"] or 0))))

    return states.map(one)


def route_after_model(p: Column, threshold: float = THRESHOLD) -> Column:
    if not 0 <= threshold <= 1:
        raise ValueError("the threshold must be within 0..1")
    return F.when(p < threshold, "auto_approve").otherwise("human_review")


def answer_summary(answers: DataFrame) -> DataFrame:
    """By split and over all: answers, cached ones, median p and those sent to review."""
    what = [F.count("*").alias("n"), F.count_if("cached").alias("cached"), F.percentile("p", F.lit(0.5)).alias("median_p"), F.count_if(F.col("route_after_model") == "human_review").alias("review")]
    by = answers.groupBy("split").agg(*what).unionByName(answers.agg(*what).withColumn("split", F.lit("all")))
    domain = answers.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return domain.join(by, "split", "left").na.fill(0, ["n", "cached", "review"])
