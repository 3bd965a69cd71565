"""Planted cases: labelled pairs of invoices, built from clean ones, to choose and judge a threshold with.

Kinds: `moved` (a later order of the customer, dated closer: a new order), `split` (one invoice in two), `rebill` (part of
an invoice again) and `rebill_changed` (part of it with other quantities): the same order. Every split draws one list of
gaps; new and same orders follow the same list. Sources are never used twice, and none is of the demo split.

All choices are hashes of the seed and the keys, so the candidates are drawn by Spark and a run can be repeated: every
customer's invoices are taken in pairs, each pair has one role, and within a kind and gap the smallest hashes win.
"""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalars import DUPLICATE_DAYS, NEAR_DAYS, add_days, days_between, line_commission, rounded
from tallyfold.sources.model import Model
from tallyfold.sources.store import dropped, stored

from .rules import customer_order

LABELS = {"moved": "new_order", "split": "same_order", "rebill": "same_order", "rebill_changed": "same_order"}
LINE = ["product_id", "product_name", "product_category", "package_quantity", "unit_price_cents", "line_amount_cents", "commission_amount_cents"]


def gap_lists(per_label: int, seed: int, weights: dict[int, float], splits: list[str]) -> dict[str, list[int]]:
    """A list of `per_label` gaps for every split, drawn by weight."""
    if per_label < 1:
        raise ValueError("per_label must be positive")
    used = {g: w for g, w in sorted(weights.items()) if w > 0}
    if not used:
        raise ValueError("no gap has a weight")
    if any(not 0 <= g <= NEAR_DAYS for g in used):
        raise ValueError(f"gaps must be within 0..{NEAR_DAYS} days")
    return {s: random.Random(f"{seed}/{s}").choices(list(used), list(used.values()), k=per_label) for s in splits}


def quotas(lists: dict[str, list[int]], changed: int) -> list[tuple[str, str, int, int]]:
    """(split, kind, gap, cases): gaps alternate between split and rebill, moved takes them all, changed the first ones."""
    out: Counter = Counter()
    for split, gaps in lists.items():
        for i, gap in enumerate(gaps):
            out[split, "moved", gap] += 1
            out[split, "split" if i % 2 == 0 else "rebill", gap] += 1
            if i < changed:
                out[split, "rebill_changed", gap] += 1
    return [(*k, n) for k, n in out.items()]


def _signature(lines: str) -> Column:
    return F.array_join(F.array_sort(F.transform(lines, lambda x: F.concat_ws(" x ", x["product_id"], x["package_quantity"].cast("string")))), ", ")


def _numbered(lines: Column) -> Column:
    """Lines with numbers 1, 2, ..."""
    return F.transform(lines, lambda x, i: F.struct((i + 1).cast("long").alias("line_number"), *[x[c].alias(c) for c in LINE]))


def _invoice(number: Column, day: Column, lines: Column) -> Column:
    total = lambda f: F.aggregate(lines, F.lit(0).cast("long"), lambda acc, x: acc + x[f])
    return F.struct(number.alias("invoice_number"), day.alias("billing_date"), F.size(lines).cast("long").alias("line_count"), total("line_amount_cents").alias("invoice_total_cents"), total("commission_amount_cents").alias("commission_total_cents"), lines.alias("lines"))


def plant(m: Model, routes: DataFrame, per_label: int, seed: int, weights: dict[int, float], changed: int = 0) -> DataFrame:
    """(case_id, kind, label, split, source_invoices, gap_days, customer_id, previous, current); too few candidates raise.

    Invoices in `previous` and `current` are structs with their lines; they have no installments.
    """
    if not 0 <= changed <= per_label:
        raise ValueError("changed must be within 0..per_label")
    splits = ["tune", "test"]
    lists = gap_lists(per_label, seed, weights, splits)
    want = quotas(lists, changed)
    spark = m.invoices.sparkSession

    h = lambda *c: F.xxhash64(F.lit(seed), *c)
    # all choices need the products and quantities of lines only: those are gathered once, whole lines of taken cases at the end
    few = ["product_id", "package_quantity"]
    grouped = lambda lines, *c: lines.groupBy("invoice_number").agg(F.sort_array(F.collect_list(F.struct("line_number", *c))).alias("lines"))
    baskets = stored(grouped(m.invoice_lines, *few), "baskets")
    own = m.invoices.select("invoice_number", "customer_id", "billing_date", m.split().alias("split")).join(baskets.select("invoice_number", F.size("lines").alias("size")), "invoice_number").join(routes.select("invoice_number", "route"), "invoice_number")
    own = own.withColumn("rank", F.row_number().over(customer_order()) - 1)
    pair = F.floor(F.col("rank") / 2)
    own = own.withColumn("role", F.pmod(h("customer_id", pair), F.lit(3)))
    following = F.lead(F.struct("invoice_number", "billing_date", "split", "route")).over(customer_order())
    own = own.withColumn("next", following).where("route = 'auto_approve' and split <> 'demo'")

    gaps = spark.createDataFrame([(s, k, g, n) for s, k, g, n in want], "split string, kind string, gap_days int, cases int")
    kinds = F.when(F.col("role") == 0, "moved").when(F.col("role") == 1, F.when(F.pmod(h("invoice_number", F.lit("kind")), F.lit(2)) == 0, "split").otherwise("rebill")).otherwise("rebill_changed")
    drawn = own.withColumn("kind", kinds).join(F.broadcast(gaps), ["split", "kind"])  # at most 4 kinds x 3 gaps x 2 splits

    # one gap for each source, so that no source is used twice
    pick = F.row_number().over(Window.partitionBy("invoice_number").orderBy(h("invoice_number", "gap_days")))
    drawn = drawn.withColumn("pick", pick).where("pick = 1").withColumn("day", add_days(F.col("billing_date"), F.col("gap_days")))
    kind, size = F.col("kind"), F.col("size")
    moved = (F.col("next.route") == "auto_approve") & (F.col("next.split") == F.col("split")) & (F.year("next.billing_date") == F.year("billing_date")) & (F.col("rank") % 2 == 0) & (days_between(F.col("billing_date"), F.col("next.billing_date")) > F.col("gap_days"))
    sound = F.when(kind == "moved", F.coalesce(moved, F.lit(False))).otherwise(size >= 2)
    stays = (m.split("day") == F.col("split")) & (F.year("day") == F.year("billing_date"))
    base = F.when(kind == "moved", F.col("next.invoice_number")).otherwise(F.col("invoice_number"))
    drawn = stored(drawn.where(sound & stays).select("invoice_number", "customer_id", "billing_date", "split", "kind", "gap_days", "cases", "day", "size", base.alias("base")), "drawn")

    def built(rows: DataFrame, lines: DataFrame, fields: list[str]) -> DataFrame:
        """`rows` with the lines of their two invoices, before and after."""
        shuffled = F.array_sort(F.transform("lines", lambda x: F.struct(h("invoice_number", x["line_number"]).alias("at"), x.alias("line"))))
        most = F.when(kind == "rebill_changed", size).otherwise(size - 1)
        k = 1 + F.pmod(h("invoice_number", F.lit("k")), F.greatest(most, F.lit(1))).cast("int")
        part = F.filter("lines", lambda x: F.array_contains("chosen", x["line_number"]))
        rest = F.filter("lines", lambda x: ~F.array_contains("chosen", x["line_number"]))

        def other(x: Column) -> Column:
            q = x["package_quantity"]
            new = F.when(q >= 2, 1 + F.pmod(h("invoice_number", x["line_number"], F.lit("q")), F.greatest(q - 1, F.lit(1)))).otherwise(2).cast("long")
            values = {"package_quantity": new}
            if "unit_price_cents" in fields:
                amount = new * x["unit_price_cents"]
                values |= {"line_amount_cents": amount, "commission_amount_cents": line_commission(amount)}
            return F.struct(x["line_number"].alias("line_number"), *[values.get(c, x[c]).alias(c) for c in fields])

        whole = rows.join(lines, "invoice_number")
        near = whole.where(kind == "moved").join(lines.select(F.col("invoice_number").alias("base"), F.col("lines").alias("after")), "base").withColumn("before", F.col("lines"))
        alone = whole.where(kind != "moved").withColumn("chosen", F.transform(F.slice(shuffled, F.lit(1), k), lambda x: x["line"]["line_number"]))
        after = F.when(kind == "split", rest).when(kind == "rebill", part).otherwise(F.transform(part, other))
        alone = alone.withColumns({"before": F.when(kind == "split", part).otherwise(F.col("lines")), "after": after}).drop("chosen")
        return near.unionByName(alone).drop("lines")

    found = built(drawn, baskets, few).withColumns({"sig": _signature("after"), "sig_before": _signature("before")}).where(F.col("sig") != F.col("sig_before"))
    found = stored(found.withColumn("code", F.xxhash64("sig")).drop("before", "after", "sig_before"), "found")

    # what the customer already had within a week before the planted invoice: met by codes, judged by the texts
    texts = baskets.select(F.col("invoice_number").alias("past"), _signature("lines").alias("past_sig"))
    past = m.invoices.select(F.col("invoice_number").alias("past"), "customer_id", F.col("billing_date").alias("past_day")).join(texts.select("past", F.xxhash64("past_sig").alias("code")), "past")
    earlier = F.struct(F.length("past"), "past") < F.struct(F.length("invoice_number"), "invoice_number")
    met = found.select("invoice_number", "customer_id", "day", "code").join(past, ["customer_id", "code"]).where(earlier & days_between(F.col("past_day"), F.col("day")).between(0, DUPLICATE_DAYS))
    met = stored(met.select("invoice_number", "past"), "met")
    repeats = met.join(found.select("invoice_number", "sig"), "invoice_number").join(texts, "past").where("sig = past_sig").select("invoice_number").distinct()
    sound_ones = found.drop("sig", "code").join(repeats, "invoice_number", "left_anti")

    order = Window.partitionBy("split", "kind", "gap_days").orderBy(h("invoice_number"), "invoice_number")
    taken = sound_ones.withColumn("k", F.row_number().over(order)).where((F.col("k") <= F.col("cases")) & (F.col("k") <= max(n for *_, n in want)))
    number = F.row_number().over(Window.partitionBy("split", "kind").orderBy("gap_days", "k"))
    taken = stored(taken.withColumn("number", number), "taken")

    # as many as the quotas ask for, at most
    sources = F.broadcast(taken.select("invoice_number").unionByName(taken.select(F.col("base").alias("invoice_number"))).distinct())
    whole = built(taken, grouped(m.invoice_lines.join(sources, "invoice_number", "left_semi"), *LINE), LINE)
    whole = whole.withColumns({"before": _numbered(F.col("before")), "after": _numbered(F.col("after"))})
    suffix = F.when(kind == "moved", "~nearer").when(kind == "split", "~rest").when(kind == "rebill", "~again").otherwise("~altered")
    cases = whole.select(
        F.concat("kind", F.lit(" "), F.col("number").cast("string"), F.lit(" of "), "split").alias("case_id"), "kind",
        F.when(kind == "moved", LABELS["moved"]).otherwise(LABELS["split"]).alias("label"), "split",
        F.when(kind == "moved", F.array("invoice_number", "base")).otherwise(F.array("invoice_number")).alias("source_invoices"), "gap_days", "customer_id",
        _invoice(F.when(kind == "split", F.concat("invoice_number", F.lit("~part"))).otherwise(F.col("invoice_number")), F.col("billing_date"), F.col("before")).alias("previous"),
        _invoice(F.concat("base", suffix), F.col("day"), F.col("after")).alias("current"),
    )
    have = {(r.split, r.kind): r.n for r in taken.groupBy("split", "kind").agg(F.count("*").alias("n")).collect()}
    for table in (drawn, found, met, baskets):
        dropped(table)
    needed: Counter = Counter()
    for s, kd, _, n in want:
        needed[s, kd] += n
    for (s, kd), n in needed.items():
        if have.get((s, kd), 0) < n:
            raise ValueError(f"not enough {kd} candidates in {s}: {have.get((s, kd), 0)} of {n}")
    return cases


def rebilled(cases: DataFrame) -> Column:
    """Whether the rule on rebilled products would send a case's current invoice to a person."""
    of = lambda side: F.array_distinct(F.transform(f"{side}.lines", lambda x: x["product_id"]))
    return (days_between(F.col("previous.billing_date"), F.col("current.billing_date")) <= NEAR_DAYS) & (F.size(of("current")) > 0) & (F.size(F.array_except(of("current"), of("previous"))) == 0)


def score_cases(cases: DataFrame, p: Column, flag_kinds: list[str]) -> DataFrame:
    """(split, kind, p, positive): flagged kinds are positive; an unflagged rebill_changed is a probe and left out."""
    unknown = set(flag_kinds) - set(LABELS)
    if unknown or not flag_kinds or set(flag_kinds) == set(LABELS):
        raise ValueError("flag some kinds, but not all")
    own = cases.where((F.col("kind") != "rebill_changed") | F.lit("rebill_changed" in flag_kinds))
    return own.select("split", "kind", p.alias("p"), F.col("kind").isin(flag_kinds).alias("positive"))


def kind_against_moved(cases: DataFrame, score: str) -> DataFrame:
    """The AUC of every kind against moved, by split."""
    from tallyfold.functions.metrics import auc

    kinds = [k for k in LABELS if k != "moved"]
    long = cases.withColumn("against", F.explode(F.when(F.col("kind") == "moved", F.array(*[F.lit(k) for k in kinds])).otherwise(F.array("kind"))))
    return auc(long.withColumn("positive", F.col("kind") != "moved"), score, "positive", ["split", "against"])


def comparison_score(cases: DataFrame) -> Column:
    """The offline scorer's p of a case: the likeness of its two baskets, less for a longer gap."""
    of = lambda side: F.transform(f"{side}.lines", lambda x: x["product_id"])
    union = F.size(F.array_union(of("previous"), of("current")))
    likeness = F.when(union > 0, rounded(F.size(F.array_intersect(of("previous"), of("current"))) / union, 4)).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), likeness * (1 - 0.1 * F.col("gap_days"))))


def kind_shares(cases: DataFrame, p: Column, threshold: float) -> DataFrame:
    """By split and kind: cases, the rule's share, the share of rule or p >= threshold, median p and the share of p >= threshold.

    Every split and kind has a row; without cases the shares are null.
    """
    own = cases.select("split", "kind", rebilled(cases).alias("rule"), p.alias("p")).withColumn("flagged", F.col("p") >= threshold)
    share = lambda c: rounded(F.avg(c.cast("int")), 6)
    by = own.groupBy("split", "kind").agg(
        F.count("*").alias("n"), share(F.col("rule")).alias("rule_share"), share(F.col("rule") | F.col("flagged")).alias("review_share"),
        F.percentile("p", F.lit(0.5)).alias("median_p"), share(F.col("flagged")).alias("flagged_share"),
    )
    domain = cases.sparkSession.createDataFrame([(s, k) for s in ("tune", "test") for k in LABELS], "split string, kind string")
    return domain.join(by, ["split", "kind"], "left").na.fill(0, ["n"])


def gap_weights(m: Model) -> dict[int, float]:
    """How often real invoices of tune and test follow the one before by 0, 1 .. NEAR_DAYS days; by gap, all gaps included."""
    before = F.lag("billing_date").over(customer_order())
    real = m.invoices.select("customer_id", "invoice_number", m.split().alias("split"), days_between(before, F.col("billing_date")).alias("gap"))
    found = {r.gap: float(r.n) for r in real.where((F.col("split") != "demo") & F.col("gap").between(0, NEAR_DAYS)).groupBy("gap").agg(F.count("*").alias("n")).collect()}
    return {g: found.get(g, 0.0) for g in range(NEAR_DAYS + 1)}


def score_list(scored: DataFrame) -> DataFrame:
    """The scores of every split and kind, in order: a list for each, of planted cases only."""
    return scored.groupBy("split", "kind").agg(F.sort_array(F.collect_list(rounded(F.col("p"), 3))).alias("scores"))


def real_load(answers: DataFrame, threshold: float) -> DataFrame:
    """Model-routed invoices of tune and test by split: invoices, those with p >= threshold, and the rest."""
    by = answers.groupBy("split").agg(F.count("*").alias("invoices"), F.count_if(F.col("p") >= threshold).alias("human_review"), F.count_if(F.col("p") < threshold).alias("auto_approve"))
    domain = answers.sparkSession.createDataFrame([("tune",), ("test",)], "split string")
    return domain.join(by, "split", "left").na.fill(0)


def _demo(m: Model) -> DataFrame:
    from .rules import RULES, triage

    routes = stored(triage(m, {n: RULES[n] for n in ("duplicate_lines", "rebilled_products")}).select("invoice_number", "route"), "routes")
    return plant(m, routes, per_label=4, seed=7, weights={0: 1, 1: 3, 2: 2}, changed=2)


def demo_kind_shares(m: Model) -> DataFrame:
    """kind_shares() of demo_cases() at the default threshold."""
    from .scoring import THRESHOLD

    cases = _demo(m)
    return kind_shares(cases, comparison_score(cases), THRESHOLD)


def demo_cases(m: Model) -> DataFrame:
    """A few cases of every kind over the rules that leave clean invoices in this data; kinds without candidates raise."""
    cases = _demo(m)
    return cases.select("case_id", "kind", "label", "split", F.array_join("source_invoices", ",").alias("sources"), "gap_days", F.col("current.invoice_total_cents").alias("total_cents"))
