"""How often large inputs are read: every reading is shuffled anew, and shuffle files fill the disks."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import planting, rules, scoring
from tallyfold.plans import queries
from tallyfold.sources.model import from_tpch
from tallyfold.sources.store import dropped, stored

SF = "/root/testdata/sf0.001"


def counted(df):
    """`df`, and an accumulator of its rows each time they are read."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), read


@pytest.fixture(scope="module")
def tpch(spark):
    return from_tpch(spark, SF, stored)


def test_planting_gathers_lines_once(spark, tpch):
    lines, read = counted(tpch.invoice_lines)
    m = dataclasses.replace(tpch, invoice_lines=lines)
    routes = tpch.invoices.select("invoice_number", F.lit("auto_approve").alias("route"))
    planted = planting.plant(m, routes, per_label=2, seed=7, weights={0: 1, 1: 3, 2: 2}, changed=1)
    assert "Window" not in planted._jdf.queryExecution().optimizedPlan().toString()  # the choice is not made again
    cases = planted.collect()
    # once for all choices, once for the whole lines of taken cases in each branch
    assert len(cases) == 10 and read.value <= 4 * tpch.invoice_lines.count()
    by_number = {r.invoice_number: r.n for r in tpch.invoice_lines.groupBy("invoice_number").agg(F.count("*").alias("n")).collect()}
    for c in cases:
        want = {"split": by_number[c.source_invoices[0]], "moved": by_number[c.source_invoices[-1]]}
        got = {"split": c.previous.line_count + c.current.line_count, "moved": c.current.line_count}
        assert c.kind not in want or want[c.kind] == got[c.kind]


def test_answers_triage_once(spark, tpch):
    reads = []

    def triage(m):
        df, read = counted(rules.triage(m, {"near_duplicate_window": rules.near_duplicate_window}))
        reads.append(read)
        return df

    routes, selected, answers = queries._answers(tpch, triage)
    assert answers.count() == selected.count() == routes.where("route = 'model'").count() > 0
    assert [r.value for r in reads] == [tpch.invoices.count()]


def test_states_gather_lines_once(spark, tpch):
    lines, read = counted(tpch.invoice_lines)
    _, selected = queries._selected(tpch, lambda m: rules.triage(m, {"near_duplicate_window": rules.near_duplicate_window}))
    got = scoring.states(selected, dataclasses.replace(tpch, invoice_lines=lines))
    assert got.count() == selected.count() > 0 and "null" not in {r.state for r in got.collect()}
    assert read.value == tpch.invoice_lines.count()


def test_dropped_tables_are_gone(spark):
    kept = stored(spark.range(5), "five")
    folder = kept.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    assert os.path.exists(folder)
    dropped(kept)
    assert not os.path.exists(folder)
