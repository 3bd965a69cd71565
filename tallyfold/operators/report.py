"""Report: final routes, the review queue, histograms, console tables and one HTML page."""

from __future__ import annotations

import html
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalars import number_order

from .rules import SPLITS


def final_routes(triaged: DataFrame, answers: DataFrame) -> DataFrame:
    """(split, approve, rule_review, model_review, excluded): a model-routed invoice that nobody asked about is approved."""
    asked = answers.select("invoice_number", (F.col("route_after_model") == "human_review").alias("model_review"))
    own = triaged.join(asked, "invoice_number", "left").withColumn("model_review", F.coalesce("model_review", F.lit(False)) & (F.col("route") == "model"))
    what = [
        F.count_if((F.col("route") == "auto_approve") | ((F.col("route") == "model") & ~F.col("model_review"))).alias("approve"),
        F.count_if(F.col("route") == "human_review").alias("rule_review"), F.count_if("model_review").alias("model_review"), F.count_if(F.col("route") == "excluded").alias("excluded"),
    ]
    by = own.groupBy("split").agg(*what).unionByName(own.agg(*what).withColumn("split", F.lit("all")))
    domain = triaged.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return domain.join(by, "split", "left").na.fill(0)


def queued(routes: DataFrame, answers: DataFrame) -> DataFrame:
    """(invoice_number, split, source) of the invoices for a person, by rule or by model, in invoice order."""
    by_rule = routes.where("route = 'human_review'").select("invoice_number", "split", F.lit("rule").alias("source"))
    asked = answers.where("route_after_model = 'human_review'").select("invoice_number")
    by_model = routes.select("invoice_number", "split").join(asked, "invoice_number").select("invoice_number", "split", F.lit("model").alias("source"))
    return by_rule.unionByName(by_model).orderBy(*number_order(F.col("invoice_number")))


def review_queue(triaged: DataFrame, features: DataFrame, answers: DataFrame) -> DataFrame:
    """queued() with the evidence as text and the model's p."""
    flags = F.filter("results", lambda r: r["outcome"] == "flag")
    said = F.array_join(F.transform(flags, lambda r: F.concat(r["rule"], F.lit(": "), F.array_join(r["reasons"], "; "))), " | ")
    by_rule = triaged.where("route = 'human_review'").select("invoice_number", "split", F.lit("rule").alias("source"), said.alias("evidence"), F.lit(None).cast("double").alias("p"))
    asked = answers.where("route_after_model = 'human_review'").select("invoice_number", "p")
    f = features.select("invoice_number", "gap_days", "shared_products", "prev_invoice_number")
    near = F.format_string("%d days after %s, %d shared products", "gap_days", "prev_invoice_number", "shared_products")
    by_model = triaged.select("invoice_number", "split").join(asked, "invoice_number").join(f, "invoice_number", "left").select("invoice_number", "split", F.lit("model").alias("source"), near.alias("evidence"), "p")
    return by_rule.unionByName(by_model).orderBy(*number_order(F.col("invoice_number")))


def format_cell(value) -> str:
    if value is None:
        return "—"
    return f"{value:,}" if isinstance(value, int) and not isinstance(value, bool) else str(value)


def format_table(rows: list[dict], indent: str = "  ") -> str:
    """Rows as text; columns of numbers to the right."""
    if not rows:
        return f"{indent}(no rows)"
    names = list(rows[0])
    cells = [[format_cell(r.get(n)) for n in names] for r in rows]
    right = [all(r.get(n) is None or (isinstance(r[n], (int, float)) and not isinstance(r[n], bool)) for r in rows) for n in names]
    width = [max(len(n), *(len(c[i]) for c in cells)) for i, n in enumerate(names)]
    line = lambda row: indent + "  ".join(c.rjust(w) if r else c.ljust(w) for c, w, r in zip(row, width, right, strict=True)).rstrip()
    return "\n".join(line(r) for r in [names, *cells])


def display_path(path: str, base: str | None = None) -> str:
    """A path within the project relative to it; of any other only the last part."""
    base = os.path.abspath(base or os.getcwd())
    full = os.path.abspath(path)
    return os.path.relpath(full, base) if full == base or full.startswith(base + os.sep) else os.path.basename(full)


def histogram_svg(bins: list[tuple[int, int]], threshold: float, count: int = 50, width: int = 600, height: int = 120) -> str:
    """Bars of (bin, n), and a line at the threshold."""
    most = max((n for _, n in bins), default=1)
    bar = width / count
    bars = "".join(f'<rect x="{b * bar:.1f}" y="{height - height * n / most:.1f}" width="{bar - 1:.1f}" height="{height * n / most:.1f}"/>' for b, n in bins)
    at = min(threshold / (count * 0.01), 1) * width
    return f'<svg viewBox="0 0 {width} {height}" role="img">{bars}<line x1="{at:.1f}" x2="{at:.1f}" y1="0" y2="{height}" stroke="red"/></svg>'


def html_table(rows: list[dict]) -> str:
    if not rows:
        return "<p>No rows.</p>"
    head = "".join(f"<th>{html.escape(str(n))}</th>" for n in rows[0])
    body = "".join("<tr>" + "".join(f"<td>{html.escape(format_cell(v))}</td>" for v in r.values()) + "</tr>" for r in rows)
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"


def read_document(path: str) -> dict | None:
    """A phase's summary, or None where the phase was not run."""
    if not os.path.exists(path):
        return None
    with open(path) as text:
        return json.load(text)


def page(documents: dict[str, dict | None], routes: list[dict], bins: list[tuple[int, int]], threshold: float) -> str:
    """The report: every list of rows in a phase's document is a table, other values are listed; then the routes and scores."""
    sections = {}
    for name, document in documents.items():
        if document is None:
            sections[name] = "<p>This phase was not run.</p>"
            continue
        parts, single = [], []
        for key, value in document.items():
            rows = value if isinstance(value, list) and all(isinstance(r, dict) for r in value) else None
            if rows is not None:
                flat = [{k: v for k, v in r.items() if k != "table"} for r in rows]
                parts.append(f"<h3>{html.escape(key)}</h3>{html_table(flat)}")
            elif isinstance(value, dict):
                parts.append(f"<h3>{html.escape(key)}</h3>{html_table([{'name': k, 'value': v} for k, v in value.items()])}")
            else:
                single.append({"name": key, "value": value})
        sections[name] = html_table(single) + "".join(parts)
    sections["final routes"] = html_table(routes)
    sections["scores of the model"] = histogram_svg(bins, threshold) if bins else "<p>No scores.</p>"
    return render(sections)


def render(sections: dict[str, str], fragment: bool = False) -> str:
    """One self-contained page of titled sections, or only its body."""
    body = "".join(f"<section><h2>{html.escape(t)}</h2>{s}</section>" for t, s in sections.items())
    if fragment:
        return body
    style = "body{font-family:sans-serif;max-width:60rem;margin:2rem auto}td,th{padding:.2rem .6rem;text-align:left}"
    return f'<!doctype html><html lang="en"><head><meta charset="utf-8"><title>Invoice triage</title><style>{style}</style></head><body>{body}</body></html>'
