"""Workbooks and pages from the tables of a run: small sums, gathered on the driver."""

from __future__ import annotations

import html
from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators import matrix
from strandloom.operators.correct import ranked
from strandloom.sources import files
from strandloom.sources.workbook import workbook

if TYPE_CHECKING:
    from strandloom.plans.steps import Job

#: Rows of the reports' lists: features of a sample's workbook and page, sequences without a name.
FEATURES, SHOWN, MISSING = 1000, 25, 50
#: Below these a sample is flagged.
LEAST_VALID, LEAST_UNIQUE = 0.5, 0.1

STYLE = "body{font:15px/1.5 system-ui;margin:2rem auto;max-width:60rem;padding:0 1rem}table{border-collapse:collapse}td,th{border-bottom:1px solid #ccd;padding:.2rem .8rem;text-align:left}.flag{color:#a40}"
COLOURS = ("#1a73a8", "#c2571a")


def by_sample(df: DataFrame) -> dict[str, list[dict]]:
    """Rows of a table of sums by sample, without the sample's name."""
    out: dict[str, list[dict]] = {}
    for row in df.collect():
        found = row.asDict()
        out.setdefault(found.pop("sample"), []).append(found)
    return out


def grid(rows: Sequence[dict]) -> list[list]:
    """A header and its rows."""
    return [list(rows[0]), *[list(r.values()) for r in rows]] if rows else []


def table(rows: Sequence[Sequence]) -> str:
    line = lambda row, tag: "<tr>" + "".join(f"<{tag}>{html.escape('' if v is None else str(v))}</{tag}>" for v in row) + "</tr>"
    return "<table>" + "".join(line(row, "td" if k else "th") for k, row in enumerate(rows)) + "</table>"


def curves(points: Sequence[dict], names: Sequence[str]) -> str:
    """Percentages by ratio, as a drawing that needs no script."""
    lines = []
    for k, name in enumerate(names):
        at = " ".join(f"{60 + 600 * p['ratio']:.1f},{270 - 2.5 * float(p[name]):.1f}" for p in points)
        lines.append(f'<polyline points="{at}" fill="none" stroke="{COLOURS[k]}" stroke-width="2"/><text x="{70 + 260 * k}" y="14" fill="{COLOURS[k]}">{html.escape(name)}</text>')
    marks = "".join(f'<text x="{60 + 600 * x}" y="290" text-anchor="middle">{x}</text>' for x in (0, 0.25, 0.5, 0.75, 1))
    marks += "".join(f'<text x="50" y="{274 - 2.5 * y}" text-anchor="end">{y}</text>' for y in (0, 50, 100))
    return f'<svg viewBox="0 0 700 300" role="img"><path d="M60 20V270H660" fill="none" stroke="#889"/>{marks}{"".join(lines)}</svg>'


def page(title: str, *parts: str) -> str:
    return f'<!doctype html><meta charset="utf-8"><title>{html.escape(title)}</title><style>{STYLE}</style><h1>{html.escape(title)}</h1>{"".join(parts)}'


def flags(valid_rate: float, molecules: int, reads: int) -> list[str]:
    """What a reader should look at."""
    out = [f"Less than {LEAST_VALID:.0%} of all reads are valid."] if valid_rate < LEAST_VALID else []
    return out + ([f"Less than {LEAST_UNIQUE:.0%} of the supporting reads are molecules of their own."] if reads and molecules / reads < LEAST_UNIQUE else [])


def write_all(job: Job) -> None:
    """A workbook and a page per sample, both for the batch, and the summary over samples."""
    spark, plan, names = job.spark, job.plan, list(job.run.samples)
    extraction, corrections = by_sample(job.table("extraction_stats")), by_sample(job.table("correction_stats"))
    points, best = by_sample(job.table("downsample_metrics").orderBy("sample", "ratio", "repeat")), by_sample(job.table("optimal_point"))
    counts = job.table("matrix")
    sizes = {k: v[0] for k, v in by_sample(matrix.summary(counts)).items()}
    sums = {k: v[0] for k, v in by_sample(job.table("molecules").groupBy("sample").agg(F.count("*").alias("molecules"), F.sum("reads_count").alias("reads"))).items()}
    top = by_sample(ranked(matrix.feature_totals(counts), "molecules", "barcode2_name", FEATURES).select("sample", "barcode2_name", "molecules").orderBy("sample", F.desc("molecules"), "barcode2_name"))
    head = f"{plan.names['barcode1']}_count"
    batch = [["sample", "total_reads", "valid_reads", "valid_rate", "molecules", head, "feature_count"]]
    for name in names:
        scopes = {r["scope"]: r for r in corrections.get(name, [])}
        whole, found = scopes.get("combined", {}), sums.get(name, {"molecules": 0, "reads": 0})
        size = sizes.get(name, {"barcode1_count": 0, "feature_count": 0})
        rate = whole.get("valid_rate") or 0.0
        batch.append([name, whole.get("total_reads", 0), whole.get("valid_reads", 0), rate, found["molecules"], size["barcode1_count"], size["feature_count"]])
        facts = [["metric", "value"], *map(list, zip(batch[0], batch[-1], strict=True)), ["reads supporting molecules", found["reads"]]]
        features = [["feature", "molecules"], *[list(r.values()) for r in top.get(name, [])]]
        sheets = [
            ("Summary", facts), ("Extraction Stats", grid(extraction.get(name, []))), ("Correction Stats", grid(corrections.get(name, []))),
            ("UMI Stats", [["metric", "value"], ["molecules", found["molecules"]], ["supporting reads", found["reads"]]]),
            ("Downsample Metrics", grid(points.get(name, []))), ("Optimal Saturation", grid(best.get(name, []))), ("Top Features", features),
        ]
        files.write(spark, job.path(f"reports/{name}.xlsx"), workbook(sheets))
        linked = [["segment", "mode", "linker success", "fixed rescues", "final success"]]
        linked += [[r["segment"], r["configured_mode"], r["linker_success_rate"], r["fixed_success"], r["final_success_rate"]] for r in extraction.get(name, []) if r["linker_attempted"]]
        warnings = "".join(f'<p class="flag">{html.escape(w)}</p>' for w in flags(rate, found["molecules"], found["reads"])) or "<p>No flags.</p>"
        drawn = curves(points.get(name, []), ["sequencing_saturation", "duplication_ratio"])
        parts = [table(facts), warnings, "<h2>Linkers</h2>", table(linked), "<h2>Saturation</h2>", drawn, "<h2>Features</h2>", table(features[: SHOWN + 1])]
        files.write(spark, job.path(f"reports/{name}.html"), page(name, *parts))

    def crossed(long: DataFrame) -> list[list]:
        """Samples by features."""
        cells = by_sample(matrix.feature_totals(long).select("sample", "barcode2_name", "molecules"))
        cells = {s: {r["barcode2_name"]: r["molecules"] for r in rows} for s, rows in cells.items()}
        columns = sorted({f for row in cells.values() for f in row})
        return [["sample", *columns], *[[s, *[cells.get(s, {}).get(f, 0) for f in columns]] for s in names]]

    files.write(spark, job.path("reports/batch.xlsx"), workbook([("meta", batch), ("counts", crossed(counts))]))
    files.write(spark, job.path("reports/batch.html"), page("All samples", table(batch)))
    _summary(job, names, corrections, best, crossed(job.table("optimal_matrix")))


def _summary(job: Job, names: list[str], corrections: dict, best: dict, counts: list[list]) -> None:
    """Rates, optimal points and counts of all samples, and sequences that the annotation lacks."""
    plan, spark = job.plan, job.spark
    segments = [s.name for s in plan.segments if s.corrected]
    lists, gaps = {}, {}
    if job.run.annotation:
        gap = job.table("not_in_annotation")
        gaps = {r["sample"]: r["n"] for r in gap.groupBy("sample").agg(F.sum("reads_count").alias("n")).collect()}
        lists = by_sample(ranked(gap, "reads_count", "barcode2_sequence", MISSING).orderBy("sample", "rank").select("sample", "barcode2_sequence", "reads_count"))
    qc = {k: v[0] for k, v in by_sample(job.table("pi_seq_qc")).items()} if plan.library == "pi-seq" else {}
    extra = [c for c in next(iter(qc.values()), {})]
    keys = ["ratio", "sequencing_saturation", "reads_sampled", "umi_types", "umi_detected_once", "duplication_ratio"]
    meta = [["sample", "total_reads", *[f"{s} valid rate" for s in segments], "annotated_rate", *["optimal_downsample_ratio", *keys[1:]], *extra]]
    known: dict[str, str] = {}
    for s in plan.of("barcode2"):
        if s.name in job.run.whitelists and lists:
            wanted = [r["barcode2_sequence"] for rows in lists.values() for r in rows]  # at most MISSING per sample
            white = job.whitelists()[s.name]
            known |= {r["known"]: r["name"] for r in white.where(F.col("known").isin(wanted)).collect()}
    for name in names:
        scopes = {r["scope"]: r for r in corrections.get(name, [])}
        named = scopes.get(f"final_{plan.names['barcode2']}", {}).get("valid_reads") or 0
        lacking = gaps.get(name, 0)
        point = best.get(name, [{}])[0]
        rates = [scopes.get(s, {}).get("valid_rate") for s in segments]
        meta.append([name, scopes.get("combined", {}).get("total_reads"), *rates, named / (named + lacking) if named + lacking else 0, *[point.get(k) for k in keys], *[qc.get(name, {}).get(c) for c in extra]])
    files.write(spark, job.path("summary.xlsx"), workbook([("meta", meta), ("count", counts)]))
    sheets = [(name, [["barcode2_name", "reads_count"], *[[known.get(r["barcode2_sequence"], r["barcode2_sequence"]), r["reads_count"]] for r in lists.get(name, [])]]) for name in names]
    files.write(spark, job.path("not_in_annotation.xlsx"), workbook(sheets))
