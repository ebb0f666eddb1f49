"""Cutting segments out of reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.sequences import first_match, positions
from strandloom.plans.config import Plan, Segment


def blank() -> Column:
    return F.lit("")


def closest_pair(text: Column, left: str, right: str, most: int) -> tuple[Column, Column, Column, Column]:
    """Closest (gap, left, right) with the right linker after the left, and counts of lefts, rights, pairs."""
    lefts, rights = positions(text, left, most), positions(text, right, most)
    n = len(left)
    pairs = F.flatten(
        F.transform(lefts, lambda a: F.transform(F.filter(rights, lambda b: b >= a + n), lambda b: F.struct((b - a - n).alias("gap"), a.alias("l"), b.alias("r"))))
    )
    return F.array_min(pairs), F.size(lefts), F.size(rights), F.size(pairs)


def _result(raw: Column, reason: Column, method: Column, failure: Column, left: Column, right: Column, pairs: Column, gap: Column) -> Column:
    return F.struct(
        raw.alias("raw"), (reason == "").alias("success"), reason.alias("reason"), method.alias("method"), failure.alias("linker_failure"),
        left.cast("int").alias("left_matches"), right.cast("int").alias("right_matches"), pairs.cast("int").alias("pairs"), gap.cast("int").alias("gap"),
    )


def fixed(text: Column, s: Segment) -> tuple[Column, Column]:
    """Raw sequence with padding, and reason of failure or ''."""
    end, begin = s.start + s.length, max(0, s.start - s.padding)
    outside = F.length(text) < end
    raw = F.when(outside, blank()).otherwise(text.substr(begin + 1, end + s.padding - begin))
    return raw, F.when(outside, F.lit(f"coordinate_out_of_range:{s.start}:{end}")).otherwise(blank())


def linked(text: Column, s: Segment) -> tuple[Column, Column, Column, Column, Column, Column]:
    """Raw sequence, reason, matches left and right, pairs, gap of the chosen pair or -1."""
    zero, n = F.lit(0), s.length
    if s.left and s.right:
        pair, lefts, rights, pairs = closest_pair(text, s.left, s.right, s.linker_mismatch)
        raw = F.coalesce(F.substr(text, pair["l"] + len(s.left) + 1, pair["gap"]), blank())
        missing = F.when(lefts == 0, "left_linker_not_found").when(pair.isNull(), "right_linker_not_found_after_left")
        gap = F.coalesce(pair["gap"], F.lit(-1))
    else:
        at = first_match(text, s.left or s.right, s.linker_mismatch)
        if s.left:
            raw = F.coalesce(F.substr(text, at + len(s.left) + 1, F.lit(n)), blank())
            lefts, rights = at.isNotNull().cast("int"), zero
        else:
            begin = F.greatest(zero, at - n)
            raw = F.coalesce(F.substr(text, begin + 1, at - begin), blank())
            lefts, rights = zero, at.isNotNull().cast("int")
        missing = F.when(at.isNull(), F.lit(f"{'left' if s.left else 'right'}_linker_not_found"))
        pairs, gap = zero, F.lit(-1)
    reason = F.coalesce(missing, F.when(F.length(raw) != n, F.concat(F.lit("unexpected_length:"), F.length(raw).cast("string"))), blank())
    return raw, reason, lefts, rights, pairs, gap


def segment(text: Column, s: Segment) -> Column:
    """The segment's struct: raw, success, reason, method, linker_failure, left_matches, right_matches, pairs, gap."""
    none = (blank(), F.lit(0), F.lit(0), F.lit(0), F.lit(-1))
    if s.method == "fixed":
        return _result(*fixed(text, s), F.lit("fixed"), *none)
    raw, reason, *counts = linked(text, s)
    if s.method == "linker":
        return _result(raw, reason, F.lit("linker"), reason, *counts)
    raw_fixed, reason_fixed = fixed(text, s)
    good, rescued = reason == "", reason_fixed == ""
    both = F.concat(F.lit("linker_failed:"), reason, F.lit(";fixed_failed:"), reason_fixed)
    return _result(
        F.when(good, raw).otherwise(raw_fixed),
        F.when(good | rescued, blank()).otherwise(both),
        F.when(good, "linker").when(rescued, "fixed").otherwise("failed"),
        reason,
        *counts,
    )


def extract(reads: DataFrame, plan: Plan) -> DataFrame:
    """sample, read_id, a struct per segment, methods, status, failure_reason."""
    text = {"R1": F.upper("r1_seq"), "R2": F.upper("r2_seq")}
    cut = reads.select("sample", "read_id", *[segment(text[s.read], s).alias(s.name) for s in plan.segments])
    code = [F.when(~F.col(f"{s.name}.success"), "X").otherwise(F.when(F.col(f"{s.name}.method") == "linker", "L").otherwise("F")) for s in plan.segments]
    reasons = [F.when(~F.col(f"{s.name}.success"), F.concat(F.lit(f"{s.name}:"), F.col(f"{s.name}.reason"))) for s in plan.segments]
    good = reduce(lambda a, b: a & b, [F.col(f"{s.name}.success") for s in plan.segments])
    return cut.select("*", F.concat(*code).alias("methods"), F.when(good, "success").otherwise("failed").alias("status"), F.concat_ws(";", *reasons).alias("failure_reason"))


def flat(extracted: DataFrame, plan: Plan) -> DataFrame:
    """The text form: per target its segments' raw sequences joined by commas."""
    joined = [F.concat_ws(",", *[F.col(f"{s.name}.raw") for s in plan.of(t)]).alias(f"{plan.names[t]}_segments") for t in ("barcode1", "barcode2", "umi")]
    return extracted.select("sample", "read_id", *joined, "methods", "status", "failure_reason")


def stats(extracted: DataFrame, plan: Plan) -> DataFrame:
    """Counts of how each segment was found, per sample; one pass, one small shuffle."""
    modes = {s.name: s for s in plan.segments}
    rows = F.array(*[F.struct(F.lit(s.name).alias("segment"), F.lit(plan.names[s.target]).alias("target"), F.lit(s.read).alias("read"), F.lit(s.method).alias("configured_mode"), F.col(s.name).alias("r")) for s in modes.values()])
    long = extracted.select("sample", F.inline(rows))
    linked = F.col("configured_mode") != "fixed"
    won = linked & (F.col("r.method") == "linker") & F.col("r.success")
    tried_fixed = (F.col("configured_mode") == "fixed") | ((F.col("configured_mode") == "linker_fixed") & (F.col("r.method") != "linker"))
    rescued = tried_fixed & (F.col("r.method") == "fixed") & F.col("r.success")
    why = F.substring_index("r.linker_failure", ":", 1)
    gap = F.when(linked & (F.col("r.gap") >= 0), F.col("r.gap"))
    counts = long.groupBy("sample", "segment", "target", "read", "configured_mode").agg(
        F.count("*").alias("total_reads"),
        F.count_if(linked).alias("linker_attempted"),
        F.count_if(won).alias("linker_success"),
        F.count_if(linked & ~won).alias("linker_failed"),
        F.count_if(linked & (why == "left_linker_not_found")).alias("left_linker_not_found"),
        F.count_if(linked & why.startswith("right_linker_not_found")).alias("right_linker_not_found"),
        F.count_if(linked & (why == "unexpected_length")).alias("unexpected_length"),
        F.count_if(linked & (F.col("r.left_matches") > 1)).alias("reads_with_multiple_left_matches"),
        F.count_if(linked & (F.col("r.right_matches") > 1)).alias("reads_with_multiple_right_matches"),
        F.count_if(linked & (F.col("r.pairs") > 1)).alias("reads_with_multiple_candidate_pairs"),
        F.sum(F.when(linked, F.col("r.pairs")).otherwise(0)).alias("linker_candidate_pairs_total"),
        F.min(gap).alias("selected_gap_min"),
        F.max(gap).alias("selected_gap_max"),
        F.count_if(tried_fixed).alias("fixed_attempted"),
        F.count_if(rescued).alias("fixed_success"),
        F.count_if(tried_fixed & ~rescued).alias("fixed_failed"),
        F.count_if("r.success").alias("final_success"),
    )
    rate = lambda a, b: F.round(F.try_divide(F.col(a).cast("double"), F.col(b)), 6)
    return counts.withColumns(
        {
            "linker_success_rate": rate("linker_success", "linker_attempted"),
            "fixed_rescue_rate": F.when(F.col("configured_mode") == "linker_fixed", rate("fixed_success", "fixed_attempted")),
            "final_success_rate": F.coalesce(rate("final_success", "total_reads"), F.lit(0.0)),
        }
    )
