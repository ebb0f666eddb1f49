"""Small tables with known answers, and brute force for the fuzzy joins."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from strandloom.functions.sequences import hamming, positions
from strandloom.operators import correct, downsample, extract, matrix, pairs, umi
from strandloom.plans.config import ConfigError, Correction, Plan, Segment


def cut(spark, text, s):
    return spark.createDataFrame([(text,)], "t string").select(extract.segment(F.col("t"), s).alias("s")).first().s


@pytest.mark.parametrize(
    ("text", "segment", "raw", "method", "reason"),
    [
        ("AACCCGG", Segment("U", "umi", "R1", 3, start=2), "CCC", "fixed", ""),
        ("ACGTGG", Segment("B", "barcode1", "R1", 4, right="GG"), "ACGT", "linker", ""),
        ("GGACGTCC", Segment("B", "barcode1", "R1", 4, left="GG", right="CC"), "ACGT", "linker", ""),
        ("ACGTZZZZ", Segment("B", "barcode1", "R1", 4, start=0, right="GG", correction=Correction(shift=0)), "ACGT", "fixed", ""),
        ("AACCTTTTAACC12345678ACAGTTACAG", Segment("B", "barcode1", "R1", 8, left="AACC", right="ACAG"), "12345678", "linker", ""),
        ("ACG", Segment("B", "barcode1", "R1", 4, start=0), "", "fixed", "coordinate_out_of_range:0:4"),
        ("TGG", Segment("B", "barcode1", "R1", 4, right="GG"), "T", "linker", "unexpected_length:1"),
        ("GA", Segment("B", "barcode1", "R1", 4, left="GAC"), "", "linker", "left_linker_not_found"),
        ("", Segment("B", "barcode1", "R1", 4, start=0, right="GG"), "", "failed", "linker_failed:right_linker_not_found;fixed_failed:coordinate_out_of_range:0:4"),
        ("N" * 15 + "L" + "ABCDEFGH" + "R", Segment("B", "barcode1", "R1", 8, start=16), "LABCDEFGHR", "fixed", ""),
    ],
)
def test_segment(spark, text, segment, raw, method, reason):
    got = cut(spark, text, segment)
    assert (got.raw, got.method, got.reason, got.success) == (raw, method, reason, not reason)


def test_closest_pair_counts(spark):
    got = cut(spark, "AACCTTTTAACC12345678ACAGTTACAG", Segment("B", "barcode1", "R1", 8, left="AACC", right="ACAG"))
    assert (got.gap, got.left_matches, got.right_matches, got.pairs) == (8, 2, 2, 4)


def test_hamming_and_positions_against_brute_force(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(9))) for _ in range(60)]
    rows = list(itertools.product(texts, texts[:12]))
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", hamming(F.col("a"), F.col("b")).alias("h"), positions(F.col("a"), "ACG", 1).alias("p")).collect()
    for r in got:
        assert r.h == (sum(x != y for x, y in zip(r.a, r.b)) if len(r.a) == len(r.b) else max(len(r.a), len(r.b)))
        assert r.p == [i for i in range(len(r.a) - 2) if sum(x != y for x, y in zip(r.a[i : i + 3], "ACG")) <= 1]


def brute(raw, anchor, known, n, c):
    found = []
    for shift in [0, *(x for d in range(1, c.shift + 1) for x in (-d, d))]:
        w = raw[anchor + shift : anchor + shift + n]
        if anchor + shift < 0 or len(w) < n:
            continue
        near = sorted((sum(a != b for a, b in zip(w, k)), k) for k in known)
        best = 0 if w in known else near[0][0]
        if best <= c.mismatch:
            found += [((shift != 0) + (best > 0), abs(shift) + best, best, abs(shift), k) for d, k in near if d == best]
    if not found:
        return "failed", ""
    top = {f[4] for f in found if f[:4] == min(found)[:4]}
    return ("valid", top.pop()) if len(top) == 1 else ("ambiguous", "")


@pytest.mark.parametrize("c", [Correction(shift=0, mismatch=0), Correction(shift=1, mismatch=1), Correction(shift=2, mismatch=2)])
def test_correction_against_brute_force(spark, c):
    rng = random.Random(4)
    seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    known = sorted({seq(6) for _ in range(25)})
    raws = [(seq(rng.choice([5, 6, 8])), rng.choice([0, 1])) for _ in range(150)] + [(k, 0) for k in known[:5]] + [("A" + k + "C", 1) for k in known[5:10]] + [("", 0)]
    s = Segment("B", "barcode1", "R1", 6, start=1, correction=c)
    got = correct.corrected(spark.createDataFrame(raws, "raw string, anchor int"), spark.createDataFrame([(k,) for k in known], "known string"), s).collect()
    assert len(got) == len(set(raws))
    for r in got:
        assert (r.status, r.corrected) == brute(r.raw, r.anchor, known, 6, c), r


def greedy(counts, method):
    order = sorted(counts, key=lambda u: (-counts[u], u))
    near = lambda a, b: sum(x != y for x, y in zip(a, b)) == 1
    leader = {}
    for root in order:
        todo = [root] if root not in leader else []
        while todo:
            u = todo.pop()
            leader[u] = root
            todo += [v for v in order if v not in leader and v not in todo and near(u, v) and (method == "cluster" or counts[u] >= 2 * counts[v] - 1)]
    return leader


@pytest.mark.parametrize("method", ["directional", "cluster"])
def test_umi_methods_against_greedy(spark, method):
    rng = random.Random(6)
    groups = {f"B{g}": {u: rng.choice([1, 1, 2, 3, 5, 9, 20]) for u in {"".join(rng.choice("ACG") for _ in range(4)) for _ in range(25)}} for g in range(6)}
    rows = [("s", b, "f", u, n) for b, g in groups.items() for u, n in g.items()]
    got = umi.assigned(spark.createDataFrame(rows, "sample string, barcode1 string, barcode2_name string, umi string, n long"), method).collect()
    assert len(got) == len(rows)
    want = {b: greedy(g, method) for b, g in groups.items()}
    assert all(want[r.barcode1][r.umi] == r.leader for r in got)


def test_adjacency(spark):
    rows = [("s", "b", "f", u, n) for u, n in (("AAAA", 10), ("AAAT", 3), ("AATT", 2), ("CCCC", 1))]
    df = spark.createDataFrame(rows, "sample string, barcode1 string, barcode2_name string, umi string, n long")
    got = {r.umi: r.leader for r in umi.assigned(df, "adjacency").collect()}
    assert got == {"AAAA": "AAAA", "AAAT": "AAAT", "AATT": "AAAT", "CCCC": "CCCC"}  # two leads are needed to cover AATT


def test_pairs_aliases_dominance(spark):
    df = spark.createDataFrame([("s", "p", c, 1, n) for c, n in (("AACG", 100), ("AATG", 3), ("AANG", 2), ("TTCG", 100), ("NNNG", 1))], "sample string, pb string, cb string, molecule_count long, reads_count long")
    got = {(r.raw_cb, r.corrected_cb, r.correction_type) for r in pairs.aliases(df).collect()}
    assert got == {("AATG", "AACG", "hamming_1"), ("AANG", "AACG", "n_wildcard")}
    whole = {r.cb: r.reads_count for r in pairs.resolved(df, pairs.aliases(df)).collect()}
    assert whole == {"AACG": 105, "TTCG": 100, "NNNG": 1}
    df = spark.createDataFrame([("s", "P1", "C1", 1, 9), ("s", "P1", "C2", 1, 1), ("s", "P2", "C1", 1, 8), ("s", "P2", "C3", 1, 2)], df.schema)
    kept = pairs.dominant(df, 0.8).collect()
    assert [(r.pb, r.cb, r.dominant_ratio) for r in kept] == [("P1", "C1", 0.9)]
    tie = spark.createDataFrame([("s", "P", "CB", 1, 5), ("s", "P", "CA", 1, 5), ("s", "P", "CAA", 1, 5)], df.schema)
    assert pairs.dominant(tie, 0.1).first().cb == "CA"


def test_pi_filter(spark):
    rows = [("s", "P1", "F", "U1", 9, 1), ("s", "P2", "F", "U1", 1, 1), ("s", "P1", "F", "U2", 8, 1), ("s", "P2", "F", "U2", 2, 1), ("s", "P3", "F", "U3", 1, 1)]
    df = spark.createDataFrame(rows, "sample string, barcode1 string, barcode2_name string, corrected_umi string, reads_count long, raw_umi_count long")
    marked = pairs.pi_marked(df, 0.8)
    assert {(r.barcode1, r.corrected_umi) for r in pairs.pi_filtered(marked).collect()} == {("P1", "U1"), ("P3", "U3")}
    qc = pairs.pi_qc(marked).first()
    assert (qc.total_fb_umis, qc.multi_pi_fb_umis, qc.dominant_multi_pi_fb_umis, qc.removed_fb_umis) == (3, 2, 1, 1)


PLAN = Plan((Segment("A", "barcode1", "R1", 4, start=0), Segment("B", "barcode2", "R2", 4, start=0), Segment("U", "umi", "R2", 4, start=4)), ratios=(0.25, 0.5), repeats=2)


def test_downsampling(spark):
    rows = [("s", f"b{i}", "f", "u", 1 + i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "sample string, barcode1 string, barcode2_name string, corrected_umi string, reads_count long")
    thin = downsample.kept(df, PLAN)
    points = {(r.ratio, r.repeat): r for r in downsample.metrics(thin, PLAN).collect()}
    total = sum(r[4] for r in rows)
    assert set(points) == {(0.0, 0), (1.0, 0), (0.25, 1), (0.25, 2), (0.5, 1), (0.5, 2)}
    assert points[1.0, 0].reads_sampled == total and points[0.0, 0].reads_sampled == 0
    for ratio in (0.25, 0.5):
        assert abs(points[ratio, 1].reads_sampled - ratio * total) < 5 * (total * ratio * (1 - ratio)) ** 0.5
    assert downsample.optimal(downsample.metrics(thin, PLAN)).first().ratio == max(points.values(), key=lambda r: r.sequencing_saturation).ratio
    again = downsample.kept(df.repartition(7), PLAN)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, thin.collect()))


def test_empty_tables(spark):
    reads = spark.createDataFrame([], "sample string, read_id string, r1_seq string, r2_seq string")
    white = spark.createDataFrame([("ACGT",)], "known string")
    fixed = correct.correct(extract.extract(reads, PLAN), PLAN, {"A": white, "B": white})
    valid = correct.valid(correct.joined(fixed, PLAN, None))
    found = umi.molecules(umi.assigned(umi.raw_counts(valid)))
    assert found.count() == 0 and matrix.long(found).count() == 0 and extract.stats(extract.extract(reads, PLAN), PLAN).count() == 0


def test_config_guards():
    with pytest.raises(ConfigError):
        Plan(PLAN.segments[:2])
    with pytest.raises(ConfigError):
        Plan(PLAN.segments, umi_method="other")
    with pytest.raises(ConfigError):
        Plan(PLAN.segments, library="pb-cb")
    with pytest.raises(ConfigError):
        Segment("X", "umi", "R1", 4)
    assert len(Plan(PLAN.segments).grid) == 38
