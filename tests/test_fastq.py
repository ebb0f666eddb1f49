"""From FASTQ files to the matrix, on nine pairs with known answers."""

import gzip

import pytest
from pyspark.sql import functions as F

from strandloom.operators import correct, extract, matrix, umi
from strandloom.plans.config import ConfigError, Correction, Plan, Segment
from strandloom.sources import fastq

READS = [
    ("ACGTACGTAGGTC", "AAAAAAAACCGG"), ("ACGTACGTAGGTC", "AAAAAAAACCGG"), ("ACGTACGTAGGTC", "AAAAATAACCGG"), ("TGCATGCAAGGTC", "CCCCCCTTGGCC"),
    ("TGCATGCAAGGTC", "CCCCCCTTGGCC"), ("ACGTACGAAGGTC", "GGGGGGAACCGG"), ("NACGTACGTAGGTC", "TTTTTTAACCGG"), ("TGCATGCAAGGTC", "ACACACTTGGCT"),
    ("ACGTACGTNNNNN", "TATATAAACCGG"),
]
PLAN = Plan((
    Segment("CELL", "barcode1", "R1", 8, start=0, right="AGGTC"),
    Segment("FB", "barcode2", "R2", 6, start=6, correction=Correction(shift=0)),
    Segment("UMI", "umi", "R2", 6, start=0, correction=Correction(enabled=False)),
))


@pytest.fixture
def files(tmp_path):
    r1, r2 = tmp_path / "a_R1.fastq.gz", tmp_path / "a_R2.fastq"
    text = [[f"@read{i:03d}/{k} x\n{seqs[k - 1].lower()}\n+\n{'I' * len(seqs[k - 1])}\n" for i, seqs in enumerate(READS, 1)] for k in (1, 2)]
    r1.write_bytes(gzip.compress("".join(text[0][:4]).encode()) + gzip.compress("".join(text[0][4:]).encode()))
    r2.write_text("".join(text[1]))
    return str(r1), str(r2)


def test_nine_reads(spark, files):
    reads = fastq.pairs(spark, "s", *files)
    assert {(r.read_id, r.r1_seq, r.r2_seq) for r in reads.collect()} == {(f"read{i:03d}", *x) for i, x in enumerate(READS, 1)}
    extracted = extract.extract(reads, PLAN)
    assert {r.read_id: r.methods for r in extracted.collect()} == {f"read{i:03d}": "LFF" if i < 9 else "FFF" for i in range(1, 10)}
    white = {"CELL": ["ACGTACGT", "TGCATGCA"], "FB": ["AACCGG", "TTGGCC"]}
    white = {k: spark.createDataFrame([(x,) for x in v], "known string") for k, v in white.items()}
    names = spark.createDataFrame([("AACCGG", "CD4"), ("TTGGCC", "CD8A")], "sequence string, name string")
    fixed = correct.correct(extracted, PLAN, white)
    assert correct.trace(fixed, PLAN).count() == 18
    valid = correct.valid(correct.joined(fixed, PLAN, names))
    assert valid.count() == 9
    found = umi.molecules(umi.assigned(umi.raw_counts(valid)))
    assert {(r.barcode1, r.barcode2_name, r.corrected_umi, r.reads_count, r.raw_umi_count) for r in found.collect()} == {
        ("ACGTACGT", "CD4", "AAAAAA", 3, 2), ("ACGTACGT", "CD4", "GGGGGG", 1, 1), ("ACGTACGT", "CD4", "TATATA", 1, 1),
        ("ACGTACGT", "CD4", "TTTTTT", 1, 1), ("TGCATGCA", "CD8A", "ACACAC", 1, 1), ("TGCATGCA", "CD8A", "CCCCCC", 2, 1),
    }
    dense = {tuple(r)[1:] for r in matrix.dense(matrix.long(found), ["CD4", "CD8A"]).collect()}
    assert dense == {("ACGTACGT", 4, 0), ("TGCATGCA", 0, 2)}


def test_blocks_and_leading_pairs(spark, files):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    try:
        assert fastq.pairs(spark, "s", *files).count() == 9
        assert {r.read_id for r in fastq.pairs(spark, "s", *files, most=2).collect()} == {"read001", "read002"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_broken_files(spark, files, tmp_path):
    short = tmp_path / "short.fastq"
    short.write_text("@a\nAC\n+\nII\n")
    with pytest.raises(Exception, match="doesn't match"):
        fastq.pairs(spark, "s", files[0], str(short)).collect()
    short.write_text("@a\nAC\n+\nI\n")
    with pytest.raises(Exception, match="isn't FASTQ"):
        fastq.records(spark, str(short)).collect()
    short.write_text("@a\nAC\n+\n")
    with pytest.raises(ConfigError):
        fastq.records(spark, str(short))


def test_whitelist(spark, tmp_path):
    path = tmp_path / "w.txt"
    path.write_text("# names\none\tacgt\n\nGGGG\n")
    assert {tuple(r) for r in fastq.whitelist(spark, str(path)).select("name", F.col("known")).collect()} == {("one", "ACGT"), ("GGGG", "GGGG")}
    path.write_text("ACGT\nx\tACGT\n")
    with pytest.raises(ConfigError):
        fastq.whitelist(spark, str(path))


def test_reads_stop(spark, tmp_path):
    """Leading pairs are read without what follows, and without a shuffle; a broken record is met only if it is read."""
    good = "".join(f"@r{i}/1\nACGT\n+\nIIII\n" for i in range(5))
    for k in (1, 2):
        (tmp_path / f"x{k}.fq.gz").write_bytes(gzip.compress((good.replace("/1", f"/{k}") + "broken\n").encode()))
    both = [str(tmp_path / f"x{k}.fq.gz") for k in (1, 2)]
    head = fastq.pairs(spark, "s", *both, most=4)
    assert [(r.number, r.read_id) for r in head.collect()] == [(k, f"r{k}") for k in range(4)]
    assert "Exchange" not in head._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="ends within a record"):
        fastq.pairs(spark, "s", *both).count()


def test_ways_agree(spark, tmp_path):
    """Blocks of plain files and files side by side give the same pairs."""
    text = [[f"@r{i}/{k} z\n{'acgtn'[: 1 + i % 5]}\n+\n{'I' * (1 + i % 5)}\n" for i in range(300)] for k in (1, 2)]
    for k in (0, 1):
        (tmp_path / f"{k}.fq").write_text("".join(text[k]))
        (tmp_path / f"{k}.fq.gz").write_bytes(gzip.compress("".join(text[k]).encode()))
    plain, packed = (fastq.pairs(spark, "s", *[str(tmp_path / f"{k}.fq{end}") for k in (0, 1)]) for end in ("", ".gz"))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, packed.collect())) and packed.count() == 300
