"""Settings, steps, reports and the command line, on nine pairs with known answers."""

import io
import zipfile
from dataclasses import replace
from pathlib import Path
from xml.etree import ElementTree

import pytest

from strandloom.__main__ import main
from strandloom.plans import tables
from strandloom.plans.config import ConfigError
from strandloom.plans.reports import flags
from strandloom.plans.steps import Job, quick_test
from strandloom.sources import fastq, files, settings
from strandloom.sources.workbook import letters, titles, workbook

READS = [
    ("ACGTACGTAGGTC", "AAAAAAAACCGG"), ("ACGTACGTAGGTC", "AAAAAAAACCGG"), ("ACGTACGTAGGTC", "AAAAATAACCGG"), ("TGCATGCAAGGTC", "CCCCCCTTGGCC"),
    ("TGCATGCAAGGTC", "CCCCCCTTGGCC"), ("ACGTACGAAGGTC", "GGGGGGAACCGG"), ("NACGTACGTAGGTC", "TTTTTTAACCGG"), ("TGCATGCAAGGTC", "ACACACTTGGCT"),
    ("ACGTACGTNNNNN", "TATATAAACCGG"),
]


@pytest.fixture
def home(tmp_path):
    """A folder with the settings ``run.yaml`` and all that they name."""
    for k in (1, 2):
        (tmp_path / f"s1_R{k}.fastq.gz").with_suffix("").write_text("".join(f"@r{i}/{k}\n{x[k - 1]}\n+\n{'I' * len(x[k - 1])}\n" for i, x in enumerate(READS)))
    (tmp_path / "cells.txt").write_text("# known\nACGTACGT\nTGCATGCA\n")
    (tmp_path / "features.txt").write_text("F1\tAACCGG\nF2\tTTGGCC\n")
    (tmp_path / "features.tsv").write_text("FB_ID\tsequence\tantibody_name\nF1\tAACCGG\tCD4\n")
    (tmp_path / "run.yaml").write_text(settings.EXAMPLE.replace(".fastq.gz", ".fastq").replace("ratios: auto", "ratios: [0.5]"))
    return tmp_path


def test_whole_run(spark, home):
    run = settings.load(str(home / "run.yaml"))
    job = Job(spark, run)
    assert job.run_all() == ["extract", "correct", "dedup", "matrix", "downsample", "report"]
    assert job.run_all() == []  # all marks are there
    assert {(r.barcode1, r.barcode2_name, r.corrected_umi, r.reads_count) for r in job.table("molecules").collect()} == {
        ("ACGTACGT", "CD4", "AAAAAA", 3), ("ACGTACGT", "CD4", "GGGGGG", 1), ("ACGTACGT", "CD4", "TATATA", 1), ("ACGTACGT", "CD4", "TTTTTT", 1),
    }
    assert [tuple(r) for r in job.table("not_in_annotation").collect()] == [("s1", "TTGGCC", 3)]
    assert job.table("extraction_preview").count() == 9
    whole = {(r.ratio, r.reads_sampled, r.umi_types, r.umi_detected_once) for r in job.table("downsample_metrics").collect()}
    assert {(0.0, 0, 0, 0), (1.0, 6, 4, 3)} <= whole
    text = files.read_tsv(spark, job.path("matrix_dense.tsv"), "sample string, CELL string, CD4 long")
    assert [tuple(r) for r in text.collect()] == [("s1", "ACGTACGT", 4)]
    pages = (Path(run.output) / "reports/s1.html").read_text()
    assert "CD4" in pages and "polyline" in pages and "No flags" in pages
    meta = sheet(Path(run.output) / "summary.xlsx", 1)
    assert dict(zip(meta[0], meta[1], strict=True))["annotated_rate"] == str(6 / 9)
    assert sheet(Path(run.output) / "not_in_annotation.xlsx", 1) == [["barcode2_name", "reads_count"], ["F2", "3"]]

    # other ratios redo the last steps only; a lost mark redoes its step and what follows
    (home / "run.yaml").write_text((home / "run.yaml").read_text().replace("[0.5]", "[0.25]"))
    job = Job(spark, settings.load(str(home / "run.yaml")))
    assert [s for s in ("extract", "correct", "dedup", "matrix", "downsample", "report") if not job.done(s)] == ["downsample", "report"]
    with pytest.raises(ConfigError, match="needs downsample"):
        job.run_step("report")


def test_resume_by_sample(spark, home, monkeypatch):
    """A new sample, a changed file and changed settings redo what they touch, and nothing else."""
    read, real = [], fastq.samples
    monkeypatch.setattr(fastq, "samples", lambda spark, files, most=None: read.append(sorted(files)) or real(spark, files, most))
    run = settings.load(str(home / "run.yaml"))
    Job(spark, run).run_all()
    first = sorted(map(tuple, Job(spark, run).table("molecules").collect()))
    lines = [(home / f"s1_R{k}.fastq").read_text().splitlines(keepends=True) for k in (1, 2)]
    for k in (1, 2):
        (home / f"00 2_R{k}.fastq").write_text("".join(lines[k - 1][:8]))
    both = replace(run, samples={**run.samples, "00 2": tuple(str(home / f"00 2_R{k}.fastq") for k in (1, 2))})
    read.clear()
    job = Job(spark, both)
    assert job.pending("extract") == ["00 2"] and job.run_all() == ["extract", "correct", "dedup", "matrix", "downsample", "report"]
    assert read == [["00 2"], ["00 2"]]  # all pairs, and the preview
    rows = sorted(map(tuple, job.table("molecules").collect()))
    assert [r for r in rows if r[0] == "s1"] == first and [r[0] for r in rows if r[0] != "s1"] == ["00 2"] and job.run_all() == []
    meta = sheet(Path(run.output) / "summary.xlsx", 1)
    assert [r[0] for r in meta] == ["sample", "s1", "00 2"]
    for k in (1, 2):
        (home / f"00 2_R{k}.fastq").write_text("".join(lines[k - 1][:4]) * 3)
    read.clear()
    job = Job(spark, both)
    assert "report" in job.run_all() and read == [["00 2"], ["00 2"]]
    assert job.table("extracted").groupBy("sample").count().orderBy("sample").collect() == [("00 2", 3), ("s1", 9)]
    white = home / "cells.txt"
    white.write_text(white.read_text() + "GGGGGGGG\n")
    read.clear()
    assert Job(spark, both).run_all() == ["correct", "dedup", "matrix", "downsample", "report"] and read == []


def test_tables_of_a_step_go(spark, home):
    made = set(Path(tables.folder(spark).removeprefix("file://")).glob("table-*"))
    Job(spark, settings.load(str(home / "run.yaml"))).run_all()
    assert set(Path(tables.folder(spark).removeprefix("file://")).glob("table-*")) == made


def test_quick_test(spark, home):
    run = settings.load(str(home / "run.yaml"))
    found = {(r.scope, r.metric): r.value for r in quick_test(spark, run, 4).collect()}
    assert found["sample", "reads_examined"] == "4" and found["combined", "valid_reads"] == "3"
    assert found["sample", "deduplicated_molecules"] == "1" and found["segment:CELL", "linker_success"] == "4"
    assert found["top_CELL", "1:ACGTACGT"] == "3" and found["sample", "r1_length_mode"] == "13"


def sheet(path, k):
    """Cells of a sheet, as text."""
    with zipfile.ZipFile(path) as box:
        tree = ElementTree.fromstring(box.read(f"xl/worksheets/sheet{k}.xml"))
    rows = [e for e in tree.iter() if e.tag.endswith("}row")]
    return [["".join(cell.itertext()) for cell in row] for row in rows]


def test_workbook():
    made = io.BytesIO(workbook([("a/b", [["x", "y"], [1, "<&\x01>"], [2.5, float("nan")]]), ("A_B", [])]))
    assert sheet(made, 1) == [["x", "y"], ["1", "<&>"], ["2.5", "nan"]]
    with zipfile.ZipFile(made) as box:
        for name in box.namelist():
            ElementTree.fromstring(box.read(name))
    assert titles(["a/b", "A_B", "x" * 40, "x" * 40]) == ["a_b", "A_B_2", "x" * 31, "x" * 29 + "_2"]
    assert [letters(k) for k in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_flags():
    assert flags(0.5, 1, 10) == [] and len(flags(0.4, 1, 11)) == 2 and flags(1.0, 0, 0) == []


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("CB1\tAAAC\tAAAC\nCB2\tCCGG\tCCGG\n", {"AAAC": "AAAC", "CCGG": "CCGG"}),
        ("CB1\taaac\n\nCB2\tCCGG\n", {"AAAC": "AAAC", "CCGG": "CCGG"}),
        ("sequence\tx\tantibody_name\tFB_ID\nAAAC\t1\tCD4\tF1\n", {"AAAC": "CD4"}),
        ("F1\tAAAC\tCD4\nF2\taaac\tCD8\n", None), ("F1\tAAAC\tCD4\nF2\tCCGG\tCD4\n", None), ("AAAC\n", None), ("", None),
    ],
)
def test_annotation(spark, tmp_path, text, expected):
    path = tmp_path / "a.tsv"
    path.write_text(text)
    columns = "FB_ID", "sequence", "antibody_name"
    if expected is None:
        with pytest.raises(ConfigError):
            fastq.annotation(spark, str(path), columns)
    else:
        assert {r.sequence: r.name for r in fastq.annotation(spark, str(path), columns).collect()} == expected


def raw(**changes):
    return {**settings.text_to_settings(settings.EXAMPLE), **changes}


def test_layouts(tmp_path):
    plain = settings.parse(raw(), tmp_path).plan
    base = raw()
    grouped = {k: v for k, v in base.items() if k not in ("barcode1", "barcode2", "umi")}
    items = {r: base[r]["segments"] for r in ("barcode1", "barcode2", "umi")}
    groups = [{"barcode1": "CELL", "segments": items["barcode1"]}, {"role": "barcode2", "name": "FB", "segments": items["barcode2"]}]
    assert settings.parse({**grouped, "barcode": groups, "umi": items["umi"]}, tmp_path).plan.segments == plain.segments
    flat = [{**x, "target": r} for r, xs in items.items() for x in xs]
    legacy = settings.parse({**grouped, "segments": flat}, tmp_path).plan
    assert legacy.segments == plain.segments and legacy.names["barcode1"] == "barcode1"
    assert [s.method for s in plain.segments] == ["linker_fixed", "fixed", "fixed"] and plain.of("barcode2")[0].padding == 0


def test_samples(tmp_path):
    for name in ("b", "a"):
        (tmp_path / "raw" / name).mkdir(parents=True)
    found = settings.discovered({"auto": {"raw_dir": "raw", "r1": "{sample}.1.fq"}}, tmp_path)
    assert list(found) == ["a", "b"] and found["a"] == (str(tmp_path / "raw/a/a.1.fq"), str(tmp_path / "raw/a/a_raw_2.fq.gz"))
    assert settings.place(tmp_path, "s3a://x/y.fq", "x") == "s3a://x/y.fq"


@pytest.mark.parametrize(
    "changes",
    [
        {"samples": []}, {"samples": [{"sample": "a", "r1": "x", "r2": "y"}] * 2}, {"samples": {"auto": {"raw_dir": "nowhere"}}}, {"barcode1": {"segments": []}},
        {"umi": {"segments": [{"segment": "UMI", "read": "R3", "start": 0, "length": 6}]}}, {"umi": {"segments": [{"segment": "UMI", "read": "R2", "length": 6}]}},
        {"umi": {"segments": [{"segment": "UMI", "read": "R2", "method": "guess", "start": 0, "length": 6}]}}, {"correction_umi": {"method": "other"}},
        {"downsample": {"ratios": [2]}}, {"downsample": {"ratios": "all"}}, {"downsample": {"repeats": 0}}, {"library": "pb-cb"}, {"barcode2_annotation": {}},
        {"library": "pi_seq", "pi_seq": {"dominance_threshold": 2}}, {"quick_test": {"reads": 0}},
    ],
)
def test_bad_settings(tmp_path, changes):
    with pytest.raises(ConfigError):
        settings.parse(raw(**changes), tmp_path)


def test_command_line(home, capsys):
    assert main(["validate-config", str(home / "run.yaml")]) == 0 and "1 samples" in capsys.readouterr().out
    assert main(["init-config", str(home / "new.yaml")]) == 0 and main(["init-config", str(home / "new.yaml")]) == 2
    assert main(["validate-config", str(home / "new.yaml")]) == 2  # it names files that aren't there
    assert main(["validate-config", str(home / "gone.yaml")]) == 2
