"""A whole run in steps, all samples in one job, with results that outlive it.

Each step writes its tables under the output folder as Parquet, a folder per sample
within, and last of all its mark: a digest per sample of the settings that the step
depends on, its own and earlier ones', and of path, size and time of the files that it
is made from.  A step works on the samples whose digest is another one, so an interrupted
run goes on where it stopped, a changed file or setting redoes what it touches, and a new
sample leaves the others as they are.  Reports, and tables whose columns are features,
cover all samples and are made again when one changes.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandloom.operators import correct, downsample, extract, matrix, metrics, pairs, umi
from strandloom.plans import reports
from strandloom.plans.config import ConfigError
from strandloom.plans.tables import saved, scope
from strandloom.sources import fastq, files
from strandloom.sources.settings import Run

log = logging.getLogger("strandloom")

#: The settings that each step's digest covers, besides the steps before it.
DEPENDS: dict[str, tuple[str, ...]] = {
    "extract": ("segments", "names", "preview_reads"),
    "correct": ("whitelists", "annotation", "sequence_only", "trace"),
    "dedup": ("umi_method", "umi_distance", "library", "dominance"),
    "matrix": (),
    "pair-map": ("min_parent_reads", "parent_child_ratio"),
    "downsample": ("ratios", "repeats", "seed"),
    "report": (),
}


#: Stands for all samples in a report's mark.
ALL = "*"


def _part(sample: str) -> str:
    """The folder of a sample's rows: names may hold any characters."""
    return "s" + hashlib.sha1(sample.encode()).hexdigest()[:16]


def steps_of(run: Run) -> list[str]:
    """The steps of a run; pair libraries end in a pair map."""
    return ["extract", "correct", "dedup", "pair-map"] if run.plan.library == "pb-cb" else ["extract", "correct", "dedup", "matrix", "downsample", "report"]


class Job:
    """One run's tables, by name."""

    def __init__(self, spark: SparkSession, run: Run) -> None:
        self.spark, self.run, self.plan = spark, run, run.plan
        self.todo = list(run.samples)  # the samples that the step at hand works on

    def path(self, name: str) -> str:
        return f"{self.run.output}/{name}"

    def _read(self, name: str) -> DataFrame:
        schema = StructType.fromJson(json.loads(files.read(self.spark, self.path(f"_schemas/{name}"))))
        return self.spark.read.schema(schema.add("part", "string")).parquet(self.path(name)).drop("part")

    def table(self, name: str) -> DataFrame:
        """Rows of the samples that the step works on; outside of a step, of all."""
        return self._read(name).where(F.col("sample").isin(self.todo))

    def save(self, df: DataFrame, name: str, dealt: bool = True) -> DataFrame:
        """Puts the rows in the place of those that their samples had.

        ``dealt`` gathers a sample's rows into few files, large samples into more;
        what is read sample by sample needn't be.
        """
        for sample in self.todo:
            files.remove(self.spark, f"{self.path(name)}/part={_part(sample)}")
        files.write(self.spark, self.path(f"_schemas/{name}"), df.schema.json())
        parted = df.withColumn("part", F.concat(F.lit("s"), F.substring(F.sha1(F.col("sample").cast("binary")), 1, 16)))
        parted = parted.hint("rebalance", "part") if dealt else parted
        parted.write.partitionBy("part").mode("append").parquet(self.path(name))
        return self.table(name)

    def shown(self, df: DataFrame, name: str) -> DataFrame:
        """Saved, and all samples' rows written as text under the configured target names."""
        saved = self.save(df, name)
        self._text(self._read(name).where(F.col("sample").isin(list(self.run.samples))), name)
        return saved

    def shown_whole(self, df: DataFrame, name: str) -> None:
        """A table of all samples, written anew."""
        df.write.mode("overwrite").parquet(self.path(name))
        self._text(self.spark.read.schema(df.schema).parquet(self.path(name)), name)

    def _text(self, df: DataFrame, name: str) -> None:
        names = self.plan.names
        titles = {"barcode1": names["barcode1"], "barcode2": f"{names['barcode2']}_sequence", "barcode2_name": f"{names['barcode2']}_name", "umi": names["umi"]}
        files.write_tsv(df.withColumnsRenamed(titles), self.path(f"{name}.tsv"))

    def whitelists(self) -> dict[str, DataFrame]:
        return {name: fastq.whitelist(self.spark, path) for name, path in self.run.whitelists.items()}

    def annotation(self) -> DataFrame | None:
        a = self.run.annotation
        return a and fastq.annotation(self.spark, a.path, (a.id_column, a.sequence_column, a.name_column), a.allow_duplicate_names)

    def extract(self) -> None:
        inputs = {k: self.run.samples[k] for k in self.todo}
        got = self.save(extract.extract(fastq.samples(self.spark, inputs), self.plan), "extracted", dealt=False)
        self.shown(extract.stats(got, self.plan), "extraction_stats")
        leading = fastq.samples(self.spark, inputs, self.run.preview_reads)  # by place in the file
        self.shown(extract.flat(extract.extract(leading, self.plan), self.plan), "extraction_preview")

    def correct(self) -> None:
        got, annotation = self.table("extracted"), self.annotation()
        fixed = self.save(correct.correct(got, self.plan, {k: w.select("known") for k, w in self.whitelists().items()}), "fixed")
        traced, all_reads = correct.trace(fixed, self.plan), correct.joined(fixed, self.plan, annotation)
        self.shown(correct.valid(all_reads), "valid_reads")
        self.shown(correct.stats(got, traced, all_reads, self.plan), "correction_stats")
        if annotation is not None:
            self.shown(correct.annotation_gap(traced, self.plan, annotation), "not_in_annotation")
        if self.run.trace:
            self.shown(traced.drop("method"), "correction_trace")

    def dedup(self) -> None:
        counts = self.save(umi.raw_counts(self.table("valid_reads")), "raw_umi_counts")
        pi = self.plan.library == "pi-seq"
        found = self.shown(umi.molecules(umi.assigned(counts, self.plan.umi_method, self.plan.umi_distance)), "molecules_unfiltered" if pi else "molecules")
        if pi:
            marked = self.save(pairs.pi_marked(found, self.plan.dominance), "pi_marked")
            self.shown(pairs.pi_filtered(marked), "molecules")
            self.shown(pairs.pi_qc(marked, self.plan.dominance), "pi_seq_qc")

    def _matrix(self, molecules: DataFrame, name: str) -> None:
        self.save(matrix.long(molecules), name)
        counts = self._read(name).where(F.col("sample").isin(list(self.run.samples)))
        features = [r[0] for r in counts.select("barcode2_name").distinct().orderBy("barcode2_name").collect()]  # columns of the dense form
        self.shown_whole(matrix.dense(counts, features), f"{name}_dense")

    def matrix(self) -> None:
        self._matrix(self.table("molecules"), "matrix")

    def pair_map(self) -> None:
        parts = self.table("molecules").select("sample", F.col("barcode1").alias("pb"), F.col("barcode2_name").alias("cb"), "reads_count")
        found = self.shown(pairs.mapping(parts), "pair_mapping")
        alias = self.shown(pairs.aliases(found, self.plan.min_parent_reads, self.plan.parent_child_ratio), "cb_aliases")
        kept = self.shown(pairs.dominant(pairs.resolved(found, alias), self.plan.dominance), "pb_cb_map")
        per_cb = self.shown(pairs.pbs_per_cb(kept), "cb_pb_counts")
        self.shown(pairs.distribution(per_cb), "cb_pb_distribution")

    def downsample(self) -> None:
        thinned = self.save(downsample.kept(self.table("molecules"), self.plan), "thinned")
        points = self.shown(downsample.metrics(thinned, self.plan), "downsample_metrics")
        best = self.shown(downsample.optimal(points), "optimal_point")
        self._matrix(self.shown(downsample.at_optimum(thinned, best), "optimal_detail"), "optimal_matrix")

    def report(self) -> None:
        reports.write_all(self)

    def digest(self, step: str, sample: str) -> str:
        """Of all settings that the step depends on, and of the files that the sample's rows are made from."""
        told = {**{k: v for k, v in asdict(self.run).items() if k != "plan"}, **asdict(self.plan)}
        order = list(DEPENDS)
        keys = sorted({k for s in order[: order.index(step) + 1] for k in DEPENDS[s]})
        paths = list(self.run.samples[sample])
        if step != "extract":
            paths += [*self.run.whitelists.values(), *([self.run.annotation.path] if self.run.annotation else [])]
        inputs = [files.fingerprint(self.spark, p) for p in paths]
        return hashlib.sha256(json.dumps([{k: told[k] for k in keys}, inputs], sort_keys=True).encode()).hexdigest()

    def digests(self, step: str) -> dict[str, str]:
        """By sample; a report has one for all."""
        each = {s: self.digest(step, s) for s in self.run.samples}
        return {ALL: hashlib.sha256(json.dumps(each, sort_keys=True).encode()).hexdigest()} if step == "report" else each

    def marks(self, step: str) -> dict[str, str]:
        mark = self.path(f"_steps/{step}")
        return json.loads(files.read(self.spark, mark)) if files.exists(self.spark, mark) else {}

    def pending(self, step: str) -> list[str]:
        """The samples that the step has to work on."""
        marks = self.marks(step)
        left = [s for s, digest in self.digests(step).items() if marks.get(s) != digest]
        return list(self.run.samples) if left == [ALL] else left

    def done(self, step: str) -> bool:
        return not self.pending(step)

    def run_step(self, step: str, again: bool = False) -> bool:
        """False if the step was done before."""
        order = steps_of(self.run)
        if step not in order:
            raise ConfigError(f"no step {step} in this library")
        todo = list(self.run.samples) if again else self.pending(step)
        if not todo:
            log.info("%s: done before", step)
            return False
        earlier = {"report": order[:-1], "downsample": order[:3]}.get(step, order[: min(order.index(step), 3)])
        if gone := [s for s in earlier if set(self.pending(s)) & set(todo)]:
            raise ConfigError(f"{step} needs {', '.join(gone)}")
        digests = self.digests(step)
        for later in order[order.index(step) :]:  # what follows is out of date
            files.write(self.spark, self.path(f"_steps/{later}"), json.dumps({k: v for k, v in self.marks(later).items() if k not in (ALL, *todo)}))
        began = time.time()
        self.todo = todo
        try:
            work: Callable[[], None] = getattr(self, step.replace("-", "_"))
            with scope(self.spark):
                work()
        finally:
            self.todo = list(self.run.samples)
        made = digests if step == "report" else {k: digests[k] for k in todo}
        files.write(self.spark, self.path(f"_steps/{step}"), json.dumps({**self.marks(step), **made}))
        log.info("%s: %d samples, %.1f s", step, len(todo), time.time() - began)
        return True

    def run_all(self) -> list[str]:
        """Names of the steps that were run."""
        ran: list[str] = []
        for step in steps_of(self.run):
            if self.run_step(step, again=self.run.overwrite):
                ran.append(step)
        return ran


def quick_test(spark: SparkSession, run: Run, most: int | None = None) -> DataFrame:
    """sample, scope, metric, value of the leading pairs of each sample, taken through all steps; nothing is kept.

    Reads count as valid by the rules of the whole run.
    """
    job = Job(spark, run)
    plan, long = run.plan, []
    reads = saved(fastq.samples(spark, run.samples, most or run.quick_reads))
    got = saved(extract.extract(reads, plan))
    fixed = saved(correct.correct(got, plan, {k: w.select("known") for k, w in job.whitelists().items()}))
    all_reads = correct.joined(fixed, plan, job.annotation())
    valid = saved(correct.valid(all_reads))
    found = umi.molecules(umi.assigned(umi.raw_counts(valid), plan.umi_method, plan.umi_distance))

    def told(df: DataFrame, scope: Column, columns: list[str]) -> None:
        rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in columns])
        long.append(df.select("sample", scope.alias("scope"), F.inline(rows)))

    lengths = metrics.read_lengths(reads).withColumnsRenamed({"reads": "reads_examined", **{f"r{k}_{e}": f"r{k}_length_{e}" for k in (1, 2) for e in ("min", "max", "mode")}})
    told(lengths, F.lit("sample"), [c for c in lengths.columns if c != "sample"])
    segments = extract.stats(got, plan).withColumn("scope", F.concat(F.lit("segment:"), "segment"))
    told(segments, F.col("scope"), ["linker_attempted", "linker_success", "linker_success_rate", "fixed_success", "final_success_rate"])
    corrections = correct.stats(got, correct.trace(fixed, plan), all_reads, plan)
    told(corrections, F.col("scope"), ["total_reads", "valid_reads", "valid_rate"])
    told(metrics.molecule_sums(found), F.lit("sample"), ["deduplicated_molecules", "duplication_ratio"])
    for scope, key in ((f"top_{plan.names['barcode1']}", "barcode1"), ("top_feature", "barcode2_name")):
        top = correct.ranked(valid.groupBy("sample", key).agg(F.count("*").alias("reads")), "reads", key, 10)
        long.append(top.select("sample", F.lit(scope).alias("scope"), F.concat_ws(":", F.col("rank").cast("string"), key).alias("metric"), F.col("reads").cast("string").alias("value")))
    out = long[0]
    for df in long[1:]:
        out = out.unionByName(df)
    return out
