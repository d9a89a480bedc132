"""Run and extraction ledgers: rows, appending, latest state, counts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docspark.sources.scratch import stage
from docspark.vocab import UNSCORED_FIELDS


@dataclass(frozen=True)
class Storage:
    """Where one pipeline version keeps its tables."""

    version: str
    root: str

    @property
    def runs(self) -> str:
        return f"{self.root.rstrip('/')}/runs_{self.version}"

    @property
    def extractions(self) -> str:
        return f"{self.root.rstrip('/')}/extractions_{self.version}"

    @property
    def rejected(self) -> str:
        return f"{self.root.rstrip('/')}/rejected_{self.version}"

    def artifacts(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/artifacts_{self.version}/{kind}"

    def doc_prefix(self, doc_id: Column) -> Column:
        base = f"{self.root.rstrip('/')}/artifacts_{self.version}/"
        return F.concat(F.lit(base), doc_id.cast("string"), F.lit("/"))


def load_storage(configs: Mapping[str, Mapping[str, str]], phase: str) -> Storage:
    """The storage of one phase out of a configuration of all phases."""
    if phase not in configs:
        raise KeyError(f"no storage configured for {phase!r}; there is {sorted(configs)}")
    block = configs[phase]
    return Storage(block["pipeline_version"], block["root"])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order``.

    An aggregation, not a window: rows of a key combine before the shuffle, so a
    key with very many rows costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("row")).select(*keys, "row.*")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last run of each document and how many runs it has."""
    rest = [c for c in runs.columns if c != "doc_id"]
    return (
        runs.groupBy("doc_id")
        .agg(
            F.max_by(F.struct(*rest), F.struct("completed_at", "run_id")).alias("row"),
            F.count(F.lit(1)).alias("runs"),
        )
        .select("doc_id", "row.*", "runs")
    )


def recent_runs(runs: DataFrame, limit: int = 200) -> DataFrame:
    """The newest runs, newest first."""
    return runs.orderBy(F.desc("completed_at"), F.desc("run_id")).limit(limit)


def key_id(*parts: Column | str) -> Column:
    """An id that follows from its parts, so a repeated attempt writes the same id."""
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("\x1f", *cols), 256)


def run_rows(results: DataFrame, storage: Storage, completed_at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Run rows for ``results``: one for every document, accepted or not. ``keep`` names other columns to carry along."""
    have = results.columns

    def col(name: str, kind: str, default=None) -> Column:
        c = F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
        return (c if default is None else F.coalesce(c, F.lit(default))).alias(name)

    cards = F.to_json("verifier_scorecards") if "verifier_scorecards" in have else F.lit("[]")
    errors = F.to_json("preprocessing_errors") if "preprocessing_errors" in have else F.lit("[]")
    prefix = F.coalesce(F.col("artifacts_gcs_prefix"), storage.doc_prefix(F.col("doc_id"))) if "artifacts_gcs_prefix" in have else storage.doc_prefix(F.col("doc_id"))
    run_id = F.col("run_id") if "run_id" in have else key_id("doc_id", F.lit(storage.version), F.lit("run"))
    return results.select(
        run_id.alias("run_id"),
        "doc_id",
        F.lit(storage.version).alias("pipeline_version"),
        col("verdict", "string"),
        col("verdict_reason", "string"),
        col("cost_usd", "double", 0.0),
        col("latency_ms", "bigint", 0),
        col("otel_trace_id", "string"),
        errors.alias("preprocessing_errors"),
        cards.alias("verifier_scorecards"),
        prefix.alias("artifacts_gcs_prefix"),
        (F.current_timestamp() if completed_at is None else completed_at).alias("completed_at"),
        *keep,
    )


def is_stored() -> Column:
    """Whether a result has an extraction row: accepted, and with an envelope."""
    return F.coalesce((F.col("verdict") == "auto_accept") & F.col("envelope").isNotNull(), F.lit(False))


def extraction_rows(results: DataFrame, storage: Storage, extracted_at: Column | None = None) -> DataFrame:
    """Extraction rows: only for accepted documents that have an envelope."""
    run_id = F.col("run_id") if "run_id" in results.columns else key_id("doc_id", F.lit(storage.version), F.lit("run"))
    return results.filter(is_stored()).select(
        key_id("doc_id", F.lit(storage.version), F.lit("extraction")).alias("extraction_id"),
        run_id.alias("run_id"),
        "doc_id",
        F.lit(storage.version).alias("pipeline_version"),
        F.col("envelope").alias("genomic_pathology_extraction"),
        (F.current_timestamp() if extracted_at is None else extracted_at).alias("extracted_at"),
    )


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists on whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


MANIFESTS = "manifests"


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest of a table."""
    files, folder = list_folder(spark, f"{path}/{MANIFESTS}"), f"{path}/{MANIFESTS}"
    found = [f for f in files if f.endswith(".json")]
    if not found:
        return None
    return json.loads(spark.read.text(f"{folder}/{max(found)}", wholetext=True).first()[0])


def artifact_manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest of an artifact table: its number, buckets, schema, and the folder of each bucket."""
    return read_manifest(spark, path)


def read_artifact_table(spark: SparkSession, path: str) -> DataFrame:
    """The artifacts of the newest manifest; what a write has not finished is not seen."""
    now = artifact_manifest(spark, path)
    if now is None:
        raise FileNotFoundError(f"no artifacts in {path}")
    return _read_buckets(spark, path, now, now["folders"])


def _read_buckets(spark: SparkSession, path: str, manifest: dict, buckets: Iterable[str]) -> DataFrame:
    schema = StructType.fromJson(manifest["schema"])
    folders = [f"{path}/{manifest['folders'][b]}/doc_bucket={b}" for b in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def switch_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    """Make a manifest the newest one: written beside, then renamed, so a reader sees all of it or nothing."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    beside = Path(f"{path}/{MANIFESTS}/{uuid.uuid4().hex}.tmp")
    fs = beside.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(beside, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    place = Path(f"{path}/{MANIFESTS}/{manifest['number']:010d}.json")
    if fs.exists(place) or not fs.rename(beside, place):
        fs.delete(beside, False)
        raise RuntimeError(f"another write of {path} was faster")


_switch = switch_manifest


def write_artifacts(artifacts: DataFrame, storage: Storage, kind: str, buckets: int = 256) -> None:
    """Put in or replace the artifacts of one kind of the documents written; those of others stay.

    One folder per hash bucket, never one per document. Only the buckets of these
    documents are read and merged. They are written to a version folder of their
    own, and a manifest that names the folder of every bucket is switched last:
    readers see the old artifacts or the new ones, whatever fails in between. Of
    several rows of one document the greatest stays. One writer at a time; one
    that sees another's manifest in its place fails. The number of buckets is
    that of the first write. Old folders stay for
    readers that hold an older manifest until :func:`remove_old_artifacts`.
    """
    path, spark = storage.artifacts(kind), artifacts.sparkSession
    now = artifact_manifest(spark, path)
    buckets = now["buckets"] if now else buckets
    rest = [c for c in artifacts.columns if c != "doc_id"]
    one = artifacts.groupBy("doc_id").agg(F.max(F.struct(*rest)).alias("row")).select("doc_id", "row.*")
    bucket = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(buckets)), F.lit(0)).cast("int")
    new = stage(one.withColumn("doc_bucket", bucket), "artifacts-new")
    touched = [str(r[0]) for r in new.select("doc_bucket").distinct().collect()]  # at most one per bucket
    merged = new
    if now:
        old = _read_buckets(spark, path, now, [b for b in touched if b in now["folders"]])
        kept = old.join(new.select("doc_id").distinct(), "doc_id", "left_anti")
        merged = kept.withColumn("doc_bucket", bucket).unionByName(new, allowMissingColumns=True)
    number = now["number"] + 1 if now else 1
    version = f"version-{number:010d}-{uuid.uuid4().hex[:8]}"
    spread = merged.repartition("doc_bucket", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(8)))
    spread.write.partitionBy("doc_bucket").parquet(f"{path}/{version}")
    folders = (now["folders"] if now else {}) | dict.fromkeys(touched, version)
    schema = json.loads(merged.drop("doc_bucket").schema.json())
    _switch(spark, path, {"number": number, "buckets": buckets, "schema": schema, "folders": folders})


def remove_old_artifacts(spark: SparkSession, storage: Storage, kind: str) -> int:
    """Delete the version folders that the newest manifest does not name, and older manifests.

    For times when nobody writes or reads an older state. Gives the number of folders deleted.
    """
    path = storage.artifacts(kind)
    now = artifact_manifest(spark, path)
    if now is None:
        return 0
    used = set(now["folders"].values())
    old = [v for v in list_folder(spark, path) if v.startswith("version-") and v not in used]
    newest = f"{now['number']:010d}.json"
    stale = [f"{MANIFESTS}/{m}" for m in list_folder(spark, f"{path}/{MANIFESTS}") if m != newest]
    for name in [*stale, *old]:
        delete_folder(spark, f"{path}/{name}")
    return len(old)


def merged_artifacts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old artifacts with those of the new documents replaced."""
    ids = new.select("doc_id").distinct()
    return old.select(*new.columns).join(ids, "doc_id", "left_anti").unionByName(new)


def record_kpis(rows: DataFrame) -> DataFrame:
    """Populated fields per document, from records in long form."""
    filled = F.coalesce(F.col("value"), F.lit("")) != ""
    return rows.groupBy("doc_id").agg(
        F.count_if(filled).alias("populated"),
        F.count_if(filled & ~F.col("field").isin(*UNSCORED_FIELDS)).alias("extracted"),
        F.count(F.lit(1)).alias("fields"),
    )


def envelope_counts(df: DataFrame, column: str = "envelope") -> DataFrame:
    """Add the declared object counts of the three array sections, 0 where there is none."""
    root = F.try_parse_json(column)

    def count(path: str) -> Column:
        return F.coalesce(F.try_variant_get(root, path, "bigint"), F.lit(0))

    return df.withColumns(
        {
            "variants": count("$.Genomic_Variant_umbrella.count_of_Genomic_Variants"),
            "biomarkers": count("$.other_molecular_biomarker_umbrella.count"),
            "tested": count("$.tested_biomarker_umbrella.count_of_tested_biomarkers"),
        }
    )
