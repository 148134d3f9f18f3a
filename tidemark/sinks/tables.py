"""Feature tables and the ways to write them.

Where the catalogue's format supports it, an upsert is one ``MERGE`` (``merge_into_catalog``).  On
plain parquet a table's rows lie in buckets of their key's hash, and a version is a numbered manifest that lists the files of
every bucket.  A write adds files, then the next manifest, which must not exist yet: readers see the old version or the new one, a
lost executor or driver leaves only files behind that no manifest names, of two writers the second starts from the
first one's version, and a replayed stream batch is recognised by its number.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.model import FeatureView, check_schema, reject_rows
from tidemark.operators.embeddings import embedding_document_id
from tidemark.operators.snapshot import latest_per_entity, recomputed
from tidemark.sinks import history_index

BUCKETS = 64
_BUCKET = "__bucket"


@dataclass
class WriteResult:
    records_ingested: int = 0
    records_failed: int = 0
    duration_ms: int = 0
    failures: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Manifest:
    """A version: the schema, the files of each bucket (paths below the table), the last batch number of each stream."""

    version: int | None = None
    buckets: int = 0
    schema: str | None = None
    files: dict[str, list[str]] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)


class Conflict(RuntimeError):
    """Another writer changed the same buckets meanwhile."""


class VersionedTable:
    """A parquet table of which writes replace buckets of keys, keyed by ``keys``.

    ``buckets`` holds for a new table; give it so many that one bucket is rewritten in good time.  All rows of a key lie in one
    bucket; null keys are keys.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    # -- files

    def _hadoop(self, name: str = ""):
        """(file system, path) of a file below the table."""
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        return path.getFileSystem(sc._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._hadoop(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _files(self, folder: str) -> list[str]:
        """Parquet files below a folder of the table."""
        fs, path = self._hadoop(folder)
        found, out = fs.listFiles(path, True), []
        while found.hasNext():
            name = found.next().getPath().toString()
            if name.endswith(".parquet"):
                out.append(f"{folder}/{name.split(f'/{folder}/', 1)[1]}")
        return out

    def _write_once(self, name: str, text: str) -> bool:
        """Make a whole file appear, unless one of that name exists."""
        fs, target = self._hadoop(name)
        _, draft = self._hadoop(f"{name}.{uuid.uuid4().hex}.draft")
        out = fs.create(draft, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        try:
            if fs.getScheme() == "file":  # a local rename would replace the other writer's file; a link does not
                os.link(draft.toUri().getPath(), target.toUri().getPath())
                return True
            return not fs.exists(target) and fs.rename(draft, target)
        except FileExistsError:
            return False
        finally:
            fs.delete(draft, False)

    # -- versions

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("versions") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """A version's manifest, the newest one's by default; an empty one where the table does not exist."""
        if version is None:
            known = self.versions()
            if not known:
                return Manifest(buckets=self.buckets)
            version = known[-1]
        text = self.spark.read.text(f"{self.path}/versions/{version:012d}.json", wholetext=True).head()[0]
        return Manifest(**json.loads(text))

    def state(self) -> dict:
        """Current version and the last batch number of each stream."""
        now = self.manifest()
        return {"version": now.version, "streams": now.streams}

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, the newest by default; nothing where the table does not exist."""
        now = self.manifest(version)
        return None if now.version is None else self._rows(now, list(now.files))

    def _rows(self, manifest: Manifest, buckets: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest.schema))
        paths = [f"{self.path}/{f}" for b in buckets for f in manifest.files.get(b, [])]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _commit(self, based: Manifest, change: Callable[[Manifest], Manifest | None], replaced: list[str] | None) -> Manifest | None:
        """Publish ``change`` of the newest version.  ``replaced`` buckets must be as they were in the version that the change is based
        on, else it is a conflict; a change that returns nothing is already there."""
        while True:
            head = self.manifest()
            if replaced and head.version != based.version and any(head.files.get(b) != based.files.get(b) for b in replaced):
                raise Conflict(f"buckets of {self.path} were changed by another writer")
            new = change(head)
            if new is None:
                return None
            number = 0 if head.version is None else head.version + 1
            new = replace(new, version=number)
            if self._write_once(f"versions/{number:012d}.json", json.dumps(asdict(new))):
                return new

    # -- rows

    def _bucketed(self, df: DataFrame, buckets: int) -> DataFrame:
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int"))

    def _store(self, df: DataFrame, buckets: int, seen: Observation | None = None) -> dict[str, list[str]]:
        """Write rows into new files; the files of each bucket.  Large buckets are written by several tasks.  ``seen`` counts the rows."""
        folder = f"data/{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"
        rows = _counted(self._bucketed(df, buckets).hint("rebalance", _BUCKET), seen)
        rows.write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        out: dict[str, list[str]] = {}
        for name in self._files(folder):
            bucket = name.split(f"{_BUCKET}=", 1)[1].split("/", 1)[0]
            out.setdefault(bucket, []).append(name)
        return out

    def _schema(self, old: Manifest, df: DataFrame) -> str:
        """The columns of the table and those that ``df`` adds."""
        fields = T.StructType.fromJson(json.loads(old.schema)).fields if old.schema else []
        known = {f.name for f in fields}
        return T.StructType([*fields, *(f for f in df.schema.fields if f.name not in known)]).json()

    def _ready(self) -> None:
        fs, path = self._hadoop("versions")
        fs.mkdirs(path)

    def publish(
        self, df: DataFrame, stream: str | None = None, batch_id: int | None = None, seen: Observation | None = None
    ) -> None:
        """Replace all rows."""
        self._ready()
        buckets = self.manifest().buckets
        files = self._store(df, buckets, seen)

        def change(head: Manifest) -> Manifest:
            streams = dict(head.streams) | ({stream: batch_id} if stream is not None else {})
            return replace(head, buckets=buckets, schema=df.schema.json(), files=files, streams=streams)

        self._commit(self.manifest(), change, None)

    def append(self, df: DataFrame, seen: Observation | None = None) -> None:
        """Add rows, whatever their keys; only they are written."""
        self._ready()
        now = self.manifest()
        files = self._store(df, now.buckets, seen)

        def change(head: Manifest) -> Manifest:
            both = {b: [*head.files.get(b, []), *files.get(b, [])] for b in {*head.files, *files}}
            return replace(head, buckets=now.buckets, schema=self._schema(head, df), files=both)

        self._commit(now, change, None)

    def merge(
        self,
        df: DataFrame,
        combine: Callable[[DataFrame | None, DataFrame], DataFrame],
        stream: str | None = None,
        batch_id: int | None = None,
        seen: Observation | None = None,
    ) -> None:
        """Replace the buckets that have keys of ``df`` by ``combine(their rows, df)``; other buckets are neither read nor written.

        ``df`` is evaluated once and lies in the table's folder while it is merged.  If another writer changes one of the buckets meanwhile,
        the merge is done again on the new version.
        """
        self._ready()
        staged = f"staged/{uuid.uuid4().hex}"
        _counted(df, seen).write.parquet(f"{self.path}/{staged}")
        new = self.spark.read.schema(df.schema).parquet(f"{self.path}/{staged}")
        try:
            while True:
                now = self.manifest()
                if stream is not None and now.streams.get(stream, -1) >= batch_id:
                    return
                # At most one row a bucket.
                touched = [str(r[0]) for r in self._bucketed(new, now.buckets).select(_BUCKET).distinct().collect()]
                schema = self._schema(now, new)
                old = self._rows(replace(now, schema=schema), touched) if now.version is not None else None
                files = self._store(combine(old, new), now.buckets)

                def change(head: Manifest) -> Manifest | None:
                    if stream is not None and head.streams.get(stream, -1) >= batch_id:
                        return None
                    kept = {b: f for b, f in head.files.items() if b not in touched}
                    streams = dict(head.streams) | ({stream: batch_id} if stream is not None else {})
                    return replace(head, buckets=now.buckets, schema=self._schema(head, new), files=kept | files, streams=streams)

                try:
                    self._commit(now, change, touched)
                    return
                except Conflict:
                    continue
        finally:
            fs, path = self._hadoop(staged)
            fs.delete(path, True)

    def retain(self, versions: int, grace_seconds: float = 86_400.0) -> int:
        """Forget all but the newest ``versions``, and remove files that no remaining version names.  Files younger than
        ``grace_seconds`` stay, as a write that is under way may be about to name them.  Returns the number of files removed."""
        known = self.versions()
        fs, _ = self._hadoop()
        for number in known[:-versions]:
            fs.delete(self._hadoop(f"versions/{number:012d}.json")[1], False)
        named = {f for v in known[-versions:] for files in self.manifest(v).files.values() for f in files}
        removed = 0
        for folder in self._names("data"):
            files = self._files(f"data/{folder}")
            for name in files:
                path = self._hadoop(name)[1]
                if name not in named and time.time() - fs.getFileStatus(path).getModificationTime() / 1000 >= grace_seconds:
                    fs.delete(path, False)
                    removed += 1
                    files = [f for f in files if f != name]
            if not files:
                fs.delete(self._hadoop(f"data/{folder}")[1], True)
        return removed


def upsert(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; null keys are equal to each other."""
    if old is None:
        return new
    named = new.select(*[F.col(k).alias(f"__new_{i}") for i, k in enumerate(keys)]).distinct()
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & old[k].eqNullSafe(named[f"__new_{i}"])
    return old.join(named, same, "left_anti").unionByName(new, allowMissingColumns=True)


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows that share a key the latest by ``event_time``, then ``ingestion_time``, where the table has these; else any."""
    order = [c for c in ("event_time", "ingestion_time") if c in df.columns]
    rest = [c for c in df.columns if c not in keys]
    if not order or not rest:
        return df.dropDuplicates(keys)
    latest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__latest")
    return df.groupBy(*keys).agg(latest).select(*[F.col(c) if c in keys else F.col(f"__latest.{c}") for c in df.columns])


def merge_into_catalog(df: DataFrame, table: str, keys: list[str]) -> None:
    """Upsert through ``MERGE``, for table formats that have it."""
    target = table.rsplit(".", 1)[-1]
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(f"s.{k}") == F.col(f"{target}.{k}"))
    df.alias("s").mergeInto(table, match).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def _counted(df: DataFrame, seen: Observation | None) -> DataFrame:
    """Count rows while they are written instead of running the plan twice.  What is counted must be the last step: a stage that turns
    out to be empty is dropped with the counter in it."""
    return df if seen is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))


def write_features(
    df: DataFrame, table: VersionedTable, mode: str = "merge", view: FeatureView | None = None
) -> WriteResult:
    """Write a feature DataFrame: ``merge`` (upsert by key, default), ``overwrite`` or ``append``.  A merge takes one row a
    key, the latest of the batch."""
    if mode not in ("merge", "overwrite", "append"):
        raise ValueError(f"unknown write mode {mode!r}")
    if view is not None:
        check_schema(df, view)
    start = time.monotonic()
    seen = Observation("features")
    if mode == "overwrite":
        table.publish(df, seen=seen)
    elif mode == "append":
        table.append(df, seen)
    else:
        table.merge(one_per_key(df, table.keys), lambda old, new: upsert(old, new, table.keys), seen=seen)
    return WriteResult(int(seen.get["rows"]), 0, int((time.monotonic() - start) * 1000))


def merge_latest(
    df: DataFrame,
    table: VersionedTable,
    event_time: str = "event_time",
    created: str | None = "ingestion_time",
    stream: str | None = None,
    batch_id: int | None = None,
) -> None:
    """Merge rows into a table of the newest row per key: an older event replaces nothing."""

    def newest(old: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if old is None else old.unionByName(new, allowMissingColumns=True)
        return latest_per_entity(both, table.keys, event_time, created if created in both.columns else None)

    # Reduced before it is staged: a hot key is one row.
    table.merge(newest(None, df), newest, stream, batch_id)


def write_features_stream(
    stream: DataFrame,
    table: VersionedTable,
    checkpoint: str | None,
    trigger_seconds: int = 30,
    name: str = "features",
    event_time: str = "event_time",
    created: str | None = "ingestion_time",
) -> DataStreamWriter:
    """Merge every micro-batch into the table, newest row per key; buckets without a key of the batch stay as they are.  Exactly
    once: the number of the last merged batch is part of the table's manifest, and a replayed batch is skipped."""
    if not checkpoint:
        raise ValueError("a streaming write needs a checkpoint location")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if table.state()["streams"].get(name, -1) < batch_id:
            merge_latest(batch, table, event_time, created, name, batch_id)

    return (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{trigger_seconds} seconds")
    )


def idempotent_append(
    batch: DataFrame,
    history_path: str,
    keys: list[str],
    event_time: str = "event_time",
    created: str | None = "ingestion_time",
) -> int:
    """Append the rows whose (entity, event time) is new to a date-partitioned history.

    Of the dates in the batch only those files are read back that may hold one of its rows (``history_index``); in the usual
    case, a batch of new rows, hardly any.  Returns the number of appended rows.
    """
    spark = batch.sparkSession
    dated = batch.withColumn("event_date", F.to_date(event_time))
    fresh = latest_per_entity(dated, [*keys, event_time], event_time, created)
    candidates, before = history_index.candidate_files(dated, history_path, keys, event_time)
    if candidates:
        paths = [f"{history_path}/{f}" for f in candidates]
        known = spark.read.schema(dated.schema).option("basePath", history_path).parquet(*paths)
        fresh = fresh.join(known.select(*keys, event_time), [*keys, event_time], "left_anti")
    seen = Observation("appended")
    # Rebalancing splits large dates and joins small ones, so file sizes stay even.
    counted = _counted(fresh.hint("rebalance", "event_date"), seen)
    counted.write.mode("append").partitionBy("event_date").parquet(history_path)
    appended = int(seen.get["rows"])
    if appended:
        dates = sorted({f.split("=", 1)[1].split("/", 1)[0] for f in before} | {str(r[0]) for r in dated.select("event_date").distinct().collect() if r[0] is not None})
        added = sorted(set(history_index.files_of(spark, history_path, dates)) - set(before))
        history_index.add_files(spark, history_path, added, dated.schema, keys, event_time)
    return appended


def backfill_dates(
    compute: Callable[[DataFrame], DataFrame],
    source: DataFrame,
    history_path: str,
    start: Column,
    end: Column,
    source_time: str,
    event_time: str = "event_time",
    lookback: str | int = 0,
) -> None:
    """Recompute a view for whole days ``[start, end)`` and replace just those date partitions."""
    fresh = recomputed(compute, source, start, end, source_time, event_time, lookback)
    dated = fresh.withColumn("event_date", F.to_date(event_time))
    dated.hint("rebalance", "event_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("event_date").parquet(history_path)


def ingest(
    df: DataFrame, view: FeatureView, history_path: str, online: VersionedTable, reject_path: str
) -> WriteResult:
    """One write, two stores: append-only history and the latest row per entity.

    Rows without key or event time, or with vectors of a wrong length, go to ``reject_path`` with
    the reason.  A row already in the history is a no-op.
    """
    check_schema(df, view)
    start = time.monotonic()
    df = df.persist()
    try:
        good, bad = reject_rows(df, view)
        failed = Observation("rejected")
        _counted(bad, failed).write.mode("append").parquet(reject_path)
        n_bad = int(failed.get["rows"])
        n_new = idempotent_append(good, history_path, view.keys)
        reasons: list[str] = []
        if n_bad:
            # One row a reason, of which a view has a few for each of its columns.
            per_reason = bad.groupBy("reject_reason").count().orderBy(F.desc("count"), "reject_reason").collect()
            reasons = [f"{r['reject_reason']}: {r['count']}" for r in per_reason]
        if view.online:
            merge_latest(good, online)
    finally:
        df.unpersist()
    return WriteResult(n_new, n_bad, int((time.monotonic() - start) * 1000), reasons)


def dual_write(
    df: DataFrame,
    writers: dict[str, Callable[[DataFrame], WriteResult]],
    fail_on_either: bool = False,
) -> tuple[dict[str, WriteResult], list[str]]:
    """Run both writers on the same rows, computed once.  Both are attempted; errors are collected,
    or the first one is raised when ``fail_on_either``."""
    results: dict[str, WriteResult] = {}
    errors: list[str] = []
    first: Exception | None = None
    df = df.persist()
    try:
        with ThreadPoolExecutor(max_workers=len(writers)) as pool:
            running = {name: pool.submit(write, df) for name, write in writers.items()}
            for name, future in running.items():
                try:
                    results[name] = future.result()
                except Exception as exc:  # any store may fail in its own way
                    errors.append(f"{name}: {exc}")
                    first = first or exc
    finally:
        df.unpersist()
    if fail_on_either and first is not None:
        raise first
    return results, errors


VECTOR_KEYS = ["entity_type", "entity_id", "feature_name"]


def mirror_embeddings(vectors: DataFrame, table: VersionedTable) -> WriteResult:
    """Upsert ``entity_type, entity_id, feature_name, embedding, metadata`` with its document id."""
    rows = vectors.withColumn("doc_id", embedding_document_id(*VECTOR_KEYS))
    return write_features(rows, table, "merge")


def write_baseline(
    df: DataFrame, out_dir: str, statistics: DataFrame, constraints: DataFrame
) -> dict[str, str]:
    """The baseline data as parquet, and both one-row JSON documents as text."""
    paths = {
        "stats_path": f"{out_dir}/statistics.json",
        "constraints_path": f"{out_dir}/constraints.json",
        "baseline_path": f"{out_dir}/baseline.parquet",
    }
    statistics.coalesce(1).write.mode("overwrite").text(paths["stats_path"])
    constraints.coalesce(1).write.mode("overwrite").text(paths["constraints_path"])
    df.write.mode("overwrite").parquet(paths["baseline_path"])
    return paths


def append_drift_report(results: DataFrame, path: str, endpoint: str, run_ts: Column) -> None:
    """Append one run of ``detect_drift`` to the drift table, partitioned by run date."""
    rows = results.select(
        F.lit(endpoint).alias("endpoint_name"),
        run_ts.alias("monitoring_run_ts"),
        F.col("feature").alias("feature_name"),
        "psi",
        "ks_stat",
        "ks_pvalue",
        "drift_detected",
        "message",
        F.to_date(run_ts).alias("run_date"),
    )
    rows.write.mode("append").partitionBy("run_date").parquet(path)


def append_inference_log(rows: DataFrame, path: str) -> None:
    rows.withColumn("request_date", F.to_date("request_ts")).write.mode("append").partitionBy("request_date").parquet(path)
