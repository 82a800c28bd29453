"""Keyed tables that batches change in place, laid out by key bucket.

A key belongs to one of a fixed number of buckets. A version writes only its changed rows, as
a delta per touched bucket; a bucket is a base and the deltas after it, and the newest row of
a key counts. A bucket whose deltas outgrow its base is written again as one base, so a row is
rewritten a constant number of times however many batches come.

A commit is one small file that names the base and the deltas of every bucket. It appears by
a rename when all data is there: a reader of a commit keeps seeing the same rows, a batch that
failed half way leaves nothing behind, and a batch that comes again after its commit does
nothing. A table has one writer at a time. Parts of a key may be null for ``merge`` only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructType

from lapgraph.operators.skew import skew_join
from lapgraph.operators.upsert import latest_per_key, upsert

BUCKET, VERSION = "_bucket", "_version"


class BucketedTable:
    """The table below ``path`` with unique ``keys``.

    ``by`` names the keys that choose the bucket (all of them unless given), ``place`` may give
    the bucket as a column instead, such as a time step; its values can be any integers then.
    Deltas of a bucket are folded in when they hold over ``fold_rows`` rows and more than the
    base, unless all of them only added keys, or when there are over ``fold_deltas`` of them.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 32,
        by: Sequence[str] | None = None, place: Callable[[], Column] | None = None,
        fold_rows: int = 50_000, fold_deltas: int = 16,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.fold_rows, self.fold_deltas = fold_rows, fold_deltas
        hashed = F.pmod(F.xxhash64(*(by or self.keys)), F.lit(buckets)).cast("int")
        self._place = (place() if place else hashed).cast("int").alias(BUCKET)

    # Commits

    def _files(self):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/{version:020d}.json"

    def versions(self, before: int | None = None) -> list[int]:
        """Committed versions in order, only those lower than ``before`` if it is given."""
        files, path = self._files()
        folder = path(f"{self.path}/commits")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        found = sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())
        return [v for v in found if before is None or v < before]

    def commit(self, version: int | None = None) -> dict | None:
        """What a version (the newest unless given) consists of."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        files, path = self._files()
        java = self.spark.sparkContext._jvm.java.io
        reader = java.BufferedReader(java.InputStreamReader(files.open(path(self._commit_path(version))), "UTF-8"))
        try:
            return json.loads(reader.readLine())
        finally:
            reader.close()

    def _publish(self, commit: dict) -> None:
        files, path = self._files()
        final = path(self._commit_path(commit["version"]))
        draft = path(f"{self.path}/commits/_{commit['version']}.tmp")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(commit, sort_keys=True).encode()))
        out.close()
        if not files.rename(draft, final):
            raise RuntimeError(f"version {commit['version']} was committed by another writer")

    # Reading

    def _stored(self, commit: dict, kind: str, parts: list[tuple[int, int]]) -> DataFrame | None:
        """Rows of (version, bucket) folders with their version and bucket."""
        if not parts:
            return None
        schema = StructType.fromJson(commit["schema"]).add(VERSION, LongType()).add(BUCKET, IntegerType())
        paths = [f"{self.path}/{kind}/{VERSION}={v}/{BUCKET}={b}" for v, b in parts]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*paths)

    def _rows(self, commit: dict, buckets: set[int] | None = None) -> DataFrame:
        """One row per key; buckets without deltas, or with deltas that only add keys, are read as
        they are, without a shuffle."""
        own = {int(b): part for b, part in commit["buckets"].items() if buckets is None or int(b) in buckets}
        columns = StructType.fromJson(commit["schema"]).names
        whole = self._layers(commit, {b: part for b, part in own.items() if not _changed(part)})
        layers = self._layers(commit, {b: part for b, part in own.items() if _changed(part)})
        if layers is not None:
            layers = _newest(layers, self.keys)
        found = [df.select(*columns, BUCKET) for df in (whole, layers) if df is not None]
        if not found:
            return self.spark.createDataFrame([], StructType.fromJson(commit["schema"]).add(BUCKET, IntegerType()))
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def _layers(self, commit: dict, own: dict[int, dict]) -> DataFrame | None:
        """All rows of the bases and deltas of some buckets; None if there are none."""
        base = self._stored(commit, "base", [(part["base"], b) for b, part in own.items() if part["base"] is not None])
        deltas = self._stored(commit, "delta", [(v, b) for b, part in own.items() for v, _ in part["deltas"]])
        return base.unionByName(deltas) if base is not None and deltas is not None else base if deltas is None else deltas

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, the newest unless given; None before the first commit."""
        commit = self.commit(version)
        return None if commit is None else self._rows(commit).drop(BUCKET)

    def near(self, rows: DataFrame) -> DataFrame:
        """The stored rows of all buckets that ``rows`` (with the columns of the bucket) touch."""
        commit = self.commit()
        touched = {row[0] for row in rows.select(self._place).distinct().collect()}
        return self._rows(commit, touched).drop(BUCKET)

    def changes(self, after: int, up_to: int | None = None) -> DataFrame:
        """Newest rows of the keys written by the versions in (after, up_to], with ``_version``."""
        commits = [self.commit(v) for v in self.versions() if v > after and (up_to is None or v <= up_to)]
        commit = commits[-1] if commits else self.commit()
        if commit is None:
            raise ValueError("the table has no version")
        if commits and commits[0]["after"] is not None and commits[0]["after"] > after:
            raise ValueError(f"changes after version {after} are gone; they start after {commits[0]['after']}")
        rows = self._stored(commit, "delta", [(c["version"], b) for c in commits for b in c["touched"]])
        columns = StructType.fromJson(commit["schema"]).names
        if rows is None:
            return self._rows(commit, set()).withColumn(VERSION, F.lit(0).cast("long")).select(*columns, VERSION)
        return _newest(rows, self.keys).select(*columns, VERSION)

    def stream_changes(
        self, handler: Callable[[DataFrame, int], None], checkpoint: str, after: int,
        versions_per_trigger: int = 1, available_now: bool = True,
    ) -> StreamingQuery:
        """Run ``handler(changes, batch_id)`` over the versions after ``after`` as they appear.

        The stream follows the commit files, so it sees whole versions only, each of them once
        over all restarts from the checkpoint.
        """
        def step(batch: DataFrame, batch_id: int) -> None:
            named = batch.select(F.get_json_object("value", "$.version").cast("long").alias("v")).where(F.col("v") > after)
            first, last = named.agg(F.min("v"), F.max("v")).first()
            if last is not None:
                handler(self.changes(first - 1, last), batch_id)

        commits = self.spark.readStream.option("maxFilesPerTrigger", versions_per_trigger).text(f"{self.path}/commits")
        trigger = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
        return commits.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    # Writing

    def write(self, rows: DataFrame, version: int) -> None:
        """Load ``rows`` (one per key) as the first version."""
        self._apply(rows, lambda old, new: new, version)

    def upsert(self, rows: DataFrame, mode: str, version: int) -> None:
        """Apply one row per key, see ``operators.upsert.upsert``."""
        self._apply(rows, lambda old, new: upsert(old, new, self.keys, mode), version)

    def merge(self, rows: DataFrame, combine: Callable[[DataFrame], DataFrame], version: int) -> None:
        """Combine ``rows`` with the stored rows of their keys; ``combine`` makes one row per key
        of any rows, such as a sum of partial aggregates."""
        self._apply(rows, lambda old, new: combine(old.unionByName(new, allowMissingColumns=True)), version)

    def insert(self, rows: DataFrame, version: int) -> None:
        """Add the rows whose keys the table does not have; stored rows are only looked up, as they lie."""
        self._apply(rows, lambda old, new: new.join(old.select(*self.keys), self.keys, "left_anti"), version, adds=True)

    def upsert_edges(self, edges: DataFrame, nodes: DataFrame, order: Sequence[str], version: int) -> None:
        """Apply edge events whose two end nodes exist, the latest per key, see
        ``operators.upsert.upsert_edges``; keys are (rel, src, dst)."""
        latest = latest_per_key(edges, self.keys, order)
        for end in ("src", "dst"):
            latest = skew_join(latest, nodes.select(F.col("id").alias(end)), [end], "left_semi")
        self.upsert(latest, "merge", version)

    def _apply(
        self, rows: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], version: int, adds: bool = False
    ) -> None:
        """``adds`` says that ``combine`` gives new keys only and takes stored rows in any version."""
        known = self.versions()
        if known and version <= known[-1]:
            return
        last = self.commit(known[-1]) if known else None
        staged = rows.withColumn(BUCKET, self._place).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = {row[BUCKET]: row["n"] for row in staged.groupBy(BUCKET).agg(F.count("*").alias("n")).collect()}
            batch = staged.drop(BUCKET)
            stored = [b for b in touched if last and str(b) in last["buckets"]]
            if stored and adds:
                old = self._layers(last, {b: last["buckets"][str(b)] for b in stored})
            elif stored:
                old = self._rows(last, set(stored)).drop(BUCKET)
                old = self._of_keys(old, batch)
            else:
                old = self.spark.createDataFrame([], StructType.fromJson(last["schema"]) if last else batch.schema)
            kinds = {field.name: field.dataType for field in StructType.fromJson(last["schema"])} if last else {}
            changed = combine(old, batch)
            # A column keeps the type that it was first stored with.
            changed = changed.select([F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in changed.columns])
            self._write(changed, "delta", version)
        finally:
            staged.unpersist()
        commit = self._next(last, changed.schema, touched, version, adds)
        self._fold(commit)
        self._publish(commit)

    def _of_keys(self, old: DataFrame, batch: DataFrame) -> DataFrame:
        """The stored rows of the batch's keys; null parts of keys are equal."""
        wanted = batch.select([F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(self.keys)])
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(self.keys)]
        return old.join(wanted, reduce(Column.__and__, same), "left_semi")

    def _write(self, rows: DataFrame, kind: str, version: int) -> None:
        placed = rows.withColumn(BUCKET, self._place).hint("rebalance", F.col(BUCKET))
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{kind}/{VERSION}={version}")

    def _next(self, last: dict | None, schema: StructType, touched: dict[int, int], version: int, adds: bool) -> dict:
        names = {field.name for field in schema}
        earlier = [field for field in StructType.fromJson(last["schema"]) if field.name not in names] if last else []
        full = StructType([*schema, *earlier])
        buckets = json.loads(json.dumps(last["buckets"])) if last else {}
        files, path = self._files()
        # Update-only may have written nothing for a bucket.
        written = [b for b in touched if files.exists(path(f"{self.path}/delta/{VERSION}={version}/{BUCKET}={b}"))]
        for b in written:
            only_adds = adds or str(b) not in buckets
            part = buckets.setdefault(str(b), {"base": None, "rows": 0, "deltas": []})
            part["deltas"].append([version, touched[b]])
            if only_adds:
                part["adds"] = [*part.get("adds", []), version]
        return {
            "version": version, "after": last["version"] if last else None, "touched": sorted(written),
            "schema": full.jsonValue(), "buckets": buckets,
        }

    def _fold(self, commit: dict) -> None:
        """Write the buckets again whose deltas outgrew their base."""
        due = set()
        for b, part in commit["buckets"].items():
            rows = sum(n for _, n in part["deltas"]) if _changed(part) else 0
            if rows > max(self.fold_rows, part["rows"]) or len(part["deltas"]) > self.fold_deltas:
                due.add(int(b))
        if not due:
            return
        self._write(self._rows(commit, due).drop(BUCKET), "base", commit["version"])
        for b in due:
            part = commit["buckets"][str(b)]
            rows = part["rows"] + sum(n for _, n in part["deltas"])
            commit["buckets"][str(b)] = {"base": commit["version"], "rows": rows, "deltas": []}

    def vacuum(self, keep: int = 2, retain_seconds: float = 3600.0) -> list[int]:
        """Forget commits other than the last ``keep`` that are older than ``retain_seconds``, and
        the folders that no commit left names; give the versions that went.

        A reader may take ``retain_seconds``, and changes reach back to the oldest commit left.
        """
        files, path = self._files()
        now = self.spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
        known = self.versions()
        age = lambda v: now - files.getFileStatus(path(self._commit_path(v))).getModificationTime()
        gone = [v for v in known[: -max(keep, 1)] if age(v) >= 1000 * retain_seconds]
        left = [v for v in known if v not in gone]
        if not gone:
            return []
        for v in gone:
            files.delete(path(self._commit_path(v)), False)
        commits = [self.commit(v) for v in left]
        used = {
            "base": {part["base"] for c in commits for part in c["buckets"].values()},
            "delta": {v for c in commits for part in c["buckets"].values() for v, _ in part["deltas"]}
            | {c["version"] for c in commits},
        }
        for kind, versions in used.items():
            folder = path(f"{self.path}/{kind}")
            for status in files.listStatus(folder) if files.exists(folder) else []:
                version = int(status.getPath().getName().partition("=")[2])
                if version < left[0] and version not in versions:
                    files.delete(status.getPath(), True)
        return gone


def _changed(part: dict) -> bool:
    """Whether a bucket may hold several rows of a key: not where all deltas only added keys."""
    return any(v not in part.get("adds", []) for v, _ in part["deltas"])


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the newest version of each key."""
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), VERSION).alias("_row"))
    return newest.select(*keys, "_row.*")
