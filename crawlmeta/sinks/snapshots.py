"""Tables that are replaced at once: a log of versions over files that never change.

A run writes its files into a folder of its own, then a manifest (a small Parquet
table of the live partitions and the run that wrote each), then one log entry
that points to the manifest. The entry appears by a rename that fails if the
version exists already, so a version is there completely or not at all, and of
two runs that want the same version one starts its merge again on top of the
other's. Readers take the newest entry and read the files of its manifest only: they see
all of a run's rows or none, and go on reading what they started with.

  <path>/data/commit=<id>/<key>=<value>/part-*
  <path>/manifests/<id>-<try>/part-*      commit, keys: one row per live partition
  <path>/log/<version>.json               manifest, format, schema, commits

A run that dies before its log entry leaves files that nobody reads; ``vacuum``
removes them and those of old versions. The merge of manifests is a Spark join, and
the driver makes a handful of file-system calls for any number of partitions. The
rename is atomic on HDFS and local file systems; an object store needs a file
system with an atomic rename or a single writer.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmeta.session import dealt_listing

#: A manifest is broadcast into the scan up to so many partitions.
BROADCAST_PARTITIONS = 200_000
_TRIES = 50


class VersionTaken(RuntimeError):
    """Another run committed the version first."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], form: str = "parquet"):
        if not keys:
            raise ValueError("a snapshot table is partitioned by at least one column")
        self.spark, self.path, self.keys, self.form = spark, path.rstrip("/"), list(keys), form

    # --- the log

    def _hadoop(self, *parts: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, fs = self._hadoop("log")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def entry(self, version: int | None = None) -> dict | None:
        """The log entry of a version, of the newest by default; None for a table without any."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        path, fs = self._hadoop("log", f"{version:020d}.json")
        stream = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _publish(self, entry: dict) -> None:
        """The whole entry under its version's name, or ``VersionTaken``."""
        jvm = self.spark.sparkContext._jvm
        draft, fs = self._hadoop("log", f"_{uuid.uuid4().hex}")
        final, _ = self._hadoop("log", f"{entry['version']:020d}.json")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode("utf-8")))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), none)
        except Exception as ex:
            fs.delete(draft, False)
            if fs.exists(final):
                raise VersionTaken(str(entry["version"])) from ex
            raise

    # --- writing

    def _manifest_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in ["commit", *self.keys]])

    def manifest(self, entry: dict | None) -> DataFrame:
        if entry is None:
            return self.spark.createDataFrame([], self._manifest_schema())
        return self.spark.read.schema(self._manifest_schema()).parquet(f"{self.path}/manifests/{entry['manifest']}")

    def _same_keys(self, a: DataFrame, b: DataFrame):
        """Equal keys, null like a value; an equality of expressions, which scans can prune partitions by."""
        named = lambda df, k: F.coalesce(F.concat(F.lit("="), df[k].cast("string")), F.lit(""))
        on = F.lit(True)
        for k in self.keys:
            on = on & (named(a, k) == named(b, k))
        return on

    def stage(self, df: DataFrame, dealt: bool = False) -> str:
        """Write the rows where no reader looks; the id of the commit. Rows are
        rebalanced by the keys, unless they are ``dealt`` to tasks already."""
        commit = uuid.uuid4().hex
        ((df if dealt else df.hint("rebalance", *self.keys)).write.partitionBy(*self.keys).format(self.form)
         .save(f"{self.path}/data/commit={commit}"))
        return commit

    def commit(self, commit: str, schema: T.StructType, done: DataFrame | None = None) -> int:
        """Make a staged commit the newest version. ``done`` (the key columns)
        names the partitions that it replaces, also by nothing; without it, all."""
        keys = T.StructType([T.StructField(k, T.StringType()) for k in self.keys])
        rows = self.spark.read.schema(keys).option("basePath", f"{self.path}/data/commit={commit}")
        new = rows.format(self.form).load(f"{self.path}/data/commit={commit}").select(*self.keys).distinct().select(
            F.lit(commit).alias("commit"), *self.keys)
        for attempt in range(_TRIES):
            base = self.entry()
            live = new
            if base is not None and done is not None:
                old = self.manifest(base)
                named = done.select(*self.keys).distinct()
                old = old.join(named, self._same_keys(old, named), "left_anti")
                old = old.join(new.select(*self.keys).alias("n"), self._same_keys(old, new), "left_anti")
                live = old.unionByName(new)
            name = f"{commit}-{attempt}"
            live.write.parquet(f"{self.path}/manifests/{name}")
            entry = {"version": (base["version"] if base else 0) + 1, "manifest": name, "form": self.form,
                     "keys": self.keys, "schema": json.loads(schema.json()), "time": time.time()}
            counted = {r["commit"]: r["n"] for r in self.manifest(entry).groupBy("commit").agg(F.count(F.lit(1)).alias("n")).collect()}
            written = {**((base or {}).get("written", {})), commit: counted.get(commit, 0)}
            entry["commits"] = counted
            entry["written"] = {c: written[c] for c in counted}
            try:
                self._publish(entry)
                return entry["version"]
            except VersionTaken:
                continue
        raise VersionTaken(f"no free version after {_TRIES} tries")

    def replace(self, df: DataFrame, done: DataFrame | None = None, dealt: bool = False) -> int:
        return self.commit(self.stage(df, dealt), df.schema, done)

    # --- reading

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, fixed when this is called."""
        entry = self.entry(version)
        if entry is None:
            raise ValueError(f"{self.path} is no snapshot table or has no version")
        schema = T.StructType.fromJson(entry["schema"])
        if not entry["commits"]:
            return self.spark.createDataFrame([], schema)
        with_commit = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])

        def scan(commits: list[str]) -> DataFrame:
            with dealt_listing(self.spark):
                return (self.spark.read.schema(with_commit).format(entry["form"]).option("basePath", f"{self.path}/data")
                        .load([f"{self.path}/data/commit={c}" for c in commits]))

        names = [F.col(f"`{f.name}`") for f in schema.fields]
        cut = sorted(c for c, n in entry["commits"].items() if n != entry["written"][c])
        whole = sorted(set(entry["commits"]) - set(cut))
        parts = [scan(whole).select(*names)] if whole else []
        if cut:  # some partitions of these commits have been replaced
            live = self.manifest(entry).where(F.col("commit").isin(cut))
            if sum(entry["commits"][c] for c in cut) <= BROADCAST_PARTITIONS:
                live = F.broadcast(live)
            rows = scan(cut)
            on = (rows["commit"] == live["commit"]) & self._same_keys(rows, live)
            parts.append(rows.join(live, on, "left_semi").select(*names))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    # --- cleaning

    def vacuum(self, keep: int = 1, older_than_s: float = 7 * 86_400) -> int:
        """Delete log entries before the newest ``keep``, and manifests and
        commits that no kept entry names and that are older than ``older_than_s``
        (a run in progress has no entry yet). Returns the number of deleted folders."""
        if keep < 1:
            raise ValueError("keep must be >= 1")
        versions = self.versions()
        kept = [self.entry(v) for v in versions[-keep:]]
        for v in versions[:-keep]:
            path, fs = self._hadoop("log", f"{v:020d}.json")
            fs.delete(path, False)
        names = {f"commit={c}" for e in kept for c in e["commits"]} | {e["manifest"] for e in kept}
        gone, limit = 0, (time.time() - older_than_s) * 1000
        for part in ("data", "manifests"):
            folder, fs = self._hadoop(part)
            for s in fs.listStatus(folder) if fs.exists(folder) else []:
                if s.getPath().getName() not in names and s.getModificationTime() <= limit:
                    fs.delete(s.getPath(), True)
                    gone += 1
        return gone


def is_table(spark: SparkSession, path: str) -> bool:
    if any(c in path for c in ",*{"):
        return False
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/log")
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of a snapshot table, the newest version by default."""
    table = SnapshotTable(spark, path, ["_"])
    entry = table.entry(version)
    if entry is None:
        raise ValueError(f"{path} is no snapshot table or has no version")
    return SnapshotTable(spark, path, entry["keys"], entry["form"]).read(entry["version"])
