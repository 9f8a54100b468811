"""Versioned Parquet tables: atomic commits, equality deletes, time travel, comments, compaction.

A commit is one JSON file named by its version and created exclusively, so that a version is taken once; the loser
reads again and retries. Every ``EVERY``-th version also leaves the whole state beside the log, so that a reader
opens a bounded number of log files. Data and delete files carry their commit's number; a delete hides rows of
earlier commits only. A commit that names a (query, batch), or files, that are in the log already adds nothing.

All files of a layout are one scan, whatever the number of commits: a row's commit follows from its file's folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ddl import Change, conform, evolve, fit
from tidemark.operators.merge import META, SAME, dedup_latest, merge_on_read, patched_latest
from tidemark.plans import files

EVERY = 25


class Catalog:
    """A folder of namespaces of tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, namespace: str, name: str) -> "Table":
        return Table(self.spark, f"{self.root}/{namespace}/{name}")

    def create(self, namespace: str, name: str, schema: T.StructType, pk: list[str], comment: str | None = None) -> "Table":
        t = self.table(namespace, name)
        if not t.exists():
            t.commit("create", schema=schema, properties={"pk": pk, **({"comment": comment} if comment else {})})
        return t

    def drop(self, namespace: str, name: str) -> bool:
        path = f"{self.root}/{namespace}/{name}"
        return files.exists(self.spark, path) and files.remove(self.spark, path)


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.log = f"{path}/_commits"
        self._seen: dict | None = None

    def exists(self) -> bool:
        return bool(self.versions())

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in files.names(self.spark, self.log) if n.endswith(".json")]

    def state(self, version: int | None = None) -> dict:
        """Schema, properties and live files at a version (default: the last): the newest state written or read by then, and the commits since."""
        names = files.names(self.spark, self.log)
        wanted = [int(n[:-5]) for n in names if n.endswith(".json") and (version is None or int(n[:-5]) <= version)]
        kept = [int(n[:-6]) for n in names if n.endswith(".state") and (version is None or int(n[:-6]) <= version)]
        now = {"schema": None, "properties": {}, "files": [], "version": 0, "batches": {}, "merged": []}
        if self._seen and (version is None or self._seen["version"] <= version) and self._seen["version"] in wanted:
            now = self._seen
        if kept and kept[-1] > now["version"]:
            now = json.loads(files.read(self.spark, f"{self.log}/{kept[-1]:020d}.state"))
        for v in wanted:
            if v > now["version"]:
                now = self._after(now, json.loads(files.read(self.spark, f"{self.log}/{v:020d}.json")))
        if version is None:
            self._seen = now
        return now

    @staticmethod
    def _after(now: dict, entry: dict) -> dict:
        gone = set(entry.get("removed") or [])
        properties = {k: v for k, v in {**now["properties"], **(entry.get("properties") or {})}.items() if v is not None}
        batches, merged = dict(now["batches"]), now["merged"]
        if source := entry.get("source"):
            batches[source["query"]] = max(source["batch"], batches.get(source["query"], -1))
        if held := entry.get("held"):
            merged = sorted({n for n in [*merged, *held["numbers"]] if n >= held["open_from"]})
        return {"schema": entry.get("schema") or now["schema"], "properties": properties, "files": [f for f in now["files"] if f["path"] not in gone] + (entry.get("added") or []), "version": entry["version"], "batches": batches, "merged": merged}

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.state()["schema"]))

    @property
    def pk(self) -> list[str]:
        return self.state()["properties"]["pk"]

    def commit(self, operation: str, added: Callable[[int], list[dict]] | list[dict] = (), removed: list[str] = (), schema: T.StructType | None = None, properties: dict | None = None, source: dict | None = None, base: int | None = None, held: dict | None = None) -> int | None:
        """The new version; None where the source's batch is in the log. ``base``: fail if another commit came after it."""
        while True:
            now = self.state()
            if source and now["batches"].get(source["query"], -1) >= source["batch"]:
                return None
            if base is not None and now["version"] != base:
                raise RuntimeError("the table has changed meanwhile")
            if held and set(held["numbers"]) & set(now["merged"]):
                raise RuntimeError("another writer has merged some of these files meanwhile")
            version = now["version"] + 1
            live = added(version) if callable(added) else [dict(f, seq=f.get("seq", version)) for f in added]
            entry = {"version": version, "operation": operation, "added": live, "removed": list(removed), "schema": schema.json() if schema else None, "properties": properties, "source": source, "held": held}
            if files.create(self.spark, f"{self.log}/{version:020d}.json", json.dumps(entry)):
                if version % EVERY == 0:
                    files.create(self.spark, f"{self.log}/{version:020d}.state", json.dumps(self._after(now, entry)))
                return version

    def _write(self, df: DataFrame, kind: str) -> list[dict]:
        folder, counted = f"{self.path}/data/{kind}-{uuid.uuid4().hex}", Observation()
        df.observe(counted, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd").parquet(folder)
        if not counted.get["n"]:
            files.remove(self.spark, folder)
            return []
        return [{"path": folder, "kind": kind, "rows": counted.get["n"], "schema": df.schema.json()}]

    def append(self, df: DataFrame, source: dict | None = None, held: dict | None = None) -> int | None:
        """Backfill and initial loads."""
        live = self._write(fit(df, self.schema), "data")
        return self.commit("append", live, source=source, held=held) if live or source or held else None

    def merge(self, changes: DataFrame, source: dict | None = None, held: dict | None = None) -> int | None:
        """Changes with _op, _ts, _seq: upserts and delete keys in one commit; nothing where there are none.

        The latest changes are computed and written once, parted by whether their row is gone: the one part is the
        upserts, and the keys of both are the deletes. Columns that ``_same`` names as unchanged keep their value:
        from an earlier change of the batch, else from the table's row.
        """
        pk, schema = self.pk, self.schema
        if not pk:
            raise ValueError("a merge needs a primary key")
        if source and self.state()["batches"].get(source["query"], -1) >= source["batch"]:
            return None
        if SAME in changes.columns:
            latest = patched_latest(changes, pk, self.read())
        else:
            latest = dedup_latest(changes, pk)
        gone = (~F.col("_op").isin("I", "U")).alias("_gone")
        rows = fit(latest.drop(*[c for c in META if c != "_op"], SAME), schema, ["_op"]).withColumn("_gone", gone).drop("_op")
        folder, counted = f"{self.path}/data/merge-{uuid.uuid4().hex}", Observation()
        rows.observe(counted, F.count(F.lit(1)).alias("n"), F.count(F.when(~F.col("_gone"), 1)).alias("kept")).write.option("compression", "zstd").partitionBy("_gone").parquet(folder)
        n, kept = counted.get["n"], counted.get["kept"]
        keys = T.StructType([f for f in schema.fields if f.name in pk])
        live = []
        if n:
            live.append({"path": folder, "kind": "delete", "rows": n, "schema": keys.json()})
        if kept:
            live.append({"path": f"{folder}/_gone=false", "kind": "data", "rows": kept, "schema": schema.json()})
        if not n:
            files.remove(self.spark, folder)
        return self.commit("merge", live, source=source, held=held) if live or source or held else None

    def apply(self, ups: DataFrame, dels: DataFrame, source: dict | None = None, held: dict | None = None) -> int | None:
        """A resync's difference; upserts hide the versions before them. An empty difference makes no commit."""
        written = self._write(fit(ups, self.schema), "data")
        own = self.spark.read.schema(ups.select(*self.pk).schema).parquet(written[0]["path"]) if written else ups.select(*self.pk).limit(0)
        live = written + self._write(dels.select(*self.pk).unionByName(own).distinct(), "delete")
        return self.commit("resync", live, source=source, held=held) if live or source or held else None

    def _load(self, live: list[dict], schema: T.StructType) -> DataFrame:
        """One scan a layout, aligned by name; each row carries its commit's number."""
        layouts: dict[str, list[dict]] = {}
        for f in live:
            layouts.setdefault(f["schema"], []).append(f)
        out = self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_commit", T.LongType())]))
        for text, same in layouts.items():
            folder = F.regexp_extract(F.col("_metadata.file_path"), r"/data/([^/]+)/", 1)
            # plain paths: the parts of a merge are told apart by path, not by a partition column
            rows = self.spark.read.schema(T.StructType.fromJson(json.loads(text))).option("recursiveFileLookup", "true").parquet(*[f["path"] for f in same])
            rows = conform(rows.withColumn("_folder", folder), schema, ["_folder"])
            commits = self.spark.createDataFrame([(_folder(f["path"]), f["seq"]) for f in same], "_folder string, _commit long")
            out = out.unionByName(rows.join(commits, "_folder").drop("_folder"))
        return out

    def read(self, version: int | None = None) -> DataFrame:
        """Live rows at a version."""
        now = self.state(version)
        schema = T.StructType.fromJson(json.loads(now["schema"]))
        dels = [f for f in now["files"] if f["kind"] == "delete"]
        rows = self._load([f for f in now["files"] if f["kind"] == "data"], schema)
        if dels:
            pk = now["properties"]["pk"]
            rows = merge_on_read(rows, self._load(dels, T.StructType([f for f in schema.fields if f.name in pk])), pk)
        return rows.drop("_commit")

    def compact(self) -> int:
        """Live rows rewritten, all earlier files removed, in one commit."""
        now = self.state()
        return self.commit("compact", self._write(self.read(), "data"), [f["path"] for f in now["files"]], base=now["version"])

    def compact_if_due(self, most: int) -> int | None:
        """A compaction once the table has more than ``most`` delete files."""
        return self.compact() if sum(f["kind"] == "delete" for f in self.state()["files"]) > most else None

    def alter(self, changes: list[Change]) -> int:
        if any(c.kind == "unparsed" for c in changes):
            raise ValueError("a change that can't be applied")
        if lost := {c.column for c in changes if c.kind == "drop"} & set(self.pk):
            raise ValueError(f"key columns can't be dropped: {sorted(lost)}")
        return self.commit("alter", schema=evolve(self.schema, changes))

    def comment(self, text: str | None, column: str | None = None) -> int:
        if column is None:
            return self.commit("comment", properties={"comment": text})
        fields = [T.StructField(f.name, f.dataType, f.nullable, {**{k: v for k, v in f.metadata.items() if k != "comment"}, **({"comment": text} if text else {})}) if f.name == column else f for f in self.schema.fields]
        return self.commit("comment", schema=T.StructType(fields))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Folders that the last ``keep`` versions do not use go."""
        used = {_folder(f["path"]) for v in self.versions()[-keep:] for f in self.state(v)["files"]}
        gone = [f"{self.path}/data/{n}" for n in files.names(self.spark, f"{self.path}/data") if n not in used]
        for p in gone:
            files.remove(self.spark, p)
        return gone


def _folder(path: str) -> str:
    return path.split("/data/")[-1].split("/")[0]
