"""The writer's loop: schema changes first, then one table's batch of files, merged, appended or reconciled.

A commit names the files it holds, so a batch that is tried again after a crash adds none of them twice.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import ddl
from tidemark.operators.resync import resync_deletes, resync_upserts
from tidemark.plans import control
from tidemark.plans.config import Settings
from tidemark.plans.files import exists
from tidemark.plans.store import Store
from tidemark.plans.table import Catalog


class Writer:
    def __init__(self, spark: SparkSession, store: Store, catalog: Catalog, settings: Settings | None = None):
        self.spark, self.store, self.catalog, self.settings = spark, store, catalog, settings or Settings()

    def apply_ddl(self) -> int:
        """Pending schema changes, oldest first; one that can't be applied is marked failed and holds its table's later files."""
        done = 0
        for e in self.store.rows("SELECT * FROM schema_change WHERE outcome = 'pending' ORDER BY number"):
            if not self.store.take_change(e["number"], time.time()):
                continue
            try:
                outcome = self._one_ddl(e)
                self.store.settle_change(e["number"], outcome, time.time())
                done += outcome == "applied"
            except Exception as x:
                self.store.settle_change(e["number"], "failed", time.time(), str(x))
        return done

    def _one_ddl(self, e: dict) -> str:
        tag, sql = e["tag"].upper(), e["statement"]
        if tag in ddl.SKIPPED_TAGS:
            return "skipped"
        if tag == "DROP TABLE":
            path = ddl.parse_drop(sql)
            return "applied" if path and self.catalog.drop(path[-2] if len(path) > 1 else "public", path[-1]) else "skipped"
        if tag == "COMMENT":
            kind, path, text = ddl.parse_comment(sql)
            if kind == "other":
                return "skipped"
            column = path.pop() if kind == "column" else None
            self.catalog.table(path[-2] if len(path) > 1 else "public", path[-1]).comment(text, column)
            return "applied"
        table = self.catalog.table(e["namespace"], e["name"])
        if not table.exists():
            return "skipped"
        table.alter(ddl.parse_alter(sql))
        return "applied"

    def key(self, namespace: str, name: str, catalog: list[str] = ()) -> list[str]:
        """The table's key: the settings', else the store's, else the source catalogue's."""
        known = self.store.table(namespace, name)
        return control.resolve_pk(self.settings.tables.get(f"{namespace}.{name}", []), known["key_columns"] if known else [], list(catalog))

    def step(self) -> int:
        """Take one batch; the number of files it completed."""
        self.apply_ddl()
        self.store.promote()
        ready = control.eligible(self.store.files(self.spark), self.store.tables(self.spark), self.store.changes(self.spark))
        rows = control.next_batch(ready, self.settings.files_per_batch).collect()
        if not rows:
            return 0
        at = (rows[0].table_schema, rows[0].table_name)
        table = self.store.table(*at)
        if table["reconcile"]:  # needs the whole export
            if table["stage"] not in ("backfill_complete", "streaming"):
                return 0
            rows = ready.where((F.col("table_schema") == at[0]) & (F.col("table_name") == at[1]) & (F.col("file_type") == "backfill")).collect()
        taken = set(self.store.lease([r.file_id for r in rows], time.time()))
        rows = [r for r in rows if r.file_id in taken]
        if not rows:
            return 0
        try:
            self._commit(at, rows, bool(table["reconcile"]))
        except Exception as x:
            self.store.release([r.file_id for r in rows], str(x)[:500], self.settings.max_retries)
            raise
        self.store.complete([r.file_id for r in rows], time.time())
        highs = [r.lsn_high for r in rows if r.lsn_high is not None]
        self.store.merged(*at, len(rows), max(highs) if highs else None)
        self.store.promote()
        return len(rows)

    def _read(self, rows: list) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(*[r.file_path for r in rows])

    def _commit(self, at: tuple[str, str], rows: list, reconcile: bool) -> None:
        table = self.catalog.table(*at)
        there = table.state()["merged"]
        fresh = [r for r in rows if r.file_id not in there]
        missing = [r.file_path for r in fresh if not exists(self.spark, r.file_path)]
        if missing:
            raise FileNotFoundError(f"staged files are missing: {missing[:3]}")
        held = {"numbers": [r.file_id for r in rows], "open_from": self.store.open_from(*at)}
        if fresh and rows[0].file_type == "cdc":
            table.merge(self._read(fresh), held=held)
        elif fresh and reconcile:
            old, new = table.read(), self._read(rows)
            table.apply(resync_upserts(old, new, table.pk), resync_deletes(old, new, table.pk), held=held)
        elif fresh:
            table.append(self._read(fresh), held=held)
        if reconcile:
            self.store.reconcile(*at, needed=False)
