"""The control plane's transactional store: an append-only log of staged files, and leases on them.

A staged file is described once and never changed. What happens to it is its lease: who may work on it, since when,
how often it was tried, and how it ended. Numbers of staged files rise, so the set of a table's merged files can be
kept short: everything below the least number that is not settled is done.
"""

from __future__ import annotations

import json
import sqlite3

from pyspark.sql import DataFrame, SparkSession

_LAYOUT = """
CREATE TABLE IF NOT EXISTS source (name TEXT PRIMARY KEY, publication TEXT, snapshot TEXT, starts_at INTEGER, flushed_to INTEGER DEFAULT 0, applied_to INTEGER DEFAULT 0);
CREATE TABLE IF NOT EXISTS lake (namespace TEXT, name TEXT, key_columns TEXT DEFAULT '[]', stage TEXT DEFAULT 'pending', reconcile INTEGER DEFAULT 0, ranges INTEGER DEFAULT 0, merged_files INTEGER DEFAULT 0, merged_to INTEGER DEFAULT 0, PRIMARY KEY (namespace, name));
CREATE TABLE IF NOT EXISTS range_done (namespace TEXT, name TEXT, number INTEGER, PRIMARY KEY (namespace, name, number));
CREATE TABLE IF NOT EXISTS staged (number INTEGER PRIMARY KEY AUTOINCREMENT, namespace TEXT, name TEXT, kind TEXT, path TEXT, range_number INTEGER, low INTEGER, high INTEGER, n_rows INTEGER, at REAL);
CREATE TABLE IF NOT EXISTS lease (number INTEGER PRIMARY KEY REFERENCES staged, outcome TEXT DEFAULT 'pending', since REAL, ended REAL, tries INTEGER DEFAULT 0, note TEXT);
CREATE TABLE IF NOT EXISTS schema_change (number INTEGER PRIMARY KEY AUTOINCREMENT, namespace TEXT, name TEXT, tag TEXT, statement TEXT, position INTEGER, txn INTEGER, outcome TEXT DEFAULT 'pending', since REAL, ended REAL, note TEXT);
"""
_OPEN = "('pending', 'processing')"


class Store:
    """Every change is one transaction of a local database file; a lease is taken by compare and set."""

    def __init__(self, path: str):
        self.db = sqlite3.connect(path, isolation_level=None, timeout=30)
        self.db.row_factory = sqlite3.Row
        self.db.executescript(_LAYOUT)

    def _run(self, *steps: tuple[str, tuple]) -> int:
        """The steps in one transaction; rows that the last of them changed."""
        self.db.execute("BEGIN IMMEDIATE")
        try:
            for sql, args in steps:
                done = self.db.execute(sql, args)
            self.db.execute("COMMIT")
        except BaseException:
            self.db.execute("ROLLBACK")
            raise
        return done.rowcount

    def rows(self, sql: str, args: tuple = ()) -> list[dict]:
        return [dict(r) for r in self.db.execute(sql, args)]

    # sources

    def put_source(self, name: str, publication: str, starts_at: int, snapshot: str | None = None) -> None:
        self._run(("INSERT OR REPLACE INTO source (name, publication, snapshot, starts_at, flushed_to, applied_to) SELECT ?, ?, ?, ?, coalesce(max(flushed_to), 0), coalesce(max(applied_to), 0) FROM source WHERE name = ?", (name, publication, snapshot, starts_at, name)))

    def applied(self, name: str, position: int) -> None:
        self._run(("UPDATE source SET applied_to = max(applied_to, ?) WHERE name = ?", (position, name)))

    def resume(self, name: str) -> int:
        """Where to read on: what is flushed, else where the source's snapshot stands."""
        found = self.rows("SELECT CASE WHEN flushed_to > 0 THEN flushed_to ELSE coalesce(starts_at, 0) END AS at FROM source WHERE name = ?", (name,))
        return found[0]["at"] if found else 0

    def lost(self) -> None:
        """The log is lost: streaming tables are exported again and reconciled, unfinished files are dropped."""
        self._run(
            ("UPDATE lake SET reconcile = 1 WHERE stage = 'streaming'", ()),
            ("UPDATE lake SET stage = 'pending'", ()),
            ("DELETE FROM range_done", ()),
            (f"DELETE FROM staged WHERE number IN (SELECT number FROM lease WHERE outcome IN {_OPEN})", ()),
            (f"DELETE FROM lease WHERE outcome IN {_OPEN}", ()),
            ("UPDATE source SET flushed_to = 0, applied_to = 0", ()),
        )

    # tables

    def put_table(self, namespace: str, name: str, key: list[str], ranges: int | None = None) -> None:
        """Known values stay where new ones are absent or empty."""
        self._run(
            ("INSERT OR IGNORE INTO lake (namespace, name) VALUES (?, ?)", (namespace, name)),
            ("UPDATE lake SET key_columns = CASE WHEN ? THEN ? ELSE key_columns END, ranges = coalesce(?, ranges) WHERE namespace = ? AND name = ?", (bool(key), json.dumps(key), ranges, namespace, name)),
        )

    def table(self, namespace: str, name: str) -> dict | None:
        found = self.rows("SELECT * FROM lake WHERE namespace = ? AND name = ?", (namespace, name))
        return {**found[0], "key_columns": json.loads(found[0]["key_columns"])} if found else None

    def set_stage(self, namespace: str, name: str, stage: str) -> None:
        self._run(("UPDATE lake SET stage = ? WHERE namespace = ? AND name = ?", (stage, namespace, name)))

    def range_done(self, namespace: str, name: str, number: int) -> None:
        """A range counts once, however often it is reported; the last one completes the backfill."""
        at = (namespace, name)
        self._run(
            ("INSERT OR IGNORE INTO range_done VALUES (?, ?, ?)", (*at, number)),
            ("UPDATE lake SET stage = 'backfill_complete' WHERE namespace = ? AND name = ? AND stage = 'backfilling' AND (SELECT count(*) FROM range_done d WHERE d.namespace = lake.namespace AND d.name = lake.name) >= ranges", at),
        )

    def ranges_done(self, namespace: str, name: str) -> set[int]:
        return {r["number"] for r in self.rows("SELECT number FROM range_done WHERE namespace = ? AND name = ?", (namespace, name))}

    def promote(self) -> int:
        return self._run(("UPDATE lake SET stage = 'streaming' WHERE stage = 'backfill_complete' AND NOT EXISTS (SELECT 1 FROM staged s JOIN lease l USING (number) WHERE s.namespace = lake.namespace AND s.name = lake.name AND s.kind = 'backfill' AND l.outcome NOT IN ('completed', 'deleted'))", ()))

    def reconcile(self, namespace: str, name: str, needed: bool = True) -> None:
        """Asked for: the table is exported anew. Done: the flag goes."""
        self._run(("UPDATE lake SET reconcile = ?, stage = iif(?, 'pending', stage) WHERE namespace = ? AND name = ?", (needed, needed, namespace, name)))

    # files

    def stage(self, namespace: str, name: str, kind: str, path: str, rows: int, now: float, span: tuple[int, int] | None = None, range_number: int | None = None, source: str | None = None) -> int:
        """With a source, its flushed position moves in the same transaction, and never back."""
        low, high = span or (None, None)
        steps = [("INSERT INTO staged (namespace, name, kind, path, range_number, low, high, n_rows, at) VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?)", (namespace, name, kind, path, range_number, low, high, rows, now))]
        if source:
            steps.append(("UPDATE source SET flushed_to = max(flushed_to, ?) WHERE name = ?", (high, source)))
        steps.append(("INSERT INTO lease (number) SELECT max(number) FROM staged", ()))
        self._run(*steps)
        return self.rows("SELECT max(number) AS n FROM staged")[0]["n"]

    def lease(self, numbers: list[int], now: float) -> list[int]:
        """Those of the files that nobody had until now."""
        return [n for n in numbers if self._run(("UPDATE lease SET outcome = 'processing', since = ? WHERE number = ? AND outcome = 'pending'", (now, n))) == 1]

    def complete(self, numbers: list[int], now: float) -> None:
        self._run(*[("UPDATE lease SET outcome = 'completed', ended = ? WHERE number = ?", (now, n)) for n in numbers])

    def release(self, numbers: list[int], note: str, most: int = 3) -> None:
        """Files that were tried together fare together: failed for good once one of them was tried too often."""
        marks = ",".join("?" * len(numbers))
        used = self.rows(f"SELECT max(tries) AS n FROM lease WHERE number IN ({marks})", tuple(numbers))[0]["n"] or 0
        self._run((f"UPDATE lease SET outcome = ?, note = ?, tries = tries + 1 WHERE number IN ({marks})", ("failed" if used >= most else "pending", note, *numbers)))

    def reclaim(self, now: float, minutes: int = 30, change_minutes: int = 10) -> int:
        """Leases and schema changes whose holder seems to be gone are pending again."""
        n = self._run(("UPDATE lease SET outcome = 'pending', tries = tries + 1 WHERE outcome = 'processing' AND since < ?", (now - 60 * minutes,)))
        return n + self._run(("UPDATE schema_change SET outcome = 'pending' WHERE outcome = 'applying' AND since < ?", (now - 60 * change_minutes,)))

    def open_from(self, namespace: str, name: str) -> int:
        """The least number of the table's files that is not settled (beyond all, where all are)."""
        return self.rows("SELECT coalesce(min(s.number), (SELECT coalesce(max(number), 0) + 1 FROM staged)) AS n FROM staged s JOIN lease l USING (number) WHERE s.namespace = ? AND s.name = ? AND l.outcome NOT IN ('completed', 'deleted')", (namespace, name))[0]["n"]

    def merged(self, namespace: str, name: str, files: int, position: int | None) -> None:
        self._run(("UPDATE lake SET merged_files = merged_files + ?, merged_to = max(merged_to, coalesce(?, 0)) WHERE namespace = ? AND name = ?", (files, position, namespace, name)))

    def expired(self, now: float, hours: int = 24) -> list[str]:
        """Paths of files that are done for so long; from now on they count as deleted."""
        due = self.rows("SELECT number, path FROM staged JOIN lease USING (number) WHERE outcome = 'completed' AND ended < ?", (now - 3600 * hours,))
        if due:
            self._run(*[("UPDATE lease SET outcome = 'deleted' WHERE number = ?", (r["number"],)) for r in due])
        return [r["path"] for r in due]

    # schema changes

    def add_change(self, tag: str, namespace: str | None, name: str | None, statement: str, position: int | None, txn: int = 0) -> None:
        self._run(("INSERT INTO schema_change (tag, namespace, name, statement, position, txn) VALUES (?, ?, ?, ?, ?, ?)", (tag, namespace, name, statement, position, txn)))

    def take_change(self, number: int, now: float) -> bool:
        return self._run(("UPDATE schema_change SET outcome = 'applying', since = ? WHERE number = ? AND outcome = 'pending'", (now, number))) == 1

    def settle_change(self, number: int, outcome: str, now: float, note: str | None = None) -> None:
        """Also how someone skips a failed change, or has it tried again ('pending')."""
        self._run(("UPDATE schema_change SET outcome = ?, ended = ?, note = ? WHERE number = ?", (outcome, now, note, number)))

    # as DataFrames

    def files(self, spark: SparkSession) -> DataFrame:
        rows = self.rows(f"SELECT * FROM staged JOIN lease USING (number) WHERE outcome IN {_OPEN} OR outcome = 'failed'")
        schema = "file_id long, table_schema string, table_name string, file_type string, file_path string, lsn_low long, lsn_high long, partition_id long, status string, created_at double, retry_count long"
        return spark.createDataFrame([[r[c] for c in ("number", "namespace", "name", "kind", "path", "low", "high", "range_number", "outcome", "at", "tries")] for r in rows], schema)

    def tables(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([[r["namespace"], r["name"], r["stage"], r["reconcile"]] for r in self.rows("SELECT * FROM lake")], "table_schema string, table_name string, phase string, needs_resync long")

    def changes(self, spark: SparkSession) -> DataFrame:
        rows = self.rows("SELECT * FROM schema_change WHERE outcome NOT IN ('applied', 'skipped')")
        return spark.createDataFrame([[r["number"], r["namespace"], r["name"], r["position"], r["outcome"]] for r in rows], "event_id long, target_schema string, target_table string, ddl_lsn long, status string")

    def tracked(self, spark: SparkSession) -> DataFrame:
        """Paths of all files that are not deleted."""
        return spark.createDataFrame([[r["path"]] for r in self.rows("SELECT path FROM staged JOIN lease USING (number) WHERE outcome <> 'deleted'")], "path string")
