"""The query catalogue over the driver's tables, each with its SQL for DuckDB.

``events`` acts as a changelog of users: signup inserts, error deletes, all else updates; 50 events are a
transaction, every tenth of which (number 3 of 10) is aborted. ``orders`` gives an old and a new snapshot.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import ddl, lsn, types
from tidemark.operators import changelog, merge, resync
from tidemark.plans import control
from tidemark.plans.staged import Staged
from tidemark.plans.table import Catalog
from tidemark.sources import frames, scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_BASE = 16_777_216


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _events(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    ts = e.schema["ts"].dataType.simpleString()
    micros = F.unix_micros(F.col("ts").cast("timestamp")) if ts != "timestamp" else F.unix_micros("ts")
    return e.select("user_id", "event_type", "value", "props", op.alias("_op"), micros.alias("_ts"), F.col("event_id").alias("_seq"))


_L = "(SELECT user_id, event_type, value, props, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS _op, epoch_us(ts) AS _ts, event_id AS _seq FROM events)"
_LATEST = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _ts DESC, _seq DESC) AS rn FROM {_L}) WHERE rn = 1)"


def _txn(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    xid = F.expr("_seq div 50")
    return e.withColumn("xid", xid).withColumn("msg_idx", F.col("_seq"))


def _commits(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("xid") % 10 != 3).groupBy("xid").agg(F.max("_ts").alias("commit_ts")).withColumn("commit_lsn", F.lit(_BASE) + (F.col("xid") + 1) * 4096)


_X = f"(SELECT *, _seq // 50 AS xid, {_BASE} + (_seq // 50 + 1) * 4096 AS commit_lsn FROM {_L})"


@query(f"SELECT user_id, event_type, value, props, _op, _ts, _seq FROM {_LATEST}")
def cdc_dedup_latest(spark, d):
    return merge.dedup_latest(_events(spark, d), ["user_id"])


@query(SQL["cdc_dedup_latest"])
def cdc_dedup_max_by(spark, d):
    return merge.dedup_max_by(_events(spark, d), ["user_id"])


@query(f"SELECT user_id, event_type, value, props FROM {_LATEST} WHERE _op IN ('I', 'U')")
def cdc_upserts(spark, d):
    return merge.split(_events(spark, d), ["user_id"])[0]


@query("SELECT DISTINCT user_id FROM events")
def cdc_delete_keys(spark, d):
    return merge.split(_events(spark, d), ["user_id"])[1]


@query(f"SELECT _op, count(*) AS n FROM {_L} GROUP BY _op")
def cdc_op_counts(spark, d):
    return merge.op_counts(_events(spark, d))


_LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY " + ", ".join(f"{c} DESC" for c in _LINE_ORDER) + ") AS rn FROM lineitem) WHERE rn = 1")
def cdc_dedup_composite_pk(spark, d):
    rows = merge.dedup_latest(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _base(spark, d):
    return _t(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.lit("base").alias("event_type"), F.col("c_acctbal").alias("value"))


_STATE = f"""
SELECT user_id, event_type, value FROM {_LATEST} WHERE _op IN ('I', 'U')
UNION ALL SELECT c_custkey, 'base', c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
"""


@query(_STATE)
def mor_current_state(spark, d):
    ups, dels = merge.split(_events(spark, d), ["user_id"])
    data = _base(spark, d).withColumn("_commit", F.lit(1)).unionByName(ups.select("user_id", "event_type", "value").withColumn("_commit", F.lit(2)))
    return merge.merge_on_read(data, dels.withColumn("_commit", F.lit(2)), ["user_id"]).drop("_commit")


@query(_STATE)
def mor_multi_commit_state(spark, d):
    """Five commits by ranges of the log give the state of one."""
    batch = F.least(F.expr("_seq div 2000"), F.lit(4)).cast("int")
    e = _events(spark, d).withColumn("_commit", batch + 2)
    last = merge.dedup_latest(e, ["user_id", "_commit"])
    ups = last.where(F.col("_op").isin("I", "U")).select("user_id", "event_type", "value", "_commit")
    data = _base(spark, d).withColumn("_commit", F.lit(1)).unionByName(ups)
    return merge.merge_on_read(data, last.select("user_id", "_commit"), ["user_id"]).drop("_commit")


@query(f"SELECT user_id, event_type, value FROM {_L} e WHERE _op = 'I' AND _seq > coalesce((SELECT max(_seq) FROM {_L} x WHERE x._op = 'D' AND x.user_id = e.user_id), -1)")
def mor_reinsert_after_delete(spark, d):
    """Every signup is a row of its own commit; an error hides earlier commits only."""
    e = _events(spark, d)
    data = e.where("_op = 'I'").select("user_id", "event_type", "value", F.col("_seq").alias("_commit"))
    return merge.merge_on_read(data, e.where("_op = 'D'").select("user_id", F.col("_seq").alias("_commit")), ["user_id"]).drop("_commit")


def _snapshots(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    old = o.where("o_orderkey % 10 <> 0")
    new = o.where("o_orderkey % 7 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    return old, new


_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
_OLD = f"(SELECT {_COLS} FROM orders WHERE o_orderkey % 10 <> 0)"
_NEW = f"(SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 7 <> 0)"


@query(f"SELECT {_COLS} FROM {_NEW} EXCEPT SELECT {_COLS} FROM {_OLD}")
def resync_upserts(spark, d):
    old, new = _snapshots(spark, d)
    return resync.resync_upserts(old, new, ["o_orderkey"])


@query(f"SELECT o_orderkey FROM {_OLD} EXCEPT SELECT o_orderkey FROM {_NEW}")
def resync_deletes(spark, d):
    old, new = _snapshots(spark, d)
    return resync.resync_deletes(old, new, ["o_orderkey"])


@query(f"SELECT *, o_totalprice * 2 AS extra FROM {_NEW}")
def resync_schema_mismatch_upserts(spark, d):
    old, new = _snapshots(spark, d)
    return resync.resync_upserts(old, new.withColumn("extra", F.col("o_totalprice") * 2), ["o_orderkey"])


@query(f"SELECT * FROM {_NEW}")
def resync_applied_state(spark, d):
    old, new = _snapshots(spark, d)
    return resync.apply_diff(old, resync.resync_upserts(old, new, ["o_orderkey"]), resync.resync_deletes(old, new, ["o_orderkey"]), ["o_orderkey"])


@query(f"SELECT * FROM {_OLD} o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_returnflag = 'R')")
def resync_old_with_deletes(spark, d):
    old, _ = _snapshots(spark, d)
    return resync.load_with_deletes(old, _t(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


def _warehouse(spark: SparkSession) -> Catalog:
    """A new folder in the shared checkpoint folder, whatever its file system; a local one only where there is none and the master is local."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("a cluster needs spark.checkpoint.dir, a folder that its machines share")
    return Catalog(spark, f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="tidemark-"))


def _order_table(spark, d):
    old, new = _snapshots(spark, d)
    t = _warehouse(spark).create("public", "orders", old.schema, ["o_orderkey"])
    t.append(old)
    return t, old, new


@query(f"SELECT * FROM {_OLD}")
def backfill_append_state(spark, d):
    return _order_table(spark, d)[0].read()


@query(f"SELECT * FROM {_NEW}")
def table_resync_commit(spark, d):
    t, old, new = _order_table(spark, d)
    t.apply(resync.resync_upserts(old, new, ["o_orderkey"]), resync.resync_deletes(old, new, ["o_orderkey"]))
    return t.read()


@query(f"SELECT * FROM {_NEW}")
def compaction_equivalence(spark, d):
    t, old, new = _order_table(spark, d)
    t.apply(resync.resync_upserts(old, new, ["o_orderkey"]), resync.resync_deletes(old, new, ["o_orderkey"]))
    t.compact()
    return t.read()


@query(f"SELECT * FROM {_OLD}")
def time_travel_state(spark, d):
    t, old, new = _order_table(spark, d)
    at = t.state()["version"]
    t.apply(resync.resync_upserts(old, new, ["o_orderkey"]), resync.resync_deletes(old, new, ["o_orderkey"]))
    return t.read(at)


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice::VARCHAR::DOUBLE AS o_totalprice, NULL::VARCHAR AS note FROM {_OLD}")
def schema_evolution_read(spark, d):
    t, *_ = _order_table(spark, d)
    t.alter(ddl.parse_alter("ALTER TABLE public.orders ADD COLUMN note text, DROP COLUMN o_orderpriority, ALTER COLUMN o_totalprice TYPE double precision"))
    return t.read()


@query(f"SELECT user_id, event_type, value, props FROM {_LATEST} WHERE _op IN ('I', 'U')")
def stream_merge_state(spark, d):
    from tidemark.streaming.merge_stream import changes, merge_into

    catalog = _warehouse(spark)
    staged, e = f"{catalog.root}/staged", _events(spark, d)
    e.repartitionByRange(4, "_seq").write.parquet(staged)
    t = catalog.create("public", "users", e.drop(*merge.META).schema, ["user_id"])
    q = merge_into(changes(spark, staged, e.schema, 100), t, f"{catalog.root}/checkpoint", "users")
    q.awaitTermination()
    return t.read()


@query("SELECT i AS part, i * 7 AS start_page, least(i * 7 + 7, 100) AS end_page FROM range(0, 15) r(i)")
def scan_partition_plan(spark, d):
    return scan.plan_frame(spark, 100, 7)


@query("SELECT least(o_orderkey // 500, (SELECT (max(o_orderkey) * 9 // 10 + 499) // 500 - 1 FROM orders)) AS part, count(*) AS n FROM orders GROUP BY 1")
def scan_partition_assignment(spark, d):
    """Keys stand for pages, 10 rows each; the plan knows nine tenths of them, so the last range is open-ended."""
    o = _t(spark, d, "orders")
    pages = o.agg(F.max("o_orderkey")).first()[0] * 9 // 10
    return scan.assign(o, "o_orderkey", scan.plan(pages, 10, 5000)).groupBy("part").agg(F.count("*").alias("n"))


@query(f"SELECT _seq, user_id, xid, commit_lsn FROM {_X} WHERE xid % 10 <> 3")
def txn_committed_only(spark, d):
    x = _txn(spark, d)
    return changelog.committed(x, _commits(x)).select("_seq", "user_id", "xid", "commit_lsn")


@query(f"SELECT _seq, xid FROM {_X} WHERE xid % 10 <> 3 AND NOT (xid % 10 = 4 AND _seq % 2 = 1)")
def txn_stream_abort(spark, d):
    """Aborted transactions, and in every tenth only the subtransaction of odd changes."""
    x = _txn(spark, d).withColumn("subxid", F.col("xid") * 1000 + F.col("_seq") % 2)
    whole = x.where("xid % 10 = 3").select("xid", F.lit(0).cast("long").alias("subxid"))
    part = x.where("xid % 10 = 4").select("xid", (F.col("xid") * 1000 + 1).alias("subxid"))
    return changelog.drop_aborted(x, whole.unionByName(part).distinct()).select("_seq", "xid")


@query(f"SELECT xid, count(*) AS n FROM {_X} GROUP BY xid")
def txn_sizes(spark, d):
    return changelog.transaction_sizes(_txn(spark, d))


@query(f"SELECT max(n) AS n FROM (SELECT count(*) AS n FROM {_X} GROUP BY xid)")
def txn_largest(spark, d):
    return changelog.transaction_sizes(_txn(spark, d)).agg(F.max("n").alias("n"))


@query(f"SELECT event_id, 1000 + row_number() OVER (ORDER BY commit_lsn, event_id) - 1 AS _seq FROM (SELECT *, _seq AS event_id FROM (SELECT * EXCLUDE (_seq), _seq FROM {_X})) WHERE xid % 10 <> 3")
def seq_assignment(spark, d):
    x = _txn(spark, d).withColumnRenamed("_seq", "event_id")
    c = _commits(x.withColumn("_seq", F.col("event_id")))
    rows = x.join(c.select("xid", "commit_lsn"), "xid").withColumn("bucket", F.expr("commit_lsn div 65536"))
    return changelog.assign_sequence(rows, 1000, ["commit_lsn", "event_id"], "bucket").select("event_id", "_seq")


@query(f"""
WITH c AS (SELECT _seq, _op, user_id, CASE WHEN _seq % 3 = 0 THEN user_id + 1 END AS old_id FROM {_L})
SELECT _op, user_id, _seq FROM c UNION ALL SELECT 'D', old_id, _seq FROM c WHERE _op = 'U' AND old_id IS NOT NULL AND old_id <> user_id
""")
def update_expansion(spark, d):
    e = _events(spark, d).select("_op", "user_id", F.when(F.col("_seq") % 3 == 0, F.col("user_id") + 1).alias("old_id"), "_seq")
    return changelog.expand_updates(e, "old_id", "user_id")


_TABLED = f"(SELECT *, user_id % 4 AS tbl FROM {_L})"


def _tabled(spark, d):
    return _events(spark, d).withColumn("tbl", F.col("user_id") % 4)


@query(f"SELECT tbl, _seq FROM {_TABLED} x WHERE _seq > coalesce((SELECT max(_seq) FROM {_TABLED} t WHERE t._seq % 997 = 0 AND t.tbl = x.tbl), -1)")
def truncate_cutoff(spark, d):
    e = _tabled(spark, d)
    return changelog.after_truncate(e, e.where("_seq % 997 = 0"), "tbl", "_seq").select("tbl", "_seq")


@query(f"""
SELECT tbl, (rn - 1) // 100 AS batch, min(_seq) AS lsn_low, max(_seq) AS lsn_high, count(*) AS n_rows, sum(64 + coalesce(strlen(event_type), 0) + coalesce(strlen(props), 0))::BIGINT AS n_bytes
FROM (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY _seq) AS rn FROM {_TABLED}) GROUP BY ALL
""")
def flush_batches(spark, d):
    size = changelog.estimated_bytes(F.col("event_type"), F.col("props"))
    return changelog.flush_batches(_tabled(spark, d), 100, ["tbl"], ["_seq"], "_seq", size)


@query(f"""
SELECT tbl, _seq, sum(c) OVER (PARTITION BY tbl ORDER BY _seq)::BIGINT AS batch FROM (
  SELECT tbl, _seq, (coalesce(_seq // 1500 <> lag(_seq // 1500) OVER (PARTITION BY tbl ORDER BY _seq), false))::INT AS c FROM {_TABLED})
""")
def schema_barrier_batches(spark, d):
    e = _tabled(spark, d).withColumn("layout", F.expr("_seq div 1500"))
    return changelog.schema_batches(e, "layout", ["tbl"], ["_seq"]).select("tbl", "_seq", "batch")


@query(f"""
SELECT user_id, _seq, last_value(CASE WHEN _seq % 3 <> 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY _seq) AS value FROM {_L}
""")
def toast_patch(spark, d):
    e = _events(spark, d).withColumn("same", F.col("_seq") % 3 == 0)
    return changelog.patch_unchanged(e, "value", "same", ["user_id"], ["_seq"]).select("user_id", "_seq", "value")


@query(f"SELECT count(*) AS deletes, count(*) FILTER (WHERE _seq % 5 = 0) AS null_deletes FROM {_L} WHERE _op = 'D'")
def null_delete_metrics(spark, d):
    gone = F.col("_seq") % 5 == 0
    e = _events(spark, d).select("_op", *[F.when(~gone, F.col(c)).alias(c) for c in ("user_id", "value")])
    return changelog.null_deletes(e, ["user_id", "value"])


@query(f"SELECT user_id, max(_ts) AS at, count(*) AS n FROM {_L} WHERE _op <> 'D' AND user_id % 4 <> 0 GROUP BY user_id")
def audit_routing(spark, d):
    data, _ = changelog.route_audit(_tabled(spark, d), 0, "tbl")
    return data.where("_op <> 'D'").groupBy("user_id").agg(F.max("_ts").alias("at"), F.count("*").alias("n"))


def _queue(spark, d):
    """orders as staged files of supplier-like tables, nations as their states, regions of lineitem as schema changes."""
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey")
    files = o.select(
        k.cast("string").alias("file_id"), F.lit("public").alias("table_schema"), F.concat(F.lit("t"), (k % 25).cast("string")).alias("table_name"),
        F.when(k % 3 == 0, "backfill").otherwise("cdc").alias("file_type"), F.when(k % 3 != 0, k * 16).alias("lsn_low"), F.when(k % 3 == 0, k % 8).cast("long").alias("partition_id"),
        F.when(k % 25 < 5, F.when(k % 2 == 0, "pending").otherwise("completed")).when(k % 3 == 0, "completed").when(k % 4 == 0, "failed").otherwise("pending").alias("status"),
        k.alias("created_at"), (k % 5).alias("retry_count"),
    )
    n = _t(spark, d, "nation")
    tables = n.select(F.lit("public").alias("table_schema"), F.concat(F.lit("t"), F.col("n_nationkey").cast("string")).alias("table_name"), F.when(F.col("n_nationkey") % 4 == 3, "backfill_complete").otherwise("streaming").alias("phase"))
    events = n.where("n_nationkey % 6 = 1").select(
        F.lit("public").alias("target_schema"), F.concat(F.lit("t"), F.col("n_nationkey").cast("string")).alias("target_table"),
        F.when(F.col("n_nationkey") != 13, F.lit(40_000).cast("long")).alias("ddl_lsn"), F.when(F.col("n_nationkey") == 19, "applied").when(F.col("n_nationkey") == 7, "failed").otherwise("pending").alias("status"),
    )
    return files, tables, events


_QUEUE = """
WITH files AS (
  SELECT o_orderkey::VARCHAR AS file_id, 't' || (o_orderkey % 25) AS table_name, CASE WHEN o_orderkey % 3 = 0 THEN 'backfill' ELSE 'cdc' END AS file_type,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey * 16 END AS lsn_low, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 8 END AS partition_id,
    CASE WHEN o_orderkey % 25 < 5 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'completed' END WHEN o_orderkey % 3 = 0 THEN 'completed' WHEN o_orderkey % 4 = 0 THEN 'failed' ELSE 'pending' END AS status,
    o_orderkey AS created_at, o_orderkey % 5 AS retry_count FROM orders
), tables AS (
  SELECT 't' || n_nationkey AS table_name, CASE WHEN n_nationkey % 4 = 3 THEN 'backfill_complete' ELSE 'streaming' END AS phase FROM nation
), ddl AS (
  SELECT 't' || n_nationkey AS table_name, CASE WHEN n_nationkey <> 13 THEN 40000 END AS ddl_lsn, CASE n_nationkey WHEN 19 THEN 'applied' WHEN 7 THEN 'failed' ELSE 'pending' END AS status FROM nation WHERE n_nationkey % 6 = 1 AND status IN ('pending', 'applying', 'failed')
), eligible AS (
  SELECT f.* FROM files f JOIN tables t USING (table_name) WHERE f.status = 'pending' AND (f.file_type = 'backfill' OR (t.phase = 'streaming'
    AND NOT EXISTS (SELECT 1 FROM files b WHERE b.table_name = f.table_name AND b.file_type = 'backfill' AND b.status IN ('pending', 'processing'))
    AND NOT EXISTS (SELECT 1 FROM ddl WHERE ddl.table_name = f.table_name AND (ddl_lsn IS NULL OR ddl_lsn < f.lsn_low))))
)
"""


@query(_QUEUE + "SELECT file_id, table_name, file_type FROM eligible")
def claim_eligible_files(spark, d):
    return control.eligible(*_queue(spark, d)).select("file_id", "table_name", "file_type")


@query(_QUEUE + """
SELECT file_id, table_name, file_type FROM eligible e WHERE table_name = (SELECT table_name FROM eligible ORDER BY created_at, table_name, file_id LIMIT 1)
AND file_type = (SELECT min(file_type) FROM eligible x WHERE x.table_name = e.table_name) ORDER BY coalesce(partition_id, 0), created_at, file_id LIMIT 20""")
def claim_batch_order(spark, d):
    return control.next_batch(control.eligible(*_queue(spark, d)), 20).select("file_id", "table_name", "file_type")


@query(_QUEUE + "SELECT DISTINCT file_id FROM files f JOIN ddl USING (table_name) WHERE file_type = 'cdc' AND (ddl_lsn IS NULL OR ddl_lsn < lsn_low)")
def ddl_gate_blocked_files(spark, d):
    files, _, events = _queue(spark, d)
    return control.ddl_gate(files, events).select("file_id")


@query(_QUEUE + "SELECT DISTINCT file_id FROM files f JOIN ddl USING (table_name) WHERE file_type = 'cdc' AND ddl.status = 'failed' AND ddl_lsn < lsn_low")
def ddl_failed_blocks(spark, d):
    """Files that only a failed schema change holds back."""
    files, _, events = _queue(spark, d)
    return control.ddl_gate(files, events.where("status = 'failed'")).select("file_id")


@query(_QUEUE + "SELECT table_name FROM tables t WHERE phase = 'backfill_complete' AND NOT EXISTS (SELECT 1 FROM files f WHERE f.table_name = t.table_name AND file_type = 'backfill' AND status IN ('pending', 'processing', 'failed'))")
def promote_ready_tables(spark, d):
    files, tables, _ = _queue(spark, d)
    return control.ready_to_stream(tables, files).select("table_name")


_NOW = "1998-01-01 00:00:00"


def _dated(spark, d):
    o = _t(spark, d, "orders")
    at = F.col("o_orderdate").cast("timestamp")
    return o.select("o_orderkey", at.alias("processing_started"), at.alias("completed_at"), F.when(F.col("o_orderstatus") == "O", "processing").otherwise("completed").alias("status"), (F.col("o_orderkey") % 5).alias("retry_count"), F.expr("o_orderkey div 10").alias("batch"))


@query(f"SELECT o_orderkey, 'pending' AS status, o_orderkey % 5 + 1 AS retry_count FROM orders WHERE o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '{_NOW}' - INTERVAL 30 MINUTE")
def stale_reclaim(spark, d):
    return control.reclaim(_dated(spark, d), F.lit(_NOW).cast("timestamp")).select("o_orderkey", "status", "retry_count")


@query(f"SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O' AND o_orderdate < TIMESTAMP '{_NOW}' - INTERVAL 24 HOUR")
def retention_cleanup(spark, d):
    return control.due_for_cleanup(_dated(spark, d), F.lit(_NOW).cast("timestamp")).select("o_orderkey")


@query("SELECT o_orderkey // 10 AS batch, max(o_orderkey % 5) >= 3 AS failed FROM orders GROUP BY 1")
def retry_split(spark, d):
    return control.retry_split(_dated(spark, d))


@query("""
SELECT coalesce(n.k, o.k) AS k, coalesce(n.phase, o.phase) AS phase, coalesce(n.parts, o.parts) AS parts, CASE WHEN n.k % 3 = 0 THEN 'id' ELSE CASE WHEN o.k IS NULL THEN '' ELSE 'old' END END AS pk
FROM (SELECT s_suppkey AS k, 'pending' AS phase, s_nationkey AS parts FROM supplier WHERE s_suppkey % 2 = 0) o
FULL JOIN (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 4 = 0 THEN 'streaming' END AS phase, CASE WHEN s_suppkey % 5 = 0 THEN 7 END AS parts FROM supplier) n USING (k)
""")
def table_state_upsert(spark, d):
    s = _t(spark, d, "supplier")
    name = F.col("s_suppkey").cast("string").alias("table_name")
    empty, k = F.array().cast("array<string>"), F.col("s_suppkey")
    old = s.where("s_suppkey % 2 = 0").select(F.lit("p").alias("table_schema"), name, k.alias("k"), F.lit("pending").alias("phase"), F.col("s_nationkey").alias("parts"), F.array(F.lit("old")).alias("primary_key_columns"))
    new = s.select(F.lit("p").alias("table_schema"), name, k.alias("k"), F.when(k % 4 == 0, "streaming").alias("phase"), F.when(k % 5 == 0, 7).alias("parts"), F.when(k % 3 == 0, F.array(F.lit("id"))).otherwise(empty).alias("primary_key_columns"))
    return control.merge_table_state(old, new).select("k", "phase", "parts", F.array_join("primary_key_columns", ",").alias("pk"))


@query(f"SELECT greatest(max(commit_lsn), 16800000) AS flushed FROM {_X} WHERE xid % 10 <> 3")
def flushed_lsn_max(spark, d):
    x = _txn(spark, d)
    return _commits(x).agg(control.advance(F.lit(16_800_000).cast("long"), F.max("commit_lsn")).alias("flushed"))


@query(f"SELECT 'f' || o_orderkey || '.parquet' AS path FROM orders WHERE o_orderdate < TIMESTAMP '{_NOW}' - INTERVAL 1 HOUR AND o_orderkey % 2 = 1 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orphan_files(spark, d):
    path = lambda k, end: F.concat(F.lit("f"), k.cast("string"), end)
    files = _t(spark, d, "orders").select(path(F.col("o_orderkey"), F.when(F.col("o_orderkey") % 2 == 1, ".parquet").otherwise(".tmp")).alias("path"), F.col("o_orderdate").cast("timestamp").alias("modified"))
    tracked = _t(spark, d, "lineitem").select(path(F.col("l_orderkey"), F.lit(".parquet")).alias("path")).distinct()
    return scan.orphans(files, tracked, _NOW).select("path")


@query("SELECT 'orders' AS relation, p AS position, c AS \"column\" FROM (VALUES (0, 'o_custkey'), (1, 'o_orderkey')) v(p, c)")
def pk_discovery(spark, d):
    indexes = spark.createDataFrame([("orders", True, [2, 1]), ("orders", False, [3])], "relation string, is_primary boolean, key_numbers array<int>")
    attributes = spark.createDataFrame([("orders", i, c) for i, c in enumerate(_t(spark, d, "orders").columns, 1)], "relation string, number int, column string")
    return control.primary_key(indexes, attributes)


@query("SELECT 'orders' AS relation, n AS number, c AS \"column\", 25 AS oid FROM (VALUES (1, 'o_orderkey'), (3, 'o_orderstatus'), (4, 'o_totalprice'), (5, 'o_orderdate'), (6, 'o_orderpriority')) v(n, c)")
def column_discovery(spark, d):
    rows = [("orders", i, c, c == "o_custkey", 25) for i, c in enumerate(_t(spark, d, "orders").columns, 1)] + [("orders", -1, "ctid", False, 27)]
    return control.live_columns(spark.createDataFrame(rows, "relation string, number int, column string, dropped boolean, oid int"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity AS as_double, l_orderkey::INT AS as_int, l_linenumber % 2 = 0 AS as_bool, strftime(l_shipdate, '%Y-%m-%d')::DATE AS as_date, NULL::INT AS bad_int,
  l_extendedprice::VARCHAR::DECIMAL(38,18)::VARCHAR AS as_numeric FROM lineitem
""")
def text_decode_types(spark, d):
    t = _t(spark, d, "lineitem")
    text = lambda c: F.col(c).cast("string")
    return t.select(
        "l_orderkey", "l_linenumber", types.decode_text(text("l_quantity"), "double").alias("as_double"), types.decode_text(text("l_orderkey"), "int").alias("as_int"),
        types.decode_text(F.when(F.col("l_linenumber") % 2 == 0, "t").otherwise("yes"), "boolean").alias("as_bool"), types.decode_text(F.date_format("l_shipdate", "yyyy-MM-dd"), "date").alias("as_date"),
        types.decode_text(F.concat(text("l_orderkey"), F.lit("x")), "int").alias("bad_int"), types.decode_text(text("l_extendedprice"), "decimal(38,18)").cast("string").alias("as_numeric"),
    )


@query("SELECT o_orderkey, printf('%X/%X', (o_orderkey * 1234567891) >> 32, (o_orderkey * 1234567891) & 4294967295) AS shown, o_orderkey * 1234567891 AS parsed FROM orders")
def lsn_roundtrip(spark, d):
    shown = lsn.show_col(F.col("o_orderkey") * 1234567891)
    return _t(spark, d, "orders").select("o_orderkey", shown.alias("shown"), lsn.parse_col(shown).alias("parsed"))


@query("""
SELECT * FROM (VALUES ('ALTER TABLE users ADD COLUMN age INT', 'add', 'age', 'int'), ('ALTER TABLE users DROP COLUMN email', 'drop', 'email', NULL), ('ALTER TABLE users ALTER COLUMN name TYPE varchar(255)', 'alter', 'name', 'string'),
  ('ALTER TABLE users RENAME TO customers', 'unparsed', NULL, NULL)) v(sql, kind, name, lake)
""")
def ddl_parse_changes(spark, d):
    texts = ["ALTER TABLE users ADD COLUMN age INT", "ALTER TABLE users DROP COLUMN email", "ALTER TABLE users ALTER COLUMN name TYPE varchar(255)", "ALTER TABLE users RENAME TO customers"]
    return spark.createDataFrame([(s, c.kind, c.column, types.lake_type(c.type) if c.type else None) for s in texts for c in ddl.parse_alter(s)], "sql string, kind string, name string, lake string")


def _int(x, size: int):
    return F.unhex(F.lpad(F.hex((x if not isinstance(x, int) else F.lit(x)).cast("long")), 2 * size, "0"))


def _text(x):
    """A column of a row message: its text, or nothing for NULL."""
    data = x.cast("string").cast("binary")
    return F.when(x.isNull(), F.lit(b"n")).otherwise(F.concat(F.lit(b"t"), _int(F.octet_length(data), 4), data))


_USERS = [("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")]


def _frames(spark, d):
    """``events`` as a log: a relation message, then transactions of 50 rows; every tenth is streamed in a block and aborted. Every third update leaves ``props`` as it was."""
    e = _txn(spark, d).withColumn("at", F.col("xid") * 1000 + 100)
    aborted, end = F.col("xid") % 10 == 3, F.lit(_BASE) + (F.col("xid") + 1) * 4096
    head = F.when(aborted, _int(F.col("xid"), 4)).otherwise(F.lit(b""))
    sent = [_text(F.col(c)) for c, _ in _USERS[:3]]
    same = (F.col("_op") == "U") & (F.col("_seq") % 3 == 0)
    full = F.concat(_int(4, 2), *sent, F.when(same, F.lit(b"u")).otherwise(_text(F.col("props"))))
    keyed = F.concat(_int(4, 2), sent[0], F.lit(b"nnn"))
    body = F.when(F.col("_op") == "I", F.concat(F.lit(b"I"), head, _int(77, 4), F.lit(b"N"), full)).when(F.col("_op") == "D", F.concat(F.lit(b"D"), head, _int(77, 4), F.lit(b"K"), keyed)).otherwise(F.concat(F.lit(b"U"), head, _int(77, 4), F.lit(b"N"), full))
    rows = e.select((F.col("at") + F.col("_seq") % 50).alias("frame_idx"), body.alias("data"))
    stamp = F.col("ts") - 946_684_800_000_000
    of = e.groupBy("xid", "at").agg(F.max("_ts").alias("ts"))
    begin = F.when(aborted, F.concat(F.lit(b"S"), _int(F.col("xid"), 4), _int(1, 1))).otherwise(F.concat(F.lit(b"B"), _int(end, 8), _int(stamp, 8), _int(F.col("xid"), 4)))
    close = F.when(aborted, F.lit(b"E")).otherwise(F.concat(F.lit(b"C"), _int(0, 1), _int(end - 8, 8), _int(end, 8), _int(stamp, 8)))
    abort = F.concat(F.lit(b"A"), _int(F.col("xid"), 4), _int(F.col("xid"), 4))
    edges = of.select((F.col("at") - 1).alias("frame_idx"), begin.alias("data")).unionByName(of.select((F.col("at") + 50).alias("frame_idx"), close.alias("data"))).unionByName(of.where(aborted).select((F.col("at") + 51).alias("frame_idx"), abort.alias("data")))
    column = lambda name, key, oid: bytes([key]) + name.encode() + b"\0" + oid.to_bytes(4, "big") + b"\xff\xff\xff\xff"
    relation = b"R" + (77).to_bytes(4, "big") + b"public\0users\0d" + (4).to_bytes(2, "big") + b"".join(column(c, int(c == "user_id"), {"bigint": 20, "string": 25, "double": 701}[k]) for c, k in _USERS)
    first = spark.range(1).select(F.lit(0).cast("long").alias("frame_idx"), F.lit(relation).alias("data"))
    return first.unionByName(rows).unionByName(edges).withColumn("wal_start", F.col("frame_idx") * 16)


def _replayed(spark, log):
    """Frames to typed changes, ranked in commit order, merged into a table, and read. Ranking and merging read the changes more than once, so they are staged."""
    typed = Staged(frames.changes(frames.committed_rows(log), "public.users", _USERS), codec="zstd").df
    ranked = changelog.assign_sequence(typed.withColumn("bucket", F.expr("commit_lsn div 65536")), 0, ["commit_lsn", "frame_idx", "part"], "bucket")
    t = _warehouse(spark).create("public", "users", typed.select(*[c for c, _ in _USERS]).schema, ["user_id"])
    t.merge(ranked.drop("xid", "commit_lsn", "frame_idx", "part", "bucket"))
    return t.read()


def _frames_sql(bound: str) -> str:
    return f"""
WITH c AS (SELECT *, (_op = 'U' AND _seq % 3 = 0) AS same, max(_ts) OVER (PARTITION BY _seq // 50) AS moment FROM {_L} WHERE (_seq // 50) % 10 <> 3 AND {bound}),
known AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY moment, _seq) AS g FROM c),
filled AS (SELECT *, CASE WHEN g = 0 THEN NULL ELSE first_value(CASE WHEN _op = 'D' THEN NULL ELSE props END) OVER (PARTITION BY user_id, g ORDER BY moment, _seq) END AS now,
  row_number() OVER (PARTITION BY user_id ORDER BY moment DESC, _seq DESC) AS rn FROM known)
SELECT user_id, event_type, value, now AS props FROM filled WHERE rn = 1 AND _op <> 'D'
"""


@query(_frames_sql("true"))
def frames_to_state(spark, d):
    return _replayed(spark, _frames(spark, d))


@query(_frames_sql("_seq // 50 <= 100"))
def frames_bounded_replay(spark, d):
    """Up to a position between the ends of transactions 100 and 101."""
    return _replayed(spark, frames.until(_frames(spark, d), _BASE + 101 * 4096 + 9))


@query(f"SELECT _seq, user_id, _op, {_BASE} + (_seq // 50 + 1) * 4096 AS commit_lsn FROM {_L} WHERE (_seq // 50) % 10 <> 3")
def frames_committed_rows(spark, d):
    rows = frames.changes(frames.committed_rows(_frames(spark, d)), "public.users", _USERS)
    return rows.select(F.expr("frame_idx div 1000 * 50 + frame_idx % 1000 - 100").alias("_seq"), "user_id", "_op", "commit_lsn")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE 'new' END AS o_orderpriority FROM orders
""")
def toast_patch_lake(spark, d):
    """A batch that sends a third of the states and half of the priorities, and leaves the others as the table has them."""
    from tidemark.operators.merge import SAME

    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    t = _warehouse(spark).create("public", "orders", o.schema, ["o_orderkey"])
    t.append(o)
    k = F.col("o_orderkey")
    same = F.filter(F.array(F.when(k % 3 != 0, "o_orderstatus"), F.when(k % 2 == 0, "o_orderpriority")), lambda x: x.isNotNull())
    sent = o.select("o_orderkey", F.when(k % 3 == 0, "X").alias("o_orderstatus"), F.when(k % 2 != 0, "new").alias("o_orderpriority"), F.lit("U").alias("_op"), F.lit(1).cast("long").alias("_ts"), k.alias("_seq"), same.alias(SAME))
    t.merge(sent)
    return t.read()


@query(f"SELECT * FROM {_OLD}")
def writer_replay_state(spark, d):
    """A writer that crashes between its commit and the file's completion, and is run again: nothing is added twice."""
    import tempfile

    from tidemark.plans.pipeline import Writer
    from tidemark.plans.store import Store

    old, _ = _snapshots(spark, d)
    catalog, store = _warehouse(spark), Store(f"{tempfile.mkdtemp(prefix='tidemark-store-')}/control.db")
    catalog.create("public", "orders", old.schema, ["o_orderkey"])
    ranges = scan.plan(old.agg(F.max("o_orderkey")).first()[0] + 1, 10, 30_000)
    store.put_table("public", "orders", ["o_orderkey"], len(ranges))
    store.set_stage("public", "orders", "backfilling")
    for number, path in scan.backfill(old, "o_orderkey", ranges, f"{catalog.root}/export"):
        store.stage("public", "orders", "backfill", path, 0, time.time(), range_number=number)
        store.range_done("public", "orders", number)
    complete, store.complete = store.complete, lambda *_: None
    Writer(spark, store, catalog).step()
    store.complete = complete
    store.reclaim(time.time() + 7200)
    writer = Writer(spark, store, catalog)
    while writer.step():
        pass
    return catalog.table("public", "orders").read().select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
