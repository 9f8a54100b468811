"""Merge, resync, tables and the writer against a plain model in Python, on random changelogs."""

import random
import time

import pytest

from tidemark.functions import ddl
from tidemark.operators import changelog, merge, resync
from tidemark.plans import control
from tidemark.plans.pipeline import Writer
from tidemark.plans.store import Store
from tidemark.plans.table import Catalog

COLUMNS = "town string, lot int, owner string, price double"
CHANGES = COLUMNS + ", _op string, _ts long, _seq long"
KEY = ["town", "lot"]


def random_changes(seed: int, n: int = 200, first: int = 0) -> list[tuple]:
    r = random.Random(seed)
    out = []
    for i in range(n):
        op = r.choice("IUUD")
        gone = op == "D"
        out.append((r.choice("abc"), r.randrange(8), None if gone else r.choice(["x", "y", None]), None if gone else r.random(), op, first + i // 4, first + i))
    r.shuffle(out)
    return out


def applied(state: dict, changes: list[tuple]) -> dict:
    state = dict(state)
    for town, lot, owner, price, op, *_ in sorted(changes, key=lambda c: c[5:]):
        state.pop((town, lot), None)
        if op != "D":
            state[town, lot] = (owner, price)
    return state


def rows_of(df) -> dict:
    rows = df.select("town", "lot", "owner", "price").collect()
    assert len({tuple(r)[:2] for r in rows}) == len(rows)
    return {tuple(r)[:2]: tuple(r)[2:] for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_split(spark, seed):
    changes = random_changes(seed)
    ups, dels = merge.split(spark.createDataFrame(changes, CHANGES), KEY)
    assert rows_of(ups) == applied({}, changes)
    assert sorted(map(tuple, dels.collect())) == sorted({c[:2] for c in changes})
    best = merge.dedup_max_by(spark.createDataFrame(changes, CHANGES), KEY)
    assert rows_of(merge.upserts(best)) == applied({}, changes)


def test_split_of_nothing(spark):
    ups, dels = merge.split(spark.createDataFrame([], CHANGES), KEY)
    assert ups.count() == dels.count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_resync(spark, seed):
    r = random.Random(seed)
    old = {(t, i): (r.choice("xy"), float(r.randrange(3))) for t in "abc" for i in range(9) if r.random() < 0.7}
    new = {(t, i): (r.choice("xy"), float(r.randrange(3))) for t in "abc" for i in range(9) if r.random() < 0.7}
    frame = lambda s: spark.createDataFrame([(*k, *v) for k, v in s.items()], COLUMNS)
    ups, dels = resync.resync_upserts(frame(old), frame(new), KEY), resync.resync_deletes(frame(old), frame(new), KEY)
    assert rows_of(ups) == {k: v for k, v in new.items() if old.get(k) != v}
    assert {tuple(x) for x in dels.collect()} == old.keys() - new.keys()
    assert rows_of(resync.apply_diff(frame(old), ups, dels, KEY)) == new
    wider = frame(new).selectExpr("*", "price + 1 AS tax")
    assert resync.resync_upserts(frame(old), wider, KEY).count() == len(new)


def test_table_against_model(spark, tmp_path):
    table = Catalog(spark, str(tmp_path)).create("land", "lots", spark.createDataFrame([], COLUMNS).schema, KEY)
    model, versions = {}, {}
    base = applied({}, random_changes(9, 30))
    table.append(spark.createDataFrame([(*k, *v) for k, v in base.items()], COLUMNS))
    model = base
    for i in range(30):  # beyond the version at which the state is written beside the log
        changes = random_changes(100 + i, 8, first=1000 * (i + 1))
        versions[table.merge(spark.createDataFrame(changes, CHANGES).coalesce(1), source={"query": "q", "batch": i})] = model = applied(model, changes)
    assert table.merge(spark.createDataFrame(changes, CHANGES), source={"query": "q", "batch": 29}) is None
    assert rows_of(table.read()) == model
    again = Catalog(spark, str(tmp_path)).table("land", "lots")
    for v in (min(versions), 20, max(versions)):
        assert rows_of(again.read(v)) == versions[v]
    assert again.read()._jdf.queryExecution().optimizedPlan().toString().count("parquet") <= 4
    assert again.compact_if_due(5) and again.compact_if_due(5) is None and rows_of(again.read()) == model
    assert again.vacuum() and rows_of(again.read()) == model


def test_table_schema(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    t = catalog.create("land", "lots", spark.createDataFrame([], COLUMNS).schema, KEY, "all lots")
    t.append(spark.createDataFrame([("a", 1, "x", 2.0)], COLUMNS))
    t.alter(ddl.parse_alter("ALTER TABLE lots ADD sold boolean, DROP COLUMN owner"))
    assert t.read().columns == ["town", "lot", "price", "sold"] and t.state()["properties"]["comment"] == "all lots"
    with pytest.raises(ValueError):
        t.alter(ddl.parse_alter("ALTER TABLE lots DROP COLUMN lot"))
    with pytest.raises(ValueError):  # a column that the table does not know is not lost
        t.append(spark.createDataFrame([("b", 1, "x", 2.0)], COLUMNS))
    with pytest.raises(Exception, match="price"):
        t.append(spark.createDataFrame([("b", 1, "dear")], "town string, lot int, price string"))
    t.comment(None)
    t.comment("in cents", "price")
    assert "comment" not in t.state()["properties"] and t.schema["price"].metadata["comment"] == "in cents"
    assert catalog.drop("land", "lots") and not catalog.drop("land", "lots")


def test_unchanged_values(spark, tmp_path):
    t = Catalog(spark, str(tmp_path)).create("land", "lots", spark.createDataFrame([], COLUMNS).schema, KEY)
    t.append(spark.createDataFrame([("a", 1, "old", 1.0), ("a", 2, "old", 2.0)], COLUMNS))
    rows = [
        ("a", 1, None, 5.0, "U", 1, 1, ["owner"]),  # from the table
        ("a", 2, "new", None, "U", 1, 2, ["price"]), ("a", 2, None, 7.0, "U", 1, 3, ["owner"]),  # from the batch
        ("a", 3, None, 3.0, "I", 1, 4, []), ("a", 3, None, 4.0, "U", 1, 5, ["owner"]),  # a NULL that was sent
    ]
    t.merge(spark.createDataFrame(rows, CHANGES + ", _same array<string>"))
    assert rows_of(t.read()) == {("a", 1): ("old", 5.0), ("a", 2): ("new", 7.0), ("a", 3): (None, 4.0)}


def staged(spark, store, folder, kind, rows, n, **more):
    path = f"{folder}/{kind}{n}"
    spark.createDataFrame(rows, CHANGES if kind == "cdc" else COLUMNS).write.parquet(path)
    return store.stage("land", "lots", kind, path, len(rows), time.time(), **more)


def test_writer(spark, tmp_path):
    """Backfill, changes, a crash before completion, and a failed schema change that holds later files."""
    store, catalog = Store(str(tmp_path / "control.db")), Catalog(spark, f"{tmp_path}/lake")
    catalog.create("land", "lots", spark.createDataFrame([], COLUMNS).schema, KEY)
    store.put_table("land", "lots", KEY, 1)
    store.set_stage("land", "lots", "backfilling")
    store.put_source("s", "all", 5)
    assert store.resume("s") == 5
    early = staged(spark, store, tmp_path, "cdc", [("a", 1, "new", 2.0, "U", 1, 1)], 1, span=(10, 20), source="s")
    staged(spark, store, tmp_path, "backfill", [("a", 1, "x", 1.0), ("a", 2, "x", 1.0)], 2, range_number=0)
    store.range_done("land", "lots", 0)
    store.range_done("land", "lots", 0)
    assert store.resume("s") == 20 and store.ranges_done("land", "lots") == {0}
    writer, table = Writer(spark, store, catalog), catalog.table("land", "lots")
    complete, store.complete = store.complete, lambda *_: None
    assert writer.step() == 1 and table.read().count() == 2  # the file's completion is lost
    store.complete = complete
    assert writer.step() == 0 and store.reclaim(time.time() + 7200) == 1
    assert writer.step() == 1 and rows_of(table.read()) == {("a", 1): ("x", 1.0), ("a", 2): ("x", 1.0)}
    assert writer.step() == 1 and rows_of(table.read())["a", 1] == ("new", 2.0)
    assert store.table("land", "lots")["merged_to"] == 20 and writer.key("land", "lots") == KEY
    store.add_change("ALTER TABLE", "land", "lots", "ALTER TABLE lots RENAME COLUMN owner TO holder", 25)
    late = staged(spark, store, tmp_path, "cdc", [("a", 1, "lost?", 2.0, "U", 2, 2)], 3, span=(30, 40), source="s")
    assert writer.step() == 0 and rows_of(table.read())["a", 1] == ("new", 2.0)
    (held,) = store.rows("SELECT number, outcome FROM schema_change")
    assert held["outcome"] == "failed" and late > early
    store.settle_change(held["number"], "skipped", time.time())
    assert writer.step() == 1 and rows_of(table.read())["a", 1] == ("lost?", 2.0)
    store.reconcile("land", "lots")
    store.set_stage("land", "lots", "backfill_complete")
    staged(spark, store, tmp_path, "backfill", [("b", 1, "z", 9.0)], 4, range_number=0)
    assert writer.step() == 1 and rows_of(table.read()) == {("b", 1): ("z", 9.0)} and not store.table("land", "lots")["reconcile"]
    assert len(store.expired(time.time() + 1e6)) == 4 and store.tracked(spark).count() == 0


def test_store_retries(tmp_path):
    store = Store(str(tmp_path / "control.db"))
    n = store.stage("p", "t", "cdc", "f", 1, 0.0)
    for _ in range(4):
        assert store.lease([n], 1.0) == [n] and store.lease([n], 1.0) == []
        store.release([n], "broken")
    assert store.lease([n], 1.0) == [] and store.rows("SELECT outcome FROM lease")[0]["outcome"] == "failed"
    store.lost()
    assert store.open_from("p", "t") == n


def test_updates_and_aborts(spark):
    moves = spark.createDataFrame([("U", 20, 10, 1), ("U", 30, None, 2), ("U", 40, 40, 3), ("I", 50, None, 4)], "_op string, id int, old int, _seq int")
    assert sorted(map(tuple, changelog.expand_updates(moves, "old", "id").collect())) == [("D", 10, 1), ("I", 50, 4), ("U", 20, 1), ("U", 30, 2), ("U", 40, 3)]
    parts = spark.createDataFrame([(7, 7, "whole"), (7, 71, "whole"), (8, 81, "part"), (8, 82, "stays")], "xid long, subxid long, v string")
    aborts = spark.createDataFrame([(7, 0), (8, 81)], "xid long, subxid long")
    assert [r.v for r in changelog.drop_aborted(parts, aborts).collect()] == ["stays"]


def test_schema_gate(spark):
    files = [("land", t, "cdc", at, "pending", f"{t}{at}") for t, at in (("lots", 5), ("lots", 15), ("towns", 5), ("towns", 15), ("roads", 5))]
    files = spark.createDataFrame(files, "table_schema string, table_name string, file_type string, lsn_low long, status string, file_id string")
    tables = spark.createDataFrame([("land", t, "streaming") for t in ("lots", "towns", "roads")], "table_schema string, table_name string, phase string")
    events = spark.createDataFrame([("land", "lots", 10, "failed"), ("land", "towns", 10, "applied"), ("land", "roads", None, "pending")], "target_schema string, target_table string, ddl_lsn long, status string")
    assert {r.file_id for r in control.eligible(files, tables, events).collect()} == {"lots5", "towns5", "towns15"}
