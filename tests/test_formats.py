import struct
import uuid

import pytest

from tidemark.functions import ddl, lsn, types
from tidemark.plans import config
from tidemark.sources import copy_binary, frames, scan


def test_positions(spark):
    for n in (0, 1, 2**32 - 1, 2**32, 3 * 2**40 + 12345, 2**63 - 1):
        assert lsn.parse(lsn.show(n)) == n
    assert lsn.parse("A/10") == 10 * 2**32 + 16


@pytest.mark.parametrize("pages,density,rows", [(37, 20, 90), (1, 8, 1000), (12, 6, 36), (7, 0, 50), (0, 10, 10), (2000, 64, 640)])
def test_scan_plan(pages, density, rows):
    plan = scan.plan(pages, density, rows)
    assert [i for i, *_ in plan] == list(range(len(plan))) and plan[0][1] == 0 and plan[-1][2] == pages
    assert all(a[2] == b[1] for a, b in zip(plan, plan[1:]))
    if pages and density:
        assert all(0 < (b - a) and (b - a - 1) * density < rows for _, a, b in plan)
    assert scan.predicates(plan)[-1].count("AND") == 0


def test_backfill_resumes(spark, tmp_path):
    rows = spark.range(100).withColumnRenamed("id", "page")
    plan = scan.plan(80, 1, 30)
    first = scan.backfill(rows, "page", plan, f"{tmp_path}/x", done={1})
    assert [i for i, _ in first] == [0, 2]
    assert [spark.read.parquet(p).count() for _, p in first] == [30, 40] and scan.backfill(rows, "page", plan, f"{tmp_path}/x", done={0, 1, 2}) == []


def _blob(*rows, extension=b""):
    out = copy_binary.MAGIC + struct.pack(">ii", 0, len(extension)) + extension
    for r in rows:
        out += struct.pack(">h", len(r)) + b"".join(struct.pack(">i", -1) if v is None else struct.pack(">i", len(v)) + v for v in r)
    return out + struct.pack(">h", -1)


def test_copy(spark):
    kinds = [("a", 16), ("b", 17), ("c", 20), ("d", 21), ("e", 23), ("f", 25), ("g", 700), ("h", 701), ("i", 1082), ("j", 1083), ("k", 1184), ("l", 1700), ("m", 2950), ("n", 3802)]
    u = uuid.UUID(int=7)
    number = struct.pack(">hhHh", 2, 0, 0x4000, 2) + struct.pack(">hh", 12, 5000)
    one = (b"\x01", b"\x00z", struct.pack(">q", -9), struct.pack(">h", 3), struct.pack(">i", 8), "é".encode(), struct.pack(">f", 0.5), struct.pack(">d", 0.25), struct.pack(">i", -1), struct.pack(">q", 61), struct.pack(">q", 10), number, u.bytes, b"\x01{}")
    blob = _blob(one, (None,) * 14)
    df = spark.createDataFrame([(bytearray(blob),)], "content binary")
    got = sorted(map(tuple, copy_binary.read(df, kinds).collect()), key=lambda r: r[4] or 0)
    assert got == [(None,) * 14, (True, bytearray(b"\x00z"), -9, 3, 8, "é", 0.5, 0.25, 10_956, 61, 946_684_800_000_010, "-12.50", str(u), "{}")]
    assert copy_binary.body_start(_blob(extension=b"abcd")) == 23
    assert copy_binary.decode(struct.pack(">q", 757_382_400_000_000), 1114) == 757_382_400_000_000 + 946_684_800_000_000
    with pytest.raises(ValueError):
        list(copy_binary.rows(blob[:-4]))


def _log(spark, *messages):
    return spark.createDataFrame([(i, 0, bytearray(m)) for i, m in enumerate(messages)], "frame_idx long, wal_start long, data binary")


def _relation(oid, name, *columns):
    return b"R" + struct.pack(">I", oid) + b"land\0" + name + b"\0d" + struct.pack(">h", len(columns)) + b"".join(b"\0" + c + b"\0" + struct.pack(">Ii", 25, -1) for c in columns)


def _tuple(*values):
    return struct.pack(">h", len(values)) + b"".join(b"n" if v is None else b"u" if v == "same" else b"t" + struct.pack(">i", len(v)) + v for v in values)


def _row(tag, oid, new=None, old=None, xid=None):
    head = b"" if xid is None else struct.pack(">I", xid)
    return tag + head + struct.pack(">I", oid) + (b"O" + _tuple(*old) if old else b"") + (b"N" + _tuple(*new) if new else b"")


def _begin(lsn, xid):
    return b"B" + struct.pack(">QqI", lsn, 0, xid)


def _commit(lsn, ts=0):
    return b"C" + struct.pack(">BQQq", 0, lsn - 1, lsn, ts)


def test_frames_to_changes(spark, monkeypatch):
    monkeypatch.setattr(frames, "RANGE", 4)
    log = _log(
        spark,
        _relation(5, b"lots", b"id", b"owner"), _begin(50, 1), _row(b"I", 5, (b"1", b"x")), _row(b"I", 9, (b"?",)), _row(b"U", 5, (b"1", "same")), _commit(60, 7),
        _relation(5, b"lots", b"owner", b"id", b"tax"), _begin(70, 2), _row(b"U", 5, (b"y", b"3", b"9"), (b"x", b"2", None)), _row(b"D", 5, old=(None, b"1", None)), _commit(80, 8),
        b"S" + struct.pack(">IB", 3, 1), _row(b"I", 5, (b"s", b"4", None), xid=3), _row(b"I", 5, (b"t", b"5", None), xid=31), b"E",
        b"S" + struct.pack(">IB", 4, 1), _row(b"I", 5, (b"gone", b"6", None), xid=4), b"E", b"A" + struct.pack(">II", 3, 31), b"A" + struct.pack(">II", 4, 4),
        b"c" + struct.pack(">IBQQq", 3, 0, 89, 90, 9), _begin(95, 5), _row(b"I", 5, (b"open", b"7", None)),
    )
    rows = frames.committed_rows(log)
    got = sorted(frames.changes(rows, "land.lots", [("id", "int"), ("owner", "string"), ("tax", "int")]).collect(), key=lambda r: (r.commit_lsn, r.frame_idx, r.part))
    base = 946_684_800_000_000
    assert [(r.id, r.owner, r.tax, r._op, r._ts - base, r._same, r.commit_lsn) for r in got] == [
        (1, "x", None, "I", 7, [], 60), (1, None, None, "U", 7, ["owner"], 60), (2, "x", None, "D", 8, [], 80), (3, "y", 9, "U", 8, [], 80), (1, None, None, "D", 8, [], 80), (4, "s", None, "I", 9, [], 90),
    ]
    messages = frames.read(log)
    assert [tuple(r) for r in frames.unknown_relations(messages.where("kind IN ('I', 'U', 'D')"), messages.where("kind = 'R'")).collect()] == [(9, 1)]
    assert frames.committed_rows(frames.until(log, 85)).agg({"commit_lsn": "max"}).first()[0] == 80


def test_frames_stand_once_in_the_plan(spark):
    log = _log(spark, _relation(5, b"lots", b"id"), _begin(50, 1), _row(b"I", 5, (b"1",)), _commit(60), _begin(70, 2), _row(b"I", 5, (b"2",)), _commit(80))
    leaves = lambda df: df._jdf.queryExecution().analyzed().collectLeaves().size()
    marked = frames.carried(frames.carried(log, frames.F.lit(1), "a"), frames.F.lit(2), "b")
    assert leaves(frames.until(log, 60)) == 1 and leaves(marked) == 3
    rows = frames.committed_rows(frames.until(log, 60))
    assert leaves(rows) < 20 and [r.commit_lsn for r in rows.collect()] == [60]
    assert frames.until(log, 1).count() == 0


def test_schema_events(spark):
    log = _log(spark, _relation(6, b"audit", b"txn", b"tag", b"name", b"namespace", b"statement"), _begin(10, 1), _row(b"I", 6, (b"77", b"ALTER TABLE", b"lots", None, b"ALTER TABLE lots ADD a int")), _row(b"I", 6, (b"77", b"", b"", None, b"")), _commit(20))
    assert [tuple(r) for r in frames.schema_events(frames.committed_rows(log), "land.audit").collect()] == [("ALTER TABLE", "public", "lots", "ALTER TABLE lots ADD a int", 20, 77)]


def test_messages():
    assert frames.decode(b"Z")["kind"] == "Z" and frames.decode(b"T" + struct.pack(">iBII", 2, 0, 8, 9))["oids"] == [8, 9]
    assert frames.decode(b"O" + struct.pack(">Q", 4) + b"far\0")["prefix"] == "far"
    assert frames.decode(b"M" + struct.pack(">BQ", 0, 6) + b"p\0" + struct.pack(">i", 2) + b"hi")["content"] == b"hi"
    with pytest.raises(ValueError):
        frames.decode(_row(b"I", 5, (b"cut off",))[:-3])
    wal = frames.copy_data(b"w" + struct.pack(">QQq", 1, 2, 3) + b"rest")
    assert (wal["wal_start"], wal["wal_end"], wal["data"]) == (1, 2, b"rest") and frames.copy_data(b"k" + struct.pack(">QqB", 9, 0, 1))["reply"]
    assert frames.status(7, 8) == b"r" + struct.pack(">QQQqB", 7, 7, 7, 8, 0)
    with pytest.raises(ValueError):
        frames.copy_data(b"?")


STATEMENTS = [
    ("ADD COLUMN IF NOT EXISTS floor smallint NOT NULL DEFAULT 1", [("add", "floor", "smallint")]),
    ('ADD "Size" numeric(8, 2), DROP IF EXISTS note CASCADE', [("add", "Size", "numeric(8,2)"), ("drop", "note", None)]),
    ("ALTER fee SET DATA TYPE double precision USING fee::float8", [("alter", "fee", "double precision")]),
    ("ADD CONSTRAINT c CHECK (fee > 0), ADD tags text[]", [("add", "tags", "text[]")]),
    ("RENAME COLUMN fee TO cost", [("unparsed", None, None)]),
]


@pytest.mark.parametrize("text,want", STATEMENTS)
def test_alter(text, want):
    assert [(c.kind, c.column, c.type) for c in ddl.parse_alter(f"ALTER TABLE ONLY land.lots {text}")] == want


def test_changes_read_as_they_were_written():
    for sql in ("ADD COLUMN a INT", "DROP COLUMN b", "ALTER COLUMN c TYPE text"):
        (c,) = ddl.parse_alter(f"ALTER TABLE t {sql}")
        assert [c] == ddl.parse_alter(f"ALTER TABLE t {c}")
    assert ddl.parse_drop('DROP TABLE IF EXISTS land."Lots" CASCADE') == ["land", "Lots"]


def test_comments():
    assert ddl.parse_comment("comment on table land.lots is 'what the owner''s deed says'") == ("table", ["land", "lots"], "what the owner's deed says")
    assert ddl.parse_comment('COMMENT ON COLUMN lots."Size" IS NULL') == ("column", ["lots", "Size"], None)
    assert ddl.parse_comment("COMMENT ON INDEX i IS 'x'")[0] == ddl.parse_comment("VACUUM")[0] == "other"


def test_types(spark):
    assert types.array_literal('{a,"b,c",NULL,"NULL"}') == ["a", "b,c", None, "NULL"]
    assert types.lake_type("_int4") == "array<int>" and types.lake_type("numeric(10,2)") == "decimal(38,18)" and types.lake_type("inet") == "string"
    df = spark.createDataFrame([("{1,2,NULL}", "yes", "\\x4142", "infinity", " 12 ")], "a string, b string, c string, d string, e string")
    from pyspark.sql import functions as F

    got = df.select(types.decode_text(F.col("a"), "array<int>"), types.decode_text(F.col("b"), "boolean"), types.decode_text(F.col("c"), "binary"), types.decode_text(F.col("d"), "date").cast("string"), types.decode_text(F.col("e"), "int")).first()
    assert got[0] == [1, 2, None] and got[1] is False and bytes(got[2]) == b"AB" and got[3].startswith("+5881580") and got[4] is None


def test_config():
    s = config.load('batch_rows = 10\npassword = "file"', {"TIDEMARK_BATCH_BYTES": "5"})
    assert (s.batch_rows, s.batch_bytes, s.flush_seconds) == (10, 5, 30) and s.secret({"TIDEMARK_PASSWORD": "env"}) == "env"
    assert config.quote('a"b') == '"a""b"' and config.literal("it's") == "'it''s'" and config.snapshot_name("00A-1B") == "00A-1B"
    with pytest.raises(ValueError):
        config.snapshot_name("x; DROP")
