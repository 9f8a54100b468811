"""Line dedup by a deletion-neighbourhood join over words; the earliest of similar lines stays.

A line is its words, in lower case and without outer blanks. Two lines are copies if they are equal, or if both
have at least ``min_words`` words and one edit (a word replaced, inserted or deleted) turns one into the other.
A line occurrence is dropped if an equal line stands earlier, or if it is the first of its kind and some copy's
first occurrence is earlier, by (doc_id, line number). Blank lines always stay.

How: equal lines are aggregated to their first occurrence by a 128-bit fingerprint. If one edit separates two
lines, the half of the shorter one that the edit spares is a prefix or suffix of both, so only lines that share
such a half with another can have a partner, and only by an edit beyond that half. Those emit their deletion variants as hashed keys: for each word the
line without it (with its place and the word count: equal keys differ in that word at most), and the whole line
to meet longer ones. Keys are aggregated to the earliest member, which each other member is verified against
word by word, so no pairs within a group are made, and a group of any size costs its own length. Variants are
XORs of place-salted word hashes, so all variants of a line cost its own length too.

Only DataFrame functions. Nulls: a null text has no lines and stays null; a null doc_id comes first. Rows that
repeat id and text are one document and keep the same lines. Very long lines have as many variants as words. An
empty table gives no rows. Extra columns are carried by ``dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import KeyFilter, cut, put_back, salted_lookup, set_aside, skewed_lookup

MIN_WORDS = 5


def _normal(line: Column) -> Column:
    return F.lower(F.trim(line))


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _coarse(min_words: int) -> Column:
    """Keys of as many first and last words as the largest power of two within half the shorter line, for our length and one less."""
    keys = []
    for k in (0, 1):
        m, h = F.col("n_words") - k, F.expr(f"int(power(2, floor(log2(greatest((n_words - {k}) div 2, 1)))))")
        for end, part in (("first", F.slice("words", F.lit(1), h)), ("last", F.slice("words", -h, h))):
            keys.append(F.when(m >= min_words, F.xxhash64(F.lit(end), h, part)))
    return F.array_distinct(F.array_compact(F.array(*keys)))


#: Bits of what a line shares: with a line as long its first or last half (1, 2); as the longer one (4, 8); as the shorter one (16).
_FIRST, _LAST, _LONG_FIRST, _LONG_LAST, _SHORT = 1, 2, 4, 8, 16


def _fine(min_words: int) -> Column:
    """(key, role, bit) of the exact halves: for the shorter line's length m (ours: role 0, one less: role 1), its first m div 2 words and its last m - m div 2."""
    keys = []
    for k in (0, 1):
        m, h = F.col("n_words") - k, F.expr(f"int((n_words - {k}) div 2)")
        first = F.xxhash64(F.lit("first"), m, F.slice("words", F.lit(1), h))
        last = F.xxhash64(F.lit("last"), m, F.slice("words", F.col("n_words") - m + h + 1, m - h))
        for bit, x in ((_FIRST << 2 * k, first), (_LAST << 2 * k, last)):
            keys.append(F.when(m >= min_words, F.struct(x.alias("key"), F.lit(k).alias("role"), F.lit(bit).alias("bit"))))
    return F.array_compact(F.array(*keys))


def _candidates(first: DataFrame, docs: DataFrame) -> DataFrame:
    """(at, norm) of the lines that share a coarse half with another; of all others nothing leaves the scan but what a bounded filter lets through."""
    keyed = first.select("a", F.explode("halves").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("a").alias("lo"), F.max("a").alias("hi")).where("lo <> hi").select("key", "n")
    alive = skewed_lookup(keyed, shared, ["key"], F.col("a"), "left_semi").select("a").distinct()
    picked = cut(first.select("a", "at").join(alive, "a", "left_semi").select("at"))
    wanted = KeyFilter(picked.select(F.xxhash64("at.doc_id", "at.rid", "at.line_no").alias("h")), picked.count())
    lines = _lines(docs).where(wanted.may_hold(F.xxhash64("doc_id", "rid", "line_no")))
    # rows that repeat id and text give a line each
    return lines.select(F.struct("doc_id", "rid", "line_no").alias("at"), _normal(F.col("line")).alias("norm")).dropDuplicates(["at"]).join(picked, "at", "left_semi")


def _near(first: DataFrame, docs: DataFrame, min_words: int) -> DataFrame:
    """(at) of distinct lines that have an earlier copy by one edit."""
    found = cut(_candidates(first, docs))
    split = lambda df: df.withColumn("words", F.split("norm", " ")).withColumn("n_words", F.size("words"))
    halves = split(found).select("at", F.explode(_fine(min_words)).alias("k")).select("at", "k.*")
    when = lambda c: F.when(F.col("role") == 0, c)
    shared = halves.groupBy("key").agg(F.count("*").alias("n"), (F.min(when(F.col("at"))) < F.max(when(F.col("at")))).alias("equal"), (F.max("role") > F.min("role")).alias("unequal")).where("equal or unequal")
    bits = F.when(F.col("role") == 0, F.when(F.col("equal"), F.col("bit")).otherwise(0).bitwiseOR(F.when(F.col("unequal"), _SHORT).otherwise(0))).otherwise(F.when(F.col("unequal"), F.col("bit")).otherwise(0))
    held = skewed_lookup(halves, shared, ["key"], F.xxhash64("at")).groupBy("at").agg(F.bit_or(bits).alias("bits")).where("bits > 0")
    lines = split(cut(found.join(held, "at").select("at", "norm", "bits")))
    xor = lambda acc, x: acc.bitwiseXOR(x)
    zero = F.lit(0).cast("long")
    has = lambda bit: F.col("bits").bitwiseAND(bit) > 0
    variant = lambda key, kind, place: F.struct(key.alias("key"), F.lit(kind).alias("kind"), place.cast("int").alias("place"))
    none = F.array().cast("array<struct<key:bigint,kind:int,place:int>>")
    half = lambda k: F.expr(f"(n_words - {k}) div 2")
    hashed = (
        lines.withColumn("z", F.transform("words", lambda w, i: F.xxhash64(w, i)))
        .withColumn("x", F.aggregate("z", zero, xor))
        # the line without word 0, then by steps from the line without word i to that without word i + 1
        .withColumn("shifted", F.when(has(_LONG_FIRST | _LONG_LAST), F.transform("words", lambda w, i: F.xxhash64(w, i - 1))))
        .withColumn("without_first", F.aggregate(F.expr("slice(shifted, 2, n_words)"), zero, xor))
        .withColumn("steps", F.zip_with(F.expr("slice(shifted, 2, n_words)"), F.expr("slice(z, 1, n_words - 1)"), lambda s, y: s.bitwiseXOR(y)))
        .withColumn("without", F.aggregate("steps", F.array("without_first"), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(s)))))
    )
    # kind 0: one word replaced, 1: a word too many, 2: the whole line; only where the half that is shared leaves room
    replaced = F.filter(F.transform("z", lambda x, i: variant(F.xxhash64(F.lit(0), F.col("n_words"), i, F.col("x").bitwiseXOR(x)), 0, i)), lambda v: (has(_FIRST) & (v["place"] >= half(0))) | (has(_LAST) & (v["place"] < half(0))))
    longer = F.filter(
        F.coalesce(F.transform("without", lambda x, i: variant(F.xxhash64(F.lit(1), F.col("n_words") - 1, x), 1, i)), none),
        lambda v: (has(_LONG_FIRST) & (v["place"] >= half(1))) | (has(_LONG_LAST) & (v["place"] <= half(1))),
    )
    whole = F.when(has(_SHORT), F.array(variant(F.xxhash64(F.lit(1), F.col("n_words"), F.col("x")), 2, F.lit(-1)))).otherwise(none)
    variants = hashed.select("at", F.explode(F.concat(replaced, longer, whole)).alias("v")).select("at", "v.key", "v.kind", "v.place")
    # the earliest of each side; a replaced word compares with any member, a longer line with the whole one only
    side = lambda k: F.min(F.when(F.col("kind") == k, F.struct("at", "place")))
    groups = variants.groupBy("key").agg(F.count("*").alias("n"), side(0).alias("r"), side(1).alias("l"), side(2).alias("w")).where("n > 1 and (l is null or w is not null)")
    other = F.when(F.col("kind") == 0, F.col("r")).when(F.col("kind") == 1, F.col("w")).otherwise(F.col("l"))
    claims = (
        skewed_lookup(variants, groups, ["key"], F.xxhash64("at"))
        .withColumn("o", other)
        .where("o is not null and o.at < at")
        .select("at", F.col("o.at").alias("oat"), "kind", F.when(F.col("kind") == 2, F.col("o.place")).otherwise(F.col("place")).alias("place"))
        .distinct()
    )
    text = lines.select("at", "norm").distinct()
    lacking = lambda w: F.filter(w, lambda x, i: i != F.col("place"))
    equal = (
        F.when(F.col("kind") == 0, lacking("words") == lacking("owords"))
        .when(F.col("kind") == 1, lacking("words") == F.col("owords"))
        .otherwise(F.col("words") == lacking("owords"))
    )
    pairs = salted_lookup(claims.join(text, "at"), text.select(F.col("at").alias("oat"), F.col("norm").alias("onorm")), ["oat"], F.xxhash64("at"), "inner", salts=8)
    pairs = pairs.withColumn("words", F.split("norm", " ")).withColumn("owords", F.split("onorm", " "))
    return pairs.where(equal).select("at").distinct()


def decisions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, rid, kept): the numbers of the non-blank lines that each document keeps; documents that keep none have no row."""
    lines = _lines(docs).withColumn("norm", _normal(F.col("line"))).where("norm <> ''")
    numbered = (
        lines.withColumn("words", F.split("norm", " "))
        .withColumn("n_words", F.size("words"))
        .withColumn("h", _coarse(min_words))
        .select(
            F.xxhash64("norm").alias("a"),
            F.xxhash64(F.lit(0x5DEECE66D), "norm").alias("b"),
            F.struct("doc_id", "rid", "line_no").alias("at"),
            *[F.get("h", F.lit(i)).alias(f"h{i}") for i in range(4)],
        )
    )
    first = numbered.groupBy("a", "b").agg(F.min("at").alias("at"), *[F.min(f"h{i}").alias(f"h{i}") for i in range(4)])
    first = cut(first.select("a", "at", F.array_compact(F.array(*[f"h{i}" for i in range(4)])).alias("halves")))
    gone = cut(_near(first, docs, min_words)).select("at.doc_id", "at.rid", "at.line_no", F.lit(True).alias("gone"))
    every = first.select("at.doc_id", "at.rid", "at.line_no", F.lit(False).alias("gone")).unionByName(gone)
    numbers = lambda c: F.collect_list(F.when(c, F.col("line_no")))
    of_doc = every.groupBy("doc_id", "rid").agg(numbers(~F.col("gone")).alias("all"), numbers(F.col("gone")).alias("gone"))
    return cut(of_doc.select("doc_id", "rid", F.array_except("all", "gone").alias("kept")).where(F.size("kept") > 0))


def _with_kept(docs: DataFrame, min_words: int) -> DataFrame:
    kept = decisions(docs, min_words).select(F.col("doc_id").alias("_doc"), F.col("rid").alias("_rid"), F.col("kept").alias("_kept"))
    return (
        docs.withColumn("_own", F.xxhash64("doc_id", "text"))
        .join(kept, F.col("_own").eqNullSafe(F.col("_rid")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
        .withColumn("_kept", F.coalesce("_kept", F.array().cast("array<int>")))
        .withColumn("_lines", F.split("text", "\n"))
        .withColumn("_left", F.filter("_lines", lambda x, i: (_normal(x) == "") | F.array_contains("_kept", i)))
        .drop("_own", "_rid", "_doc")
    )


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without their later copies of lines, n_chars set anew; documents that lose every line they had are dropped."""
    out = _with_kept(set_aside(docs), min_words).where(F.col("text").isNull() | (F.size("_kept") > 0) | ~F.exists("_lines", lambda x: _normal(x) != ""))
    return put_back(out, docs, F.array_join("_left", "\n"))


def digest(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_md5) of every document."""
    return _with_kept(docs.select("doc_id", "text"), min_words).select(
        "doc_id",
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_lines") - F.size("_left"), F.lit(0)).cast("long").alias("n_removed"),
        F.md5(F.coalesce(F.array_join("_left", "\n"), F.lit("")).cast("binary")).alias("kept_md5"),
    )


#: DuckDB's SQL over the view ``documents``: plain word lists instead of hashes.
SQL = """
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, text, line_no, trim(lower(line), ' ') AS norm
  FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM docs)
), firsts AS (
  SELECT norm, min((doc_id, line_no)) AS pos, string_split(norm, ' ') AS w, row_number() OVER () AS id FROM lines WHERE norm <> '' GROUP BY norm
), v AS (
  SELECT id, pos, w, unnest(range(1, len(w) + 1)) AS i FROM firsts WHERE len(w) >= 5
), without AS (
  SELECT id, pos, len(w) AS n, i, md5(array_to_string(list_concat(w[:i - 1], w[i + 1:]), ' ')) AS key FROM v
), replaced AS (
  SELECT id FROM (SELECT id, pos, min(pos) OVER (PARTITION BY n, i, key) AS least FROM without) WHERE least < pos
), pairs AS (
  SELECT f.id AS short_id, f.pos AS short_at, x.id AS long_id, x.pos AS long_at
  FROM firsts f JOIN without x ON len(f.w) >= 5 AND x.n = len(f.w) + 1 AND x.key = md5(f.norm)
), dropped AS (
  SELECT id FROM replaced UNION SELECT short_id FROM pairs WHERE long_at < short_at UNION SELECT long_id FROM pairs WHERE short_at < long_at
), kept AS (SELECT pos FROM firsts WHERE id NOT IN (SELECT id FROM dropped)),
marked AS (
  SELECT l.doc_id, l.text, l.line_no, l.norm = '' OR k.pos IS NOT NULL AS stays FROM lines l LEFT JOIN kept k ON k.pos = (l.doc_id, l.line_no)
), done AS (
  SELECT doc_id, text, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_removed,
    md5(coalesce(array_to_string(list_transform(list(line_no ORDER BY line_no) FILTER (WHERE stays), lambda i: string_split(text, chr(10))[i + 1]), chr(10)), '')) AS kept_md5
  FROM marked GROUP BY doc_id, text
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(kept_md5, md5('')) AS kept_md5
FROM documents d LEFT JOIN done USING (doc_id, text)
"""
