"""Line dedup on DataFrame functions only.

Lines become 128-bit hashes that are range-partitioned by (hash, document) and sorted by (hash, document, position),
so one pass over a partition meets the first occurrence of a line in each document before its repeats. What travels
are hashes and positions, never text; a line held by a third of all documents spreads over as many range partitions
as it needs, because the document is part of the range key. The answer for each document is a sparse bitmap of
64-line words: a word that keeps all of its lines is not stored.

Defined results
* A document is a distinct (doc_id, text) pair: exact repeats of a row count once and each gets its own output row.
* Null or empty text is one empty line; its key is empty, so it is never dropped while ``min_chars`` is 1 or more.
* A null doc_id is an id of its own. Extra input columns are ignored by :func:`keep_bitmaps` and kept by :func:`apply`.
* An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = 64


def lowered(bare: Column) -> Column:
    """A-Z lowered; other letters stay as they are."""
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, text and the two key columns (never null) that name a document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("t")).select(
        "doc_id", "t", F.coalesce("doc_id", F.lit(0)).cast("long").alias("k"), F.xxhash64("t", F.col("doc_id").isNull()).alias("f")
    )


def occurrences(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """k, f, pos and the line's hash (h1, h2) for every line whose key has ``min_chars`` code points."""
    lines = _identified(docs).select("k", "f", F.posexplode(F.split("t", "\n", -1)).alias("pos", "line"))
    bare = lines.select("k", "f", "pos", F.btrim("line", F.lit(SPACE)).alias("bare")).where(F.char_length("bare") >= min_chars)
    keyed = bare.select("k", "f", "pos", lowered(F.col("bare")).alias("key"))
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "k", "f", "pos")


def line_statistics(occurring: DataFrame) -> DataFrame:
    """h1, h2, n_docs, n_lines and the first place (k, f, pos) of each distinct line.

    The range partitions, sorted by (hash, document, position), serve the per-document step without a further shuffle:
    it streams by and lets the first occurrence through. The per-line step shuffles one partial row for each line and
    partition, so a hot line costs a row per partition.
    """
    key = ["h1", "h2", "k", "f"]
    within = Window.partitionBy(*key)
    ranged = occurring.repartitionByRange(*key).withColumns({"nth": F.row_number().over(within.orderBy("pos")), "n": F.count(F.lit(1)).over(within)})
    firsts = ranged.where("nth = 1")
    return firsts.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_lines"), F.min(F.struct("k", "f", "pos")).alias("first")
    )


def keep_bitmaps(docs: DataFrame, mode: str = "frequent", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """k, f and keep: array<struct<word int, bits long>>, for the documents that lose a line.

    mode "frequent": a line in ``min_docs`` or more documents loses all its occurrences. mode "first": every line
    keeps its first occurrence by (doc_id, text hash, position) and loses the others.
    """
    occurring = occurrences(docs, min_chars)
    # through ^ 0 the keys are new columns to the planner: the join then deals both sides itself, and what it deals it
    # can also split, so a line held by a third of all rows is joined by many tasks
    stats = line_statistics(occurring).withColumns({h: F.col(h).bitwiseXOR(F.lit(0).cast("long")) for h in ("h1", "h2")})
    if mode == "frequent":
        lost = occurring.join(stats.where(F.col("n_docs") >= min_docs).select("h1", "h2"), ["h1", "h2"])
    elif mode == "first":
        lost = occurring.join(stats.where(F.col("n_lines") > 1).select("h1", "h2", "first"), ["h1", "h2"]).where(
            F.struct("k", "f", "pos") != F.col("first")
        )
    else:
        raise ValueError(f"mode must be 'frequent' or 'first', not {mode!r}")
    bit = F.expr(f"shiftleft(1L, cast(pos % {WORD} as int))")
    words = (
        lost.select("k", "f", "pos")
        .repartition("k", "f")
        .groupBy("k", "f", F.expr(f"cast(pos div {WORD} as int)").alias("word"))
        .agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
    )
    return words.groupBy("k", "f").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def dropped_positions(keep: Column) -> Column:
    """The positions, in order, whose bit is not set in a sparse keep bitmap."""
    return F.flatten(
        F.transform(
            keep,
            lambda w: F.transform(
                F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.call_function("getbit", w["bits"], b) == 0),
                lambda b: w["word"] * WORD + b,
            ),
        )
    )


def _kept_runs(lines: Column, drops: Column) -> Column:
    """The lines outside ``drops``: slices between neighbouring dropped positions, linear in the number of lines."""
    before = lambda j: F.when(j == 0, F.lit(-1)).otherwise(F.get(drops, j - 1))
    after = lambda j: F.coalesce(F.get(drops, j), F.size(lines))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(drops)), lambda j: F.slice(lines, before(j) + 2, after(j) - before(j) - 1)))


def dedup_lines(docs: DataFrame, mode: str = "frequent", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped, keep (null: nothing lost) and kept_text for every row of ``docs``."""
    drops = keep_bitmaps(docs, mode, min_docs, min_chars).select("k", "f", "keep", dropped_positions(F.col("keep")).alias("drops"))
    split = _identified(docs).select("doc_id", "k", "f", F.split("t", "\n", -1).alias("lines"))
    joined = split.join(drops, ["k", "f"], "left")
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(_kept_runs(F.col("lines"), F.col("drops")))
    return joined.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), F.lit(0)).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
        "keep",
        F.array_join(kept, "\n").alias("kept_text"),
    )


def apply(docs: DataFrame, mode: str = "frequent", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with every dropped line taken out of text (a null text stays null) and n_chars, if there, set anew.

    All other columns pass through unchanged, whatever their names; documents stay even if no line is left.
    """
    names = docs.columns
    rest = [c for c in names if c not in ("text", "n_chars")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(
        F.struct(F.lit(True).alias("_"), *(F.col(f"`{c}`") for c in rest)).alias("row"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("k"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("f"),
        F.split("text", "\n", -1).alias("lines"),
    )
    drops = keep_bitmaps(docs, mode, min_docs, min_chars).select("k", "f", dropped_positions(F.col("keep")).alias("drops"))
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(_kept_runs(F.col("lines"), F.col("drops")))
    fresh = split.join(drops, ["k", "f"], "left").select("row", F.array_join(kept, "\n").alias("kept"))
    new = {"text": F.col("kept")}
    if "n_chars" in names:
        new["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return fresh.select(*((new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in names))


def keep_string(keep: Column) -> Column:
    """A sparse keep bitmap as text: word:bits in 16 hex digits, with commas between; empty if nothing is lost."""
    told = F.transform(keep, lambda w: F.concat(w["word"].cast("string"), F.lit(":"), F.lower(F.lpad(F.hex(w["bits"]), 16, "0"))))
    return F.coalesce(F.array_join(told, ","), F.lit(""))


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines of at least 1 code point in at least 10 documents go; one row a document, with its keep bitmap."""
    found = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"), keep_string(F.col("keep")).alias("keep"))


OP7_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l, md5(coalesce(text, '')) AS m FROM documents),
lines AS (SELECT r, doc_id, m, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS pos FROM d),
keyed AS (
  SELECT r, doc_id, m, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
hot AS (
  SELECT key FROM (SELECT DISTINCT key, doc_id, m FROM keyed WHERE length(key) >= 1) GROUP BY key HAVING count(*) >= 10),
marked AS (
  SELECT k.r, k.doc_id, k.pos, k.line, h.key IS NOT NULL AS gone FROM keyed k LEFT JOIN hot h ON k.key = h.key),
words AS (
  SELECT r, pos // 64 AS word, 18446744073709551615 - sum(CAST(1 AS HUGEINT) << CAST(pos % 64 AS INTEGER)) AS bits
  FROM marked WHERE gone GROUP BY r, pos // 64),
maps AS (SELECT r, string_agg(word || ':' || format('{:016x}', CAST(bits AS UBIGINT)), ',' ORDER BY word) AS keep FROM words GROUP BY r),
kept AS (
  SELECT r, any_value(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
  FROM marked GROUP BY r)
SELECT doc_id, n_lines, n_dropped, kept_sha256, coalesce(keep, '') AS keep FROM kept LEFT JOIN maps ON kept.r = maps.r
"""
