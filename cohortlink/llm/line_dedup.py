"""Line dedup by a deletion-neighbourhood join.

A line goes if a line within one edit of it (insert, delete or replace a character; equal lines
included) occurs earlier, in (doc_id, line number) order of the input. The one-edit step takes
lines of ``MIN_CHARS`` characters or more. Shorter lines that are not blank take part in the
equal-line step from ``equal_chars`` characters on; below that they stay and remove nothing.

Lines within one edit have equal deletion variants. Emitting a variant per character of every
line would multiply the corpus, so variants are emitted from coarse to fine, each step only for
lines that shared a key with another text in the step before, which loses no pair:

* halves: the line without its first or second half (all distinct lines);
* blocks: the line without one of ``BLOCKS`` blocks;
* characters: the line without one character of such a block.

Keys are hashes of what is left, with the place of the gap and the longer line's length (a line
of length L signs for pairs whose longer line has L or L + 1 characters), so lines that share a
character key differ in that one place only and form a clique of at most one line per letter of
the alphabet, verified by edit distance. The earliest line of each clique decides.

DataFrame operations only. Equal lines are first reduced to one row, with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import HOT_SHARE, drop_shuffles, keep_plan, pick

MIN_CHARS = 20
BLOCKS = 16
LAST = (1 << 63) - 1


def _semi(rows: DataFrame, keys: DataFrame, key: str, total: int) -> DataFrame:
    """Rows whose key is in ``keys`` (key, n); keys above 1/HOT_SHARE of the rows are broadcast."""
    hot = F.broadcast(keys.where(F.col("n") * HOT_SHARE > total).select(key))  # HOT_SHARE rows at most
    return rows.join(hot, key, "left_semi").unionByName(
        rows.join(hot, key, "left_anti").join(keys.select(key), key, "left_semi"))


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key another line has too."""
    keys = keep_plan(rows.groupBy(key).agg(F.min("line").alias("_a"), F.max("line").alias("_z"), F.count("*").alias("n"))
                     .where("_a <> _z").select(key, "n"))
    total = keys.agg(F.sum("n")).first()[0] or 0
    return _semi(rows, keys, key, total)


def _lines(docs: DataFrame, equal_chars: int = MIN_CHARS) -> DataFrame:
    short = (F.col("len") >= equal_chars) & F.col("s").rlike(r"[^\x20\x09-\x0D]")
    return (docs.select("ord", F.posexplode(F.split("text", "\n", -1)).alias("pos", "s"))
            .withColumn("len", F.char_length("s")).where((F.col("len") >= MIN_CHARS) | short)
            .withColumn("line", F.xxhash64("s", "len")))


# A gap belongs to a pair whose longer line has r characters; keys hold what is left outside it.
_HALVES = """flatten(transform(array(len, len + 1), r -> array(
    xxhash64(r, 0, right(s, r - r div 2)), xxhash64(r, 1, left(s, r div 2)))))"""
_BLOCKS = """flatten(transform(array(len, len + 1), r -> transform(sequence(0, {p} - 1), i -> named_struct(
    'r', r, 'g0', cast(i * r div {p} as int), 'g1', cast((i + 1) * r div {p} as int)))))"""


def repeated_lines(docs: DataFrame, equal_chars: int = MIN_CHARS) -> DataFrame:
    """(ord, pos) of every line of ``docs`` (ord, text) that goes."""
    distinct = keep_plan(_lines(docs, equal_chars).withColumn("halves", F.when(F.col("len") >= MIN_CHARS, F.expr(_HALVES))).groupBy("line").agg(
        F.min(F.struct("ord", "pos")).alias("first"), F.count("*").alias("n"), F.first("halves").alias("halves")))
    drop_shuffles(docs.sparkSession)
    halves = distinct.select("line", F.explode("halves").alias("key"))
    near = keep_plan(_shared(halves, "key").select("line").distinct().join(distinct.select("line", "first"), "line"))
    drop_shuffles(docs.sparkSession)
    # texts of the lines that may have neighbours, from where each occurs first
    where = near.select("line", F.col("first.ord").alias("ord"), F.col("first.pos").alias("pos"))
    text = (_lines(docs.join(where.select("ord").distinct(), "ord", "left_semi")).select("line", "ord", "pos", "s", "len")
            .join(where, ["line", "ord", "pos"], "left_semi").dropDuplicates(["line"])
            .select("line", F.struct("ord", "pos").alias("first"), "s", "len"))
    blocks = keep_plan(
        text.select("line", "first", "s", "len", F.explode(F.expr(_BLOCKS.format(p=BLOCKS))).alias("b"))
        .select("line", "first", "len", "b.r",
                F.expr("xxhash64(b.r, b.g0, left(s, b.g0), right(s, b.r - b.g1))").alias("key"),
                F.expr("b.g1 - b.g0").alias("gap"),
                F.expr("substring(s, b.g0 + 1, len - (b.r - b.g1) - b.g0)").alias("inner")))
    letters = (_shared(blocks, "key").where("gap > 0")
               .select("line", "first", "inner", "key", F.explode(F.expr(
                   "transform(sequence(1, gap), i -> named_struct('i', i, 'rest', "
                   "if(r = len, left(inner, i - 1) || substring(inner, i + 1), inner)))")).alias("v"))
               .select("line", "first", "inner", F.xxhash64("key", "v.i", "v.rest").alias("key")))
    clique = Window.partitionBy("key")
    best = (letters.withColumn("least", F.min(F.struct("first", "inner")).over(clique))
            .where(F.expr("levenshtein(inner, least.inner, 1) between 0 and 1"))
            .groupBy("line").agg(F.min("least.first").alias("least")))
    drop_shuffles(docs.sparkSession)
    # what decides about a line: the earliest of its neighbours and itself
    rule = keep_plan(distinct.select("line", "first", "n").join(best, "line", "left")
                     .select("line", "n", F.col("first"), F.least(F.coalesce("least", "first"), "first").alias("least"))
                     .where("n > 1 or least < first"))
    total = distinct.agg(F.sum("n")).first()[0] or 0
    at = _lines(docs, equal_chars).select("line", "ord", "pos")
    hot = F.broadcast(rule.where(F.col("n") * HOT_SHARE > total))  # HOT_SHARE rows at most
    gone = F.struct("ord", "pos") > F.col("least")
    return (at.join(hot, "line").where(gone).select("ord", "pos").unionByName(
        at.join(hot.select("line"), "line", "left_anti").join(rule, "line").where(gone).select("ord", "pos")))


def dedup_lines(docs: DataFrame, drop_emptied: bool = False, equal_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with repeated lines cut out of ``text``.

    Null texts stay null with 0 lines, empty texts are one empty line. A null doc_id comes last.
    Rows with equal doc_id are one document: lines at the same place tie and share their fate.
    Other columns, whatever their names, come back as they are; the result has them in order
    and ends with the two counts (``dedup_n_lines``, ``dedup_n_removed``). An empty table gives
    no rows. ``drop_emptied`` drops rows that had lines and lost every non-blank one.
    """
    names = docs.columns
    at = names.index("text")
    cols = [f"_c{i}" for i in range(len(names))]
    rows = docs.toDF(*cols)
    text, doc = f"_c{at}", f"_c{names.index('doc_id')}"
    rows = rows.withColumn("ord", F.coalesce(F.col(doc).cast("long"), F.lit(LAST)))
    gone = (repeated_lines(rows.select("ord", F.col(text).alias("text")), equal_chars).distinct().groupBy("ord")
            .agg(F.collect_set("pos").alias("gone")))  # bounded by one document's lines
    lines = F.split(F.col(text), "\n", -1)
    rows = (rows.join(gone, "ord", "left").withColumn("_lines", lines)
            .withColumn("n_lines", F.coalesce(F.size("_lines"), F.lit(0)))
            .withColumn("n_lines", F.when(F.col("n_lines") < 0, 0).otherwise(F.col("n_lines")).cast("long"))
            .withColumn("gone", F.expr("filter(gone, p -> p < n_lines)"))
            .withColumn("n_removed", F.coalesce(F.size("gone"), F.lit(0)))
            .withColumn("n_removed", F.when(F.col("n_removed") < 0, 0).otherwise(F.col("n_removed")).cast("long")))
    kept = F.expr("array_join(transform(array_except(sequence(0, cast(n_lines as int) - 1), gone), p -> _lines[p]), '\n')")
    rows = rows.withColumn("_kept", F.when(F.col("n_removed") > 0, kept).otherwise(F.col(text)))
    if drop_emptied:
        rows = rows.where(~((F.col("n_removed") > 0) & (F.length(F.trim(F.translate("_kept", "\n\t\r", "   "))) == 0)))
    out = ["_kept" if c == text else c for c in cols]
    return rows.select(*out, "n_lines", "n_removed").toDF(*names, "dedup_n_lines", "dedup_n_removed")


def line_summary(docs: DataFrame, equal_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) for every row of ``docs``; see dedup_lines.

    ``kept_sha256`` is the lowercase hex digest of the kept text's UTF-8 bytes (null text: of none).
    """
    out = dedup_lines(pick(docs, "doc_id", "text"), equal_chars=equal_chars)
    return out.select("doc_id", F.col("dedup_n_lines").alias("n_lines"), F.col("dedup_n_removed").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
