"""Secret scan: candidate strings and a random forest that removes false positives.

Candidates are words of at least ``LEAST`` characters with a digit, cut into the name and value
of an assignment where they are one, and, whatever their length or digits, the values assigned to
a credential name or standing right after one (``=``, ``:``, ``is`` may stand between). A forest over length, character classes and the transitions
between them, coverage by the corpus's most frequent words, marks of paths and addresses, and
neighbouring words decides which are secrets. It is trained from labelled findings, a table
(features as made here, and ``label``); where none is given, findings label themselves by
formats that leave no doubt (issued key prefixes, values assigned to credential names; mail
addresses, plain numbers, links, plain words of prose), and the forest, which does not see those rules, decides about
all. DataFrame operations and Spark's own forest only.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import keep_plan, pick

LEAST = 12
DICTIONARY = 2000  # most frequent words of the corpus that count as its dictionary
TRAIN_ROWS = 4000  # labelled findings per class that a fit uses at most, by hash
TREES, DEPTH = 20, 6

# Credential names, names of harmless values, issued key prefixes.
CREDENTIAL = "pass(word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|private_?key|auth|bearer|credential|client_?secret"
HARMLESS = "http|https|url|uri|path|file|version|phone|tel|call|mail|email|isbn|doi|card|account|order|invoice|commit|sha|hash|uuid|guid"
ISSUED = "^(AKIA[A-Z0-9]{16}|ASIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]*)$"
NAMED = f"(^|[^a-z])({CREDENTIAL})([^a-z]|$)"  # in lower case
AFTER = f"(^|[^a-z])({CREDENTIAL})[^a-z0-9]*$"  # the word before, in lower case
BETWEEN = "^([=:>-]+|is)$"
NUMERIC = ("len", "digits", "upper", "lower", "other", "runs", "distinct", "vowel_turns", "covered", "slashes", "dots",
           "dashes", "at", "link", "assigned", "quoted", "near_credential", "near_harmless", "left_len", "right_len")


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The ``size`` words of 4 to 16 letters that most documents have."""
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("w")).where("length(w) between 4 and 16")
    top = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(size)
    return [r.w for r in top.collect()]  # ``size`` words at most


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, name, value, left, right, quoted): candidate strings with their neighbours."""
    after = (f"((i > 0 and lower(w[i - 1]) rlike '{AFTER}') or "
             f"(i > 1 and lower(w[i - 1]) rlike '{BETWEEN}' and lower(w[i - 2]) rlike '{AFTER}'))")
    return (docs.select("doc_id", F.split("text", r"[ \t\n\x0B\f\r]+").alias("w"), F.lower("text").rlike(CREDENTIAL).alias("any"))
            .withColumn("pos", F.explode(F.expr(
                f"filter(sequence(0, size(w) - 1), i -> (length(w[i]) >= {LEAST} and w[i] rlike '[0-9]') or "
                f"(any and ((w[i] rlike '[=:]' and lower(w[i]) rlike '{NAMED}') or {after})))")))
            .select("doc_id", "pos", F.expr("w[pos]").alias("raw"), F.expr(f"any and {after.replace('i ', 'pos ')}").alias("after"),
                    F.expr("lower(concat_ws(' ', if(pos > 2, w[pos - 3], ''), if(pos > 1, w[pos - 2], ''), if(pos > 0, w[pos - 1], '')))").alias("left"),
                    F.expr("lower(coalesce(get(w, pos + 1), ''))").alias("right"))
            .withColumn("bare", F.regexp_replace("raw", r"""^[\p{Punct}&&[^+/_=-]]+|[\p{Punct}&&[^+/_=-]]+$""", ""))
            .withColumn("name", F.regexp_extract("bare", r"^-*([A-Za-z_][A-Za-z0-9_.-]{0,40})[\"']?[=:]+[\"']?[^\s]", 1))
            .withColumn("value", F.when(F.col("name") != "", F.regexp_replace(
                F.expr("substring(bare, locate(name, bare) + length(name))"), "^[=:\"']+", "")).otherwise(F.col("bare")))
            .withColumn("quoted", F.col("raw").rlike("[\"'`]").cast("int"))
            .where((F.length("raw") >= LEAST) & F.col("raw").rlike("[0-9]") & (F.length("value") >= LEAST)
                   | F.col("value").rlike(r"[\p{L}\p{N}]") & ~F.lower("value").rlike(BETWEEN)
                   & (F.col("after") | F.lower("name").rlike(NAMED)))
            .select("doc_id", "pos", "name", "value", "left", "right", "quoted"))


def _count(value: str | Column, pattern: str) -> Column:
    return F.regexp_count(F.col(value) if isinstance(value, str) else value, F.lit(pattern)).cast("double")


def features(found: DataFrame, known: list[str]) -> DataFrame:
    """``found`` with the columns of NUMERIC; ``known`` is the dictionary."""
    n = F.length("value").cast("double")
    near = F.concat_ws(" ", "left", F.lower("name"))
    runs = F.expr("regexp_extract_all(lower(value), '[a-z]{4,}', 0)")
    return (found
            .withColumn("_hit", F.aggregate(F.filter(runs, lambda r: F.exists(F.lit(known or [""]), lambda k: (k != "") & F.contains(r, k))),
                                            F.lit(0.0), lambda a, r: a + F.length(r)))
            .withColumns({
                "len": n, "digits": _count("value", "[0-9]") / n, "upper": _count("value", "[A-Z]") / n,
                "lower": _count("value", "[a-z]") / n, "other": _count("value", "[^A-Za-z0-9]") / n,
                "runs": _count("value", "[0-9]+|[A-Z]+|[a-z]+|[^A-Za-z0-9]+") / n,
                "distinct": F.size(F.array_distinct(F.split("value", ""))) / n,
                "vowel_turns": _count(F.lower("value"), "[aeiou][b-df-hj-np-tv-z]") / n,
                "covered": F.col("_hit") / n, "slashes": _count("value", "/"), "dots": _count("value", r"\."),
                "dashes": _count("value", "[-_]"), "at": _count("value", "@"),
                "link": F.col("value").rlike("(?i)^(https?|ftp|file)|www\\.|\\.(com|org|net|html?|png|jpg|py|js|txt)$").cast("double"),
                "assigned": ((F.col("name") != "") | F.col("left").rlike("[=:]$")).cast("double"),
                "quoted": F.col("quoted").cast("double"),
                "near_credential": near.rlike(f"(^|[^a-z])({CREDENTIAL})([^a-z]|$)").cast("double"),
                "near_harmless": near.rlike(f"(^|[^a-z])({HARMLESS})([^a-z]|$)").cast("double"),
                "left_len": F.length("left").cast("double"), "right_len": F.length("right").cast("double")})
            .drop("_hit"))


def self_labelled(found: DataFrame) -> DataFrame:
    """The findings whose format leaves no doubt, with ``label`` 1 (secret) or 0."""
    near = F.concat_ws(" ", "left", F.lower("name"))
    sure = F.col("value").rlike(ISSUED) | (
        near.rlike(f"(^|[^a-z])({CREDENTIAL})\\s*[=:]*\\s*$") & F.col("value").rlike("^[A-Za-z0-9+/_=-]{16,}$")
        & ((F.col("name") != "") | F.col("left").rlike("[=:]$")))
    harmless = (F.col("value").rlike(r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$") | F.col("value").rlike(r"^[0-9.,:/+()-]+$")
                | F.col("value").rlike("^(https?|ftp)")
                | ((F.col("name") == "") & ~F.col("left").rlike("[=:]$") & F.col("value").rlike("^[A-Z]?[a-z]+$")))
    return found.withColumn("label", F.when(sure, 1.0).when(harmless, 0.0)).where("label is not null")


def scan(docs: DataFrame, labelled: DataFrame | None = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, pos, name, value, probability, is_secret) for every candidate of (doc_id, text).

    ``pos`` is the word's number in its text, from 0 (split at white space; a leading gap counts
    as an empty word). Null and empty texts have no candidates; repeated rows repeat theirs.
    Without labelled findings of both classes the probability is that of the only class seen, or
    0.5. An empty table gives no rows; other columns are ignored.
    """
    docs = pick(docs, "doc_id", "text")
    found = keep_plan(features(candidates(docs), dictionary(docs)))
    labelled = self_labelled(found) if labelled is None else labelled
    picked = []
    for y in (0.0, 1.0):
        picked.append(labelled.where(F.col("label") == y).orderBy(F.xxhash64("value", "left"), "value", "doc_id", "pos").limit(rows))
    train = keep_plan(picked[0].unionByName(picked[1]).select(*NUMERIC, "label").coalesce(1))  # 2 * rows at most
    seen = [r.label for r in train.select("label").distinct().collect()]
    if len(seen) < 2:
        out = found.withColumn("probability", F.lit(float(seen[0]) if seen else 0.5))
    else:
        vector = VectorAssembler(inputCols=list(NUMERIC), outputCol="_x")
        forest = RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7,
                                        probabilityCol="_p", predictionCol="_y", rawPredictionCol="_r").fit(vector.transform(train))
        out = forest.transform(vector.transform(found)).withColumn("probability", vector_to_array("_p")[1])
    return out.select("doc_id", "pos", "name", "value", "probability", (F.col("probability") >= 0.5).cast("int").alias("is_secret"))
