"""Wide <-> long reshapes and column-layout helpers.

``wide_to_long`` resolves the score columns from the *schema* on the driver (names only),
then unpivots into columns: a single narrow scan of the wide table, no per-subject re-scan and no
union, and score columns that a query leaves out are neither made nor read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null


def score_columns(columns: Sequence[str], suffixes: Sequence[str]) -> dict[str, tuple[str, str]]:
    """Score columns with the (subject, SUFFIX) that their names state: a name that ends in an
    underscore and one of the suffixes (in any case) scores the subject named by what stands
    before; of several suffixes that fit, the shortest leaves the longest subject."""
    def ending(name: str) -> str | None:
        fits = [s for s in suffixes if len(name) > len(s) + 1 and name.upper().endswith(f"_{s.upper()}")]
        return min(fits, key=len, default=None)

    named = {c: ending(c) for c in columns}
    return {c: (c[:-len(s) - 1], s.upper()) for c, s in named.items() if s}


def wide_to_long(df: DataFrame, suffixes: Sequence[str], drop_rows_missing_ss: bool = False,
                 drop_rows_all_scores_missing: bool = True, subject_col: str = "SUBJECT") -> DataFrame:
    """One row per record x subject. Non-score columns repeat; a suffix a subject lacks is
    null; blank score text is null. Without score columns: one row per record, null subject."""
    suffixes = [s.upper() for s in suffixes]
    mapping = score_columns(df.columns, suffixes)
    keep = [c for c in df.columns if c not in mapping]
    keep_cols = [F.col(f"`{c}`") for c in keep]
    if not mapping:
        return df.select(*keep_cols, F.lit(None).cast("string").alias(subject_col),
                         *[F.lit(None).cast("string").alias(s) for s in suffixes])
    subjects = sorted({subj for subj, _ in mapping.values()})
    by_subject = {(subj, suf): c for c, (subj, suf) in mapping.items()}
    none, into = "__no_score", [f"__score_{k}" for k in range(len(suffixes))]

    def place(i: int, k: int) -> str:
        return f"__score_{i}_{k}" if (subjects[i], suffixes[k]) in by_subject else none

    def names(columns: Sequence[str]) -> str:
        return columns[0] if len(columns) == 1 else f"({', '.join(columns)})"

    def quoted(subj: str) -> str:
        return "`" + subj.replace("`", "``").replace("{", "{{").replace("}", "}}") + "`"

    cells = {place(i, k): by_subject.get((subj, suf)) for i, subj in enumerate(subjects) for k, suf in enumerate(suffixes)}
    wide = df.select(*keep_cols, F.lit(None).cast("string").alias(none), *[F.col(f"`{c}`").cast("string").alias(p) for p, c in cells.items() if c])
    rows = ", ".join(f"{names([place(i, k) for k in range(len(suffixes))])} AS {quoted(subj)}" for i, subj in enumerate(subjects))
    long = df.sparkSession.sql(f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS ({names(into)} FOR __subject IN ({rows}))", wide=wide)
    # blank -> null once per suffix after the unpivot (not once per subject inside it)
    long = long.select(*keep_cols, F.col("__subject").alias(subject_col), *[blank_to_null(F.col(p)).alias(suf) for p, suf in zip(into, suffixes)])
    if drop_rows_missing_ss and "SS" in suffixes:  # such a row has a score
        return long.where(F.col("SS").isNotNull())
    return long.dropna(how="all", subset=suffixes) if drop_rows_all_scores_missing else long


def place_clean_next_to_originals(df: DataFrame, marker: str = "_CLEAN") -> DataFrame:
    """Column order by (place of the original, cleaned after original): a column named like
    another one plus ``marker`` follows it, all others stay in place."""
    place = {c: i for i, c in enumerate(df.columns)}

    def key(c: str) -> tuple[int, bool]:
        original = c.removesuffix(marker)
        return (place[original], True) if original != c and original in place else (place[c], False)

    return df.select(*[F.col(f"`{c}`") for c in sorted(df.columns, key=key)])


def move_column(df: DataFrame, col: str, to: str = "end") -> DataFrame:
    cols = [c for c in df.columns if c != col]
    cols = [col] + cols if to == "first" else cols + [col]
    return df.select(*[F.col(f"`{c}`") for c in cols])


def keep_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in cols if c in df.columns])


def drop_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def reason_pivot(df: DataFrame, keys: Sequence[str], reason_col: str, reasons: Sequence[str],
                 value_name: str = "n") -> DataFrame:
    """Long (key, reason) counts -> one column per reason (explicit value list, so no extra
    job to discover the pivot values)."""
    return df.groupBy(*keys).pivot(reason_col, list(reasons)).agg(F.count(F.lit(1)))


def collect_sorted_sets(df: DataFrame, key: str, list_col: str, out: str) -> DataFrame:
    """Explode a list column and collect the sorted distinct union per key."""
    return (df.select(key, F.explode_outer(list_col).alias("_v"))
              .groupBy(key).agg(F.array_sort(F.collect_set("_v")).alias(out)))
