"""Text column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python's \s is Unicode-aware; Java needs (?U) for the same blank test.
BLANK_RE = r"(?U)^\s*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c: Column | str, dtype: str) -> Column:
    """Cast that yields null instead of raising under ANSI mode."""
    return _c(c).try_cast(dtype)


def apart(c: Column) -> Column:
    """The column unchanged, by way of a lambda. A projection with it is compiled in many small methods; without, a wide
    one becomes a single method of its stage, and the JVM leaves methods above 8,000 bytes uncompiled."""
    return F.get(F.transform(F.array(c), lambda x: x), F.lit(0))


def strip(c: Column | str) -> Column:
    """Unicode-aware strip of both ends (Spark's ``trim`` only removes spaces)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def _strip_often(c: Column) -> Column:
    """``strip`` for columns of whole tables: most texts begin and end with a printable ASCII character, which comparisons
    of bytes tell without the pattern. Its code is longer, so it is for projections that ``apart`` keeps in small methods."""
    return F.when(c.between("!", "~") & F.substring(c, -1, 1).between("!", "~"), c).otherwise(strip(c))


def blank_to_null(c: Column | str) -> Column:
    """Null for null, empty or all-whitespace text; else the text unchanged. Most texts begin with a
    printable ASCII character, which a comparison of bytes tells without the pattern."""
    c = _c(c)
    return F.when(c.between("!", "~") | ~c.rlike(BLANK_RE), c)


def is_nonblank(c: Column | str) -> Column:
    c = _c(c)
    return c.isNotNull() & (c.between("!", "~") | ~c.rlike(BLANK_RE))


def null_tokens_to_null(c: Column | str, tokens: tuple[str, ...]) -> Column:
    """Reader-style missing tokens (``NA``, ``null`` ...) become null; case-sensitive."""
    c = _c(c)
    toks = [t for t in tokens if t != ""]
    return F.when(~c.isin(toks), c) if toks else c


def normalize_strings(df: DataFrame, upper_headers: bool = True) -> DataFrame:
    """Every column to text; NaN/blank to null; headers upper-cased. One projection; every tenth column keeps
    it apart from the code of its stage, whichever columns a query leaves out."""
    cols = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        text = c.cast("string")
        name = f.name.strip().upper() if upper_headers else f.name
        clean = blank_to_null(text)
        # the lambda sees the plain column only: what is inside one is not in generated code
        cols.append((F.when(apart(text).isNotNull(), clean) if i % 10 == 0 else clean).alias(name))
    return df.select(*cols)


def rename_with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Header ``prefix + upper(trim(name))`` for every column."""
    return df.toDF(*[prefix + c.strip().upper() for c in df.columns])


def grade_text_norm(c: Column | str) -> Column:
    """Grade normal form: upper-case with all whitespace removed (``' Grade 04 '`` -> ``GRADE04``)."""
    return F.upper(F.regexp_replace(_c(c), r"(?U)\s+", ""))


def name_key(c: Column | str, fold_first: bool = False) -> Column:
    """Name match key. Default keeps the established order (drop non A-Z, *then* upper),
    which deletes lower-case letters; ``fold_first=True`` upper-cases first."""
    c = _c(c)
    if fold_first:
        return F.regexp_replace(F.upper(c), "[^A-Z]", "")
    return F.upper(F.regexp_replace(c, "[^A-Z]", ""))


def upper_trim(c: Column | str) -> Column:
    return F.upper(F.trim(_c(c)))


def id_key(c: Column | str) -> Column:
    """Blank-safe id key ``NULLIF(TRIM(x), '')`` on the text form."""
    return F.nullif(F.trim(_c(c).cast("string")), F.lit(""))


def file_name_of(path: Column | str) -> Column:
    """Last path element of a file path or URI."""
    return F.element_at(F.split(_c(path), "/"), -1)


def agency_code(name: Column | str) -> Column:
    """Digit run right before ``.csv``/``.xlsx``, preceded by start, space, ``_`` or ``-``.
    Leading zeros kept; null when absent (no fallback)."""
    code = F.regexp_extract(_c(name), r"(?i)(?:^|[ _-])([0-9]+)(?=\.(?:xlsx|csv)$)", 1)
    return F.nullif(code, F.lit(""))


def agency_code_legacy(name: Column | str) -> Column:
    """Legacy rule: the last digit run anywhere in the name, else null."""
    runs = F.regexp_extract_all(_c(name), F.lit("[0-9]+"), 0)
    return F.try_element_at(runs, F.lit(-1))


def is_edited_file(name: Column | str) -> Column:
    return _c(name).rlike(r"(?i)^edited_")


def strip_edited_prefix(name: Column | str) -> Column:
    return F.regexp_replace(_c(name), r"(?i)^edited_", "")


def list_to_text(c: Column | str) -> Column:
    """Render an int list like Python's ``str(list)``: ``[3, 4]``."""
    c = _c(c)
    return F.when(c.isNotNull(),
                  F.concat(F.lit("["), F.array_join(c.cast("array<string>"), ", "), F.lit("]")))


def sanitize_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Form for saving: list columns as text like ``[3, 4]``, text columns trimmed; the rest unchanged. One projection.
    With ``columns`` only these. A column's form depends on nothing else in its row, so those of a record or of the settings
    can be brought into it before the row is repeated by an unpivot or a join."""
    cols, strips = [], 0
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if columns is None or f.name in columns:
            if isinstance(f.dataType, T.ArrayType):
                c = list_to_text(c)
            elif isinstance(f.dataType, T.StringType):
                c, strips = _strip_often(c), strips + 1
                c = F.when(apart(F.col(f"`{f.name}`")).isNotNull(), c) if strips % 6 == 0 else c
        cols.append(c.alias(f.name))
    return df.select(*cols)


def timestamped_name(name: Column | str, when: Column, fmt: str = "yyyyMMdd_HHmmss") -> Column:
    """File name with ``_<time>`` before its extension (the last dot that does not begin the name)."""
    name = _c(name)
    ext = F.regexp_extract(name, r"(?s)[^.].*?(\.[^.]*)\z", 1)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(ext))
    return F.concat(stem, F.lit("_"), F.date_format(when, fmt), ext)
