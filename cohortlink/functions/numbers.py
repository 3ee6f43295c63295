"""Number, grade and code column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ETHNIC_GROUP_CODES, GRADE_VARIANTS, SUBJECT_CODES
from .dates import _let
from .text import _c, try_cast, grade_text_norm, strip


def clean_int(c: Column | str) -> Column:
    """Partner integer rule: blank/non-numeric -> null; a fraction truncates toward zero
    (``4.7`` -> 4, ``-4.7`` -> -4); too long for bigint -> null. Never via double."""
    c = _c(c)
    return F.when(c.rlike("^[0-9]{1,18}$"), try_cast(c, "bigint")).otherwise(try_cast(_decimal(c), "bigint"))


def _decimal(c: Column | str) -> Column:
    """Text as decimal(38,10), null where it is no number. Texts with other characters than a number has
    are turned away first: a failed cast costs more than the rest of the row."""
    v = strip(c)
    return F.when(~v.rlike("[^0-9+.eE-]"), try_cast(v, "decimal(38,10)"))


def try_number(c: Column | str, sentinel: int | None = None) -> Column:
    """Vendor ``try_to_number``: decimal(38,0) (rounds half-up), optional sentinel for null."""
    v = try_cast(_c(c).cast("string"), "decimal(38,0)")
    return F.coalesce(v, F.lit(sentinel).cast("decimal(38,0)")) if sentinel is not None else v


def sentinel_to_null(c: Column | str, *sentinels: int) -> Column:
    c = _c(c)
    return F.when(~c.isin(*sentinels) | c.isNull(), c)


def _grade_lookup_map() -> Column:
    pairs = []
    for grade, variants in GRADE_VARIANTS.items():
        for v in variants:
            pairs.append((v.replace(" ", "").upper(), grade))
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(g)) for k, g in pairs))


def clean_grade(c: Column | str) -> Column:
    """Partner grade: a whole number in {1..12, 14} wins; else the spelling lookup on the
    normal form; else null. ``04``/``4.0`` -> 4, ``K`` -> 14, ``13``/``KG`` -> null."""
    c, valid = _c(c), sorted(GRADE_VARIANTS)

    def of_number(num: Column) -> Column:
        whole = try_cast(num, "int")
        return F.when((num == F.floor(num)) & whole.isin(*valid), whole)

    # of runs of digits the lookup knows none that is no valid number; texts with other characters than a number has go by the lookup alone
    run, known = try_cast(c, "int"), F.element_at(_grade_lookup_map(), grade_text_norm(c))
    return (F.when(c.rlike(r"^[0-9]{1,9}\z"), F.when(run.isin(*valid), run)).when(c.rlike(r"(?U)[^0-9+.eE\s-]"), known)
            .otherwise(F.coalesce(_let(_decimal(c), of_number), known)).cast("int"))


def grade_token_lookup(c: Column | str) -> Column:
    """Grade of one token of a study grade list (upper-cased, exact key lookup)."""
    return F.element_at(_grade_lookup_map(), _c(c)).cast("int")


def parse_grade_list(c: Column | str) -> Column:
    """Study grade list text -> sorted distinct array<int>.

    Upper-case, split on ``[,\\s;]+``; a token ``a-b`` is the inclusive range of the two
    looked-up ends (empty when the start is above the end, so ``K-2`` is empty); a single
    token is looked up; unknown tokens are ignored. Null/blank -> empty list."""
    text = F.upper(F.coalesce(_c(c).cast("string"), F.lit("")))
    tokens = F.filter(F.split(strip(text), r"(?U)[,\s;]+"), lambda t: t != "")
    empty = F.array().cast("array<int>")

    def token_grades(t: Column) -> Column:
        lo = grade_token_lookup(F.substring_index(t, "-", 1))
        hi = grade_token_lookup(F.regexp_extract(t, "^[^-]*-(.*)$", 1))
        rng = F.when(lo.isNotNull() & hi.isNotNull() & (lo <= hi), F.sequence(lo, hi))
        single = grade_token_lookup(t)
        return F.when(t.contains("-"), F.coalesce(rng, empty)).otherwise(
            F.when(single.isNotNull(), F.array(single)).otherwise(empty))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(tokens, token_grades))))


def simple_grade_list(c: Column | str) -> Column:
    """Older study grade list: whole numbers between commas, in order, blanks between commas skipped, null/blank text -> empty list.
    Anything else (a range, a word) makes the whole list null, where the older reader stopped with an error."""
    tokens = F.filter(F.transform(F.split(F.coalesce(_c(c).cast("string"), F.lit("")), ","), strip), lambda t: t != "")
    fits = F.forall(tokens, lambda t: t.rlike(r"^[+-]?[0-9]{1,9}$"))
    return F.when(fits, F.transform(tokens, lambda t: try_cast(t, "int")))


def vendor_grade(c: Column | str) -> Column:
    """Vendor grade recode: 13/16/17 -> 0, 14 -> -1, 1..12 unchanged, else null."""
    c = _c(c)
    return (F.when(c.isin(13, 16, 17), F.lit(0))
            .when(c == 14, F.lit(-1))
            .when(c.between(1, 12), c)
            .cast("int"))


def scale_code(c: Column | str) -> Column:
    """Measurement scale 12 (Spanish reading) reports as 7."""
    c = _c(c)
    return F.when(c == 12, F.lit(7)).otherwise(c)


def subject_name(c: Column | str) -> Column:
    """Subject of a vendor subject code (12 counts as 7); null for codes outside the list."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in SUBJECT_CODES.items()))
    return F.element_at(m, scale_code(c).cast("int"))


def ethnic_code(c: Column | str) -> Column:
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in ETHNIC_GROUP_CODES.items()))
    return F.element_at(m, _c(c)).cast("int")


def sex_code(partner: Column | str, vendor: Column | str) -> Column:
    """1 male / 0 female: partner value first, else vendor value."""
    def code(x: Column) -> Column:
        u = F.upper(x)
        return F.when(u.isin("M", "MALE", "1"), F.lit(1)).when(u.isin("F", "FEMALE", "0"), F.lit(0))
    return F.coalesce(code(_c(partner)), code(_c(vendor)))


def gender_fix(c: Column | str) -> Column:
    """Legacy gender text fix: Female/female -> F, Male/male -> M."""
    c = _c(c)
    return (F.when(c.isin("Female", "female"), F.lit("F"))
            .when(c.isin("Male", "male"), F.lit("M")).otherwise(c))


def pct(part: Column | str, whole: Column | str, digits: int) -> Column:
    """Percent with half-even rounding; null when the denominator is null or zero."""
    w = _c(whole)
    return F.bround(F.when(w != 0, _c(part) * 100.0 / w), digits)
