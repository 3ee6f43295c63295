"""Record linkage of partner rows to vendor test events.

The linking rule joins on the test name AND (state id OR local id OR birth date), then
classifies each pair (phase 1: an id + both name keys + dob; phase 3: an id + dob; else
UNMATCHED) and keeps the best pair per vendor (student, test key).

Catalyst can only plan the OR as "test name + residual", i.e. every partner x vendor pair
of one test, and the test name has a handful of values. This module never builds those
pairs for the best-candidate result. Each phase becomes equi-join *lookups* against partner
rows pre-aggregated by that phase's key (``min(struct(p_id, ...))``, one row per key), so
every join is many-to-one (no fan-out) and the best pair
is a ``min`` aggregation (partial aggregation map-side, no window over a hot group):

    phase 1: (test, state, fname, lname, dob) and (test, local, fname, lname, dob)
    phase 3: (test, state, dob) and (test, local, dob)
    UNMATCHED: (test, state), (test, local), (test, dob)

For one vendor row the least (phase, p_id) over these lookups equals the least over all of
its candidate pairs: a phase lookup only returns pairs of that phase or better, and a
better pair always wins. Ties follow partner id, then event id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LEGACY_MATCH_TYPES, MATCH_PHASES
from ..functions.numbers import pct
from ..functions.text import id_key, name_key
from .sieve import key_bits, sift
from .skew import hot_hashes, key_hash, salted_join

KEY_COLS = ("test_name", "state_key", "local_key", "fname_key", "lname_key", "dob")

# (phase rank, key columns) of the best-candidate lookups.
PHASE_LOOKUPS = (
    (1, ("test_name", "state_key", "fname_key", "lname_key", "dob")),
    (1, ("test_name", "local_key", "fname_key", "lname_key", "dob")),
    (3, ("test_name", "state_key", "dob")),
    (3, ("test_name", "local_key", "dob")),
    (4, ("test_name", "state_key")),
    (4, ("test_name", "local_key")),
    (4, ("test_name", "dob")),
)


def phase_label(rank: Column) -> Column:
    return (F.when(rank == 1, MATCH_PHASES[0]).when(rank == 2, MATCH_PHASES[1])
            .when(rank == 3, MATCH_PHASES[2]).otherwise(MATCH_PHASES[3]))


def link_keys(test_name: Column, state_id: Column, local_id: Column, fname: Column, lname: Column,
              dob: Column, fold_first: bool = False) -> list[Column]:
    """Canonical key columns: blank-safe ids (trimmed text), name keys, birth date."""
    return [test_name.alias("test_name"), id_key(state_id).alias("state_key"), id_key(local_id).alias("local_key"),
            name_key(fname, fold_first).alias("fname_key"), name_key(lname, fold_first).alias("lname_key"),
            dob.alias("dob")]


def _not_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


# Filler for key fields a lookup does not use (both sides get the same constant).
_UNUSED_TEXT = "\u0000"
_UNUSED_DATE = "0001-01-01"


def _lookup_keys(include_dob_only: bool) -> Column:
    """Array of (lookup id, phase rank, key struct) per lookup, null where a key is missing
    on this row; unused key fields hold a constant so one struct type fits all."""
    items = []
    for i, (rank, keys) in enumerate(PHASE_LOOKUPS):
        if not include_dob_only and keys == ("test_name", "dob"):
            continue
        fields = []
        for k in KEY_COLS:
            if k in keys:
                fields.append(F.col(k).alias(k))
            elif k == "dob":
                fields.append(F.lit(_UNUSED_DATE).cast("date").alias(k))
            else:
                fields.append(F.lit(_UNUSED_TEXT).alias(k))
        entry = F.struct(F.lit(i).alias("lid"), F.lit(rank).alias("rank"), F.struct(*fields).alias("key"))
        items.append(F.when(_not_null(keys), entry))
    return F.array(*items)


def phase_candidates(partner: DataFrame, vendor: DataFrame, vendor_cols: Sequence[str],
                     partner_carry: Sequence[str] = (), include_dob_only: bool = True) -> DataFrame:
    """(vendor_cols..., phase_rank, p struct(p_id, carry...)) for every lookup hit.

    Both sides are exploded to one row per applicable lookup, the partner side is reduced
    to one row per (lookup, key), and a single equi-join on (lookup, key) finds the hits:
    one partner aggregation, one join, no per-lookup re-scan of either input. Vendor rows whose key no partner
    has are mostly sifted out before the shuffle. Vendor rows of a hot
    key are dealt to many tasks, with copies of its one partner row."""
    lk = _lookup_keys(include_dob_only)
    # Lookups are read by the sieve and by the join, out of one shuffle if both plans are alike. Spark gives all columns of the second
    # one's unpivot new ids, which makes it differ from one that passes columns on; with the empty union the first has new ids too.
    partner = partner.limit(0).union(partner)
    found = F.col("lid").isNotNull() & F.col("key").isNotNull()
    best = (partner.select(F.struct("p_id", *partner_carry).alias("p"), F.explode(lk).alias("l")).where(F.col("l").isNotNull())
            .select("p", F.col("l.lid").alias("lid"), F.col("l.key").alias("key"), F.col("l.rank").alias("rank")).where(found)
            .groupBy("lid", "key").agg(F.min("p").alias("p"), F.min("rank").alias("phase_rank")))
    # both results are looked at, so that the keys come out of the aggregation that the join reads, not of a second one
    bits = key_bits(best.where(F.col("p").isNotNull() & F.col("phase_rank").isNotNull()), key_hash("lid", "key"))
    v = vendor.select(*vendor_cols, F.explode(lk).alias("l")).where(F.col("l").isNotNull()).select(
        *vendor_cols, F.col("l.lid").alias("lid"), F.col("l.key").alias("key"))
    hot = hot_hashes(v, key_hash("lid", "key"))  # keys that many events share, such as a placeholder id
    return salted_join(sift(v, key_hash("lid", "key"), bits), best, ["lid", "key"], F.struct(*vendor_cols), hot).select(*vendor_cols, "phase_rank", "p")


def best_per(cands: DataFrame, group: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Best candidate per group: least (phase, p_id, tiebreak...)."""
    best = F.min(F.struct("phase_rank", "p", *tiebreak)).alias("b")
    return cands.groupBy(*group).agg(best).select(*group, "b.*")


def link_best(partner: DataFrame, vendor: DataFrame, partner_carry: Sequence[str] = (),
              vendor_carry: Sequence[str] = (), include_dob_only: bool = True, in_order: bool = False) -> DataFrame:
    """One row per vendor (student, test key) that has any candidate: MATCH_TYPE, ids and
    the carried columns of both sides. ``in_order``: candidates meet in ranges of (student, test key), the order of
    ``linked_sample``, which then sorts the result where it lies."""
    cands = phase_candidates(partner, vendor, ["m_id", "student_business_identifier", "test_key", *vendor_carry],
                             partner_carry, include_dob_only)
    if in_order:
        cands = cands.repartitionByRange(*_saved_order())
    best = best_per(cands, ["student_business_identifier", "test_key"], ["m_id", *vendor_carry])
    return best.select(phase_label(F.col("phase_rank")).alias("MATCH_TYPE"), "student_business_identifier",
                       "test_key", "m_id", "p.*", *vendor_carry)


def _saved_order() -> list[Column]:
    return [F.col("student_business_identifier").asc_nulls_last(), F.col("test_key").asc_nulls_last()]


def linked_sample(best: DataFrame) -> DataFrame:
    """The linked sample in the order in which it is saved: by student, then test key (a range
    partition, unless ``best`` lies in such ranges, and a sort per range)."""
    return best.orderBy(*_saved_order())


def link_per_event(partner: DataFrame, vendor: DataFrame, include_dob_only: bool = True) -> DataFrame:
    """Best phase and partner for every vendor event with a candidate."""
    vcols = ["m_id", "student_business_identifier", "test_key"]
    cands = phase_candidates(partner, vendor, vcols, (), include_dob_only)
    best = best_per(cands, vcols)
    return best.select("m_id", "student_business_identifier", "test_key",
                       phase_label(F.col("phase_rank")).alias("MATCH_TYPE"), F.col("p.p_id").alias("p_id"))


def _leg_keys(legs: Sequence[Sequence[str]]) -> Column:
    """Array of (leg id, key struct) per leg, null where a key column is missing;
    values as text (equal values give equal text), unused positions filled."""
    width = max(len(leg) for leg in legs)
    items = []
    for i, cols in enumerate(legs):
        fields = [F.col(c).cast("string").alias(f"k{j}") for j, c in enumerate(cols)]
        fields += [F.lit(_UNUSED_TEXT).alias(f"k{j}") for j in range(len(cols), width)]
        items.append(F.when(_not_null(cols), F.struct(F.lit(i).alias("leg"), F.struct(*fields).alias("key"))))
    return F.array(*items)


def equi_legs_pairs(partner: DataFrame, vendor: DataFrame, legs: Sequence[Sequence[tuple[str, str]]],
                    partner_cols: Sequence[str], vendor_cols: Sequence[str]) -> DataFrame:
    """Disjunctive join as one equi-join on (leg, key): each side is exploded to one row
    per leg whose keys are all non-null (SQL equality never matches null). A pair found by
    several legs is kept from the first that fits, which its own columns tell: no second
    shuffle. One scan of each side. Every matching pair is the defined result, so an id that
    many rows of both sides share gives as many pairs as their product."""
    p = partner.select(*partner_cols, F.explode(_leg_keys([[pk for pk, _ in leg] for leg in legs])).alias("l")).where(F.col("l").isNotNull())
    v = vendor.select(*vendor_cols, F.explode(_leg_keys([[vk for _, vk in leg] for leg in legs])).alias("l")).where(F.col("l").isNotNull())
    p = p.select(*partner_cols, F.col("l.leg").alias("leg"), F.col("l.key").alias("key"))
    v = v.select(*vendor_cols, F.col("l.leg").alias("leg"), F.col("l.key").alias("key"))

    def fits(leg: Sequence[tuple[str, str]]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(x).cast("string") == F.col(y).cast("string") for x, y in leg])

    first = F.coalesce(*[F.when(fits(leg), F.lit(i)) for i, leg in enumerate(legs)])
    return p.join(v, ["leg", "key"]).where(F.col("leg") == first).select(*partner_cols, *vendor_cols)


def link_legacy(partner: DataFrame, vendor: DataFrame) -> DataFrame:
    """Older rule: every pair joined by (test, state id) OR (test, agency, local id) OR
    (test, agency, last, first, dob), labelled STATE_STID / LOCAL / FUZZY (no best step;
    the UNMATCHED branch cannot occur)."""
    legs = [
        [("test_name", "test_name"), ("state_id", "student_state_id")],
        [("test_name", "test_name"), ("agency_code", "district_agency_code"), ("local_id", "student_id")],
        [("test_name", "test_name"), ("agency_code", "district_agency_code"), ("lname", "student_last_name"),
         ("fname", "student_first_name"), ("dob", "r_dob")],
    ]
    pcols = ["p_id", "test_name", "state_id", "local_id", "agency_code", "lname", "fname", "dob"]
    vcols = ["m_id", "student_business_identifier", "student_state_id", "student_id", "district_agency_code",
             "student_last_name", "student_first_name", "r_dob"]
    v = vendor.withColumnRenamed("test_name", "m_test_name")
    legs = [[(a, "m_test_name" if b == "test_name" else b) for a, b in leg] for leg in legs]
    pairs = equi_legs_pairs(partner, v, legs, pcols, ["m_test_name"] + vcols[1:] + ["m_id"])
    label = (F.when(F.col("student_state_id") == F.col("state_id"), LEGACY_MATCH_TYPES[0])
             .when((F.col("local_id") == F.col("student_id")) & (F.col("agency_code") == F.col("district_agency_code")),
                   LEGACY_MATCH_TYPES[1])
             .when((F.col("lname") == F.col("student_last_name")) & (F.col("fname") == F.col("student_first_name"))
                   & (F.col("dob") == F.col("r_dob")), LEGACY_MATCH_TYPES[2])
             .otherwise(LEGACY_MATCH_TYPES[3]))
    return pairs.select(label.alias("MATCH_TYPE"), "p_id", "m_id", "student_business_identifier", "test_name")


def match_rates(linked: DataFrame, grade_col: str) -> DataFrame:
    """Matches per (match type, grade) and their share of the grade's linked rows
    (one aggregation; the per-grade total is a window over the small aggregate)."""
    from pyspark.sql import Window
    counts = linked.groupBy("MATCH_TYPE", grade_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(grade_col))
    return counts.withColumn("grade_total", total).withColumn(
        "pct_of_grade", F.bround(F.col("n") * 100.0 / F.col("grade_total"), 2))


def merge_rates(partner: DataFrame, best: DataFrame, grade_col: str) -> DataFrame:
    """Per grade of the partner rows: how many there are, how many are the best candidate of some
    vendor event in a match phase (merged) or at all (potential), and the percentage merged."""
    merged = best.groupBy("p_id").agg(F.max(F.col("MATCH_TYPE") != MATCH_PHASES[3]).alias("_merged"))
    rows = partner.select("p_id", grade_col).join(merged, "p_id", "left")
    out = rows.groupBy(grade_col).agg(F.count(F.lit(1)).alias("partner_rows"), F.count("_merged").alias("potential_rows"),
                                      F.count_if("_merged").alias("merged_rows"))
    return out.withColumn("pct_merged", pct("merged_rows", "partner_rows", 2)).orderBy(F.col(grade_col).asc_nulls_last())
