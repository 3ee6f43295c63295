"""The older linking rule in factorised form.

The rule links every partner row to every vendor event that agrees on one of three legs (state id; agency and
local id; agency, names and birth date; each within a test). Rows that share an id make as many pairs as the
product of their numbers. Here a (leg, key) is a class with its partner members, its vendor members and their counts, which is
linear in the rows; pairs are made on demand (``expand``), and pair counts come from the counts alone:

    pairs found by the first leg that fits  =  sum over sets S of legs, with sign, of
    sum over keys of (partner rows with the key) x (vendor events with the key),   E(S)

    STATE_STID = E(1)    LOCAL = E(2) - E(12)    FUZZY = E(3) - E(13) - E(23) + E(123)
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LEGACY_MATCH_TYPES

TEST = ("test_name", "m_test_name")
# Per leg: (partner column, vendor column) besides the test.
LEGS = (
    (("state_id", "student_state_id"),),
    (("agency_code", "district_agency_code"), ("local_id", "student_id")),
    (("agency_code", "district_agency_code"), ("lname", "student_last_name"), ("fname", "student_first_name"), ("dob", "r_dob")),
)
PARTNER, VENDOR = 0, 1


def _values(legs: Sequence[int], side: int) -> list[Column]:
    """Key values of these legs as text, each column once."""
    pairs = list(dict.fromkeys([TEST] + [c for leg in legs for c in LEGS[leg]]))
    return [F.col(p[side]).cast("string") for p in pairs]


def _key(legs: Sequence[int], side: int) -> Column:
    """The key as an array of text, null where a value is missing (missing values never link)."""
    values = _values(legs, side)
    return F.when(reduce(lambda a, b: a & b, [v.isNotNull() for v in values]), F.array(*values))


def _members(rows: DataFrame, side: int, id_col: str) -> DataFrame:
    """One row per member and leg: (leg, key, side, id, earlier keys of the member)."""
    of = [F.struct(F.lit(leg).alias("leg"), _key([leg], side).alias("key")) for leg in range(len(LEGS))]
    keys = F.struct(*[_key([leg], side).alias(f"k{leg}") for leg in range(len(LEGS) - 1)])
    return rows.select(F.explode(F.array(*of)).alias("l"), F.lit("partner" if side == PARTNER else "vendor").alias("side"),
                       F.col(id_col).cast("string").alias("member_id"), keys.alias("own")).select("l.leg", "l.key", "side", "member_id", "own").where(F.col("key").isNotNull())


def classes(partner: DataFrame, vendor: DataFrame) -> DataFrame:
    """Members of the classes that have both sides: leg, key, side, member_id, own (the member's keys of
    the earlier legs), n_partner, n_vendor. One row per member and class."""
    v = vendor.withColumnRenamed("test_name", "m_test_name")
    both = _members(partner, PARTNER, "p_id").unionByName(_members(v, VENDOR, "m_id"))
    sizes = (both.groupBy("leg", "key").agg(F.count_if(F.col("side") == "partner").alias("n_partner"), F.count_if(F.col("side") == "vendor").alias("n_vendor"))
             .where("n_partner > 0 AND n_vendor > 0"))
    return both.join(sizes, ["leg", "key"])


def expand(members: DataFrame) -> DataFrame:
    """The pairs of the classes: (MATCH_TYPE, p_id, m_id), each from the first leg that fits."""
    p = members.where("side = 'partner'").select("leg", "key", F.col("member_id").alias("p_id"), F.col("own").alias("_p"))
    v = members.where("side = 'vendor'").select("leg", "key", F.col("member_id").alias("m_id"), F.col("own").alias("_v"))
    earlier = F.lit(False)
    for leg in range(len(LEGS) - 1):
        earlier = earlier | ((F.col("leg") > leg) & F.coalesce(F.col(f"_p.k{leg}") == F.col(f"_v.k{leg}"), F.lit(False)))
    label = F.element_at(F.array(*[F.lit(t) for t in LEGACY_MATCH_TYPES[:len(LEGS)]]), F.col("leg") + 1)
    return p.join(v, ["leg", "key"]).where(~earlier).select(label.alias("MATCH_TYPE"), "p_id", "m_id")


def _keyed_counts(rows: DataFrame, side: int, name: str) -> DataFrame:
    """(subset of legs, key, count): rows that have all keys of the subset."""
    subsets = [s for n in range(1, len(LEGS) + 1) for s in combinations(range(len(LEGS)), n)]
    of = F.array(*[F.struct(F.lit("".join(str(leg + 1) for leg in s)).alias("legs"), _key(s, side).alias("key")) for s in subsets])
    # values become text once: as the output of a generator they are not computed again in every subset
    cols = list(dict.fromkeys(p[side] for p in (TEST, *[c for leg in LEGS for c in leg])))
    rows = rows.select(F.inline(F.array(F.struct(*[F.col(c).cast("string").alias(c) for c in cols]))))
    return rows.select(F.explode(of).alias("l")).select("l.legs", "l.key").where(F.col("key").isNotNull()).groupBy("legs", "key").agg(F.count(F.lit(1)).alias(name))


def pair_counts(partner: DataFrame, vendor: DataFrame) -> DataFrame:
    """(MATCH_TYPE, test_name, pairs) of the older rule without making a pair."""
    v = vendor.withColumnRenamed("test_name", "m_test_name")
    p = _keyed_counts(partner, PARTNER, "_p")
    both = p.join(_keyed_counts(v, VENDOR, "_v"), ["legs", "key"])
    pairs = F.sum(F.col("_p").cast("decimal(19,0)") * F.col("_v").cast("decimal(19,0)"))
    e = both.groupBy(F.col("key")[0].alias("test_name"), "legs").agg(pairs.alias("e"))
    last = F.substring("legs", -1, 1).cast("int")
    signed = F.when(F.length("legs") % 2 == 1, F.col("e")).otherwise(-F.col("e"))
    label = F.element_at(F.array(*[F.lit(t) for t in LEGACY_MATCH_TYPES[:len(LEGS)]]), last)
    out = e.groupBy(label.alias("MATCH_TYPE"), "test_name").agg(F.sum(signed).alias("pairs"))
    return out.where("pairs <> 0")
