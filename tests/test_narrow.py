"""Rows packed for a shuffle come back as they were."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from cohortlink.operators.narrow import pack, unpack
from cohortlink.plans import roles

WORDS = ((("a", 36), ("n", 8), ("w", 19)), (("x", 40), ("t", 17)), (("s", 8), ("q", 20), ("d", 17), ("f", 16)))
SCHEMA = "key long, a long, n int, w short, x double, t timestamp, s string, q decimal(9,3), d date, f float"


def _back(df):
    packed = pack(df, ["key"], WORDS)
    return packed, unpack(packed.repartition(3, "key"), ["key"], WORDS, df.schema).select(*df.columns)


def test_every_value_comes_back(spark):
    rng = random.Random(5)
    day = dt.datetime(2020, 3, 1)
    odd = {1: [None, 0, -1, 2**36, 2**36 - 1, 2**63 - 1, -2**63], 2: [None, 0, 255, 256, -5, 2**31 - 1], 3: [None, 7, -7, 32767],
           4: [None, 0.0, 0.07, 84197.04, 0.1 + 0.2, 1e300, -1.5, float("nan"), float("inf"), 2.0**40 / 100, 0.005],
           5: [None, day, day.replace(hour=1), day.replace(microsecond=1), dt.datetime(1960, 1, 1), dt.datetime(2400, 1, 1)],
           6: [None, "", "N", "NO", "é", "ÿ", "Ā", " ", "😀"], 7: [None, Decimal("1.500"), Decimal("1.005"), Decimal("-2.000"), Decimal("999999.999")],
           8: [None, day.date(), dt.date(1960, 1, 1), dt.date(2400, 1, 1)], 9: [None, 0.1, 12.34, -0.5, 1e20]}
    usual = (0, 31521, 6, 17, 84197.04, day, "N", Decimal("17.250"), day.date(), 0.25)
    rows = [usual] + [(i, *usual[1:j], v, *usual[j + 1:]) for i, (j, v) in enumerate((j, v) for j, vs in odd.items() for v in vs)]
    rows += [(None, *(rng.choice(odd[j]) for j in range(1, 10))) for _ in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    packed, back = _back(df)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert back.dtypes == df.dtypes
    assert packed.where("key = 0 and _as_it_is is null").count() >= 1
    only = spark.createDataFrame([usual], SCHEMA)
    assert pack(only, ["key"], WORDS).where("_as_it_is is not null").count() == 0


def test_partner_records_of_odd_lines(spark, tmp_path):
    """Lines that travel as they are and lines in longs meet in one order; lines that repeat a number keep their order."""
    root = str(tmp_path)
    ship = dt.datetime(1997, 5, 4)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, " \
           "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    rows = [(1, 5, 1, 1, 1.0, 10.99, 0.02, 0.01, "N", "O", ship), (1, 4, 1, 1, 1.0, 20.123, 0.02, 0.01, "N", "O", ship),
            (1, 6, None, 1, 1.0, 30.5, 0.02, 0.01, "N", "O", ship), (1, -7, 1, 2, 1.0, 40.0, None, 0.01, "R", "O", ship.replace(hour=5)),
            (1, 2**40, 1, 2, 1e9, 1e13, 0.0, 0.01, None, "O", None)]
    spark.createDataFrame(rows, line).write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(1, 3, "O", 1.0, ship, "1-URGENT")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp, o_orderpriority string").write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(3, "Customer#3", 2, 1.0, "FURNITURE")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                          "c_mktsegment string").write.parquet(f"{root}/customer.parquet")
    wide = roles.partner_wide(spark, root)
    assert "_word_" in wide._jdf.queryExecution().optimizedPlan().toString()
    got = {r.RECORD_ID: (r.MATH_SS, r.MATH_TESTDATE, r.ELA_SS, r.ELA_PLCODE, r.ELA_TESTDATE) for r in wide.collect()}
    date = (ship.date() + dt.timedelta(days=roles.TEST_DATE_SHIFT_DAYS))
    usual = date.strftime("%m/%d/%Y")
    assert got == {"1": ("20", usual, "40", "R", date.isoformat()), "1/2": ("10", usual, " ", None, None), "1/3": ("30", usual, None, None, None)}
