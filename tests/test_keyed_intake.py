"""The intake stream with keyed state."""

import os

import pytest

from cohortlink.streaming.keyed_intake import STATE_STORE, start_keyed_intake


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, STATE_STORE)
    yield spark
    spark.conf.set(key, old)


def test_only_new_and_changed_content(rocks, tmp_path):
    drop, got = tmp_path / "drop", []

    def put(day, name, text):
        os.makedirs(drop / day, exist_ok=True)
        (drop / day / name).write_text(text)

    def run():
        got.clear()
        q = start_keyed_intake(rocks, str(drop), str(tmp_path / "ckpt"), 2, lambda v, _: got.extend((r.file_name, r.STATUS, r.received_cols) for r in v.collect()))
        q.awaitTermination(180)
        return sorted(got)

    put("d1", "A 1.csv", "x,y\n1,2\n")
    put("d1", "b 2.csv", "x\n1\n")
    assert run() == [("A 1.csv", "WORKING_FILES", 2), ("b 2.csv", "REJECTED_FILES", 1)]
    put("d2", "a 1.CSV", "x,y\n1,2\n")  # the same content under another path and case
    put("d2", "b 2.csv", "x,y\n1,1\n")  # changed
    put("d2", "c 3.csv", "x,y\n")  # new
    assert run() == [("b 2.csv", "WORKING_FILES", 2), ("c 3.csv", "WORKING_FILES", 2)]  # a restarted stream knows what it judged
    put("d3", "b 2.csv", "x,y\n1,1\n")
    assert run() == []
    put("d4", "b 2.csv", "x\n1\n")  # back to what it was before: changed again
    assert run() == [("b 2.csv", "REJECTED_FILES", 1)]


def test_needs_the_state_store(spark, tmp_path):
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STATE_STORE:
        with pytest.raises(RuntimeError, match="providerClass"):
            start_keyed_intake(spark, str(tmp_path), str(tmp_path / "c"), 2, lambda v, b: None)
