"""Stored results: routed files and the merge table."""

import os

import pytest
from pyspark.sql import functions as F

from cohortlink.operators import intake, routed
from cohortlink.operators.merge import MergeTable, VersionTaken
from cohortlink.sources.files import read_raw_cells


def _cells(df):
    return sorted((r.file_name, r.row_idx, r.cells) for r in df.where("read_error is null").collect())


@pytest.fixture
def partner_files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "A 1%.csv").write_bytes("h1,h2\n1,\"x, \"\"y\"\"\nz\"\n,é\n".encode())
    (folder / "b_2.CSV").write_bytes(b"h1\n\"\"\n5\n")
    (folder / "wide 3.csv").write_bytes(b"h1,h2,h3\n1,2,3\n" + b"".join(b"%d,a,b\n" % i for i in range(2, 40)))
    (folder / "bad 4.csv").write_bytes(b"h1\n1,2\n")
    return str(folder)


def _tree(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if not f.startswith("."))


def test_written_files_read_back(spark, tmp_path, partner_files):
    cells = read_raw_cells(spark, partner_files, null_tokens=("",))
    verdicts = intake.file_verdicts(cells, 2)
    lines, root = routed.routed_lines(cells, verdicts), str(tmp_path / "out")
    for _ in range(2):  # a rerun gives the same files
        assert routed.write_routed(lines, root) == 3
        assert _tree(root) == ["REJECTED_FILES/b_2.CSV", "REJECTED_FILES/wide 3.csv", "WORKING_FILES/A 1%.csv"]
        back = read_raw_cells(spark, f"{root}/WORKING_FILES", null_tokens=("",)).unionByName(read_raw_cells(spark, f"{root}/REJECTED_FILES", null_tokens=("",)))
        assert _cells(back) == _cells(cells)


def test_long_files_become_folders_of_parts(spark, tmp_path, partner_files):
    cells = read_raw_cells(spark, partner_files, null_tokens=("",))
    root = str(tmp_path / "out")
    routed.write_routed(routed.routed_lines(cells, intake.file_verdicts(cells, 2)), root, rows_per_part=10)
    parts = sorted(os.listdir(f"{root}/REJECTED_FILES/wide 3.csv"))
    parts = [p for p in parts if not p.startswith(".")]
    assert parts == [f"part-{i:05d}.csv" for i in range(4)]
    text = "".join(open(f"{root}/REJECTED_FILES/wide 3.csv/{p}").read() for p in parts)
    assert text == open(f"{partner_files}/wide 3.csv").read()


def test_failed_write_leaves_nothing(spark, tmp_path, partner_files):
    cells = read_raw_cells(spark, partner_files, null_tokens=("",))
    lines, root = routed.routed_lines(cells, intake.file_verdicts(cells, 2)), str(tmp_path / "out")
    routed.write_routed(lines, root)
    before = {f: open(os.path.join(root, f), "rb").read() for f in _tree(root)}
    broken = lines.withColumn("line", F.when(F.col("row_idx") == 30, F.raise_error(F.lit("lost"))).otherwise(F.concat("line", F.lit("!"))))
    with pytest.raises(Exception, match="lost"):
        routed.write_routed(broken, root)
    assert {f: open(os.path.join(root, f), "rb").read() for f in _tree(root)} == before
    assert not [n for n in os.listdir(root) if n.startswith("_staging")]


SCHEMA = "id long, name string, batch_file string"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_inserts_what_is_absent(spark, tmp_path):
    one = spark.createDataFrame([(1, "a", "f1"), (1, "a", "f1"), (2, None, "f1"), (None, None, "f1")], SCHEMA)
    two = spark.createDataFrame([(1, "a", "f2"), (2, None, "f2"), (None, None, "f2"), (2, "b", "f2"), (3, "c", "f2"), (3, "c", "f2"), (None, "b", "f2")], SCHEMA)
    table = MergeTable(spark, f"file://{tmp_path}/t", one.schema, ignore=["batch_file"], buckets=4)
    assert table.insert(one, "b1") == 4 and table.insert(one, "b1") == 0 and table.insert(one, "b1-again") == 0
    assert table.insert(two, "b2") == 4  # equal rows inside a batch all stay
    want = _rows(one) + [(2, "b", "f2"), (3, "c", "f2"), (3, "c", "f2"), (None, "b", "f2")]
    assert _rows(table.read()) == sorted(want, key=repr)
    other = MergeTable(spark, f"file://{tmp_path}/t")  # another session opens it by its files
    assert other.buckets == 4 and other.keys == ["id", "name"] and _rows(other.read()) == sorted(want, key=repr)
    assert other.insert(two.limit(0), "none") == 0
    with pytest.raises(Exception, match="columns missing"):
        other.insert(one.drop("name"), "x")
    with pytest.raises(ValueError):
        other.insert(one, "a'b")
    other.remove()
    assert not (tmp_path / "t").exists()


def test_broken_insert_is_invisible_and_repeatable(spark, tmp_path):
    one = spark.createDataFrame([(1, "a", "f"), (2, "b", "f")], SCHEMA)
    two = spark.createDataFrame([(3, "c", "f"), (1, "a", "f")], SCHEMA)
    table = MergeTable(spark, f"file://{tmp_path}/t", one.schema, buckets=2)
    table.insert(one, "b1")
    table.stage(two, "b2")  # the run ends before the commit
    assert _rows(table.read()) == _rows(one) == _rows(MergeTable(spark, f"file://{tmp_path}/t").read())
    assert table.insert(two.where("id = 1"), "b2") == 0  # the repeated batch is smaller: the leftovers go
    assert _rows(table.read()) == _rows(one)
    assert table.insert(two, "b3") == 1 and len(_rows(table.read())) == 3
    (tmp_path / "t" / "versions" / f"v-{table.version()[0] + 1:012d}").write_bytes(b'{"batches": [')  # a commit broken in the middle
    assert len(_rows(table.read())) == 3
    assert table.insert(spark.createDataFrame([(9, "z", "f")], SCHEMA), "b4") == 1 and len(_rows(table.read())) == 4


def test_two_writers(spark, tmp_path):
    one, two = (spark.createDataFrame(rows, SCHEMA) for rows in ([(1, "a", "f"), (2, "b", "f")], [(2, "b", "f"), (3, "c", "f")]))
    first = MergeTable(spark, f"file://{tmp_path}/t", one.schema, buckets=2)
    second = MergeTable(spark, f"file://{tmp_path}/t")
    number, batches = second.stage(two, "w2")
    assert first.insert(one, "w1") == 2
    with pytest.raises(VersionTaken):
        second._commit(number, {"batches": list(batches.items())})
    assert second.insert(two, "w2") == 1  # judged anew against what the first has committed
    assert [r[0] for r in _rows(second.read())] == [1, 2, 3]


def test_target_does_not_move(spark, tmp_path):
    rows = spark.range(4000).select("id", F.lit("n").alias("name"), F.lit("f").alias("batch_file")).unionByName(
        spark.range(2000).select(F.lit(7).cast("long").alias("id"), F.lit("hot").alias("name"), F.lit("f").alias("batch_file")))
    table = MergeTable(spark, f"file://{tmp_path}/t", rows.schema, buckets=8)
    assert table.insert(rows, "b1") == 6000 and table.read().count() == 6000
    stored = spark.table(table.name).select("_key", "_copies").collect()
    assert len(stored) == 4001 and max(r._copies for r in stored) == 2000  # a third of the batch is one stored row
    plan = table.absent(rows, ["b1"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    below = plan.splitlines()
    at = next(i for i, line in enumerate(below) if "_t_id" in line and "Project" in line)
    assert not any("Exchange" in line for line in below[at:])  # nothing between the join and the target's scan
