"""The partner file reader: ranges of any size give the cells of the whole file."""

import os
import random

import pytest

from cohortlink.sources import files
from cohortlink.sources.files import DEFAULT_NULL_TOKENS, cut_files, file_listing, parse_csv_rows, read_raw_cells

PIECES = ['a', 'bb', '"q"', '"x\ny"', '"x\r\ny,z"', '"say ""hi"""', 'mid"dle', '"open', '', 'NA', 'é', '"é\n\nü"', ' ', '"a"b', '"",', "\u201d", "x\rz"]


def _file(rng, width, rows, rough):
    pieces = PIECES[:7] + PIECES[8:] if rough else [p for p in PIECES if p not in ('"open', '"",', "x\rz")]
    eol = rng.choice(["\n", "\r\n", "\n", "\r"])
    lines = [",".join(f"H{i}" if rng.random() < 0.9 else f'"H\n{i}"' for i in range(width))]
    for _ in range(rows):
        cells = ['"open' if rough and rng.random() < 0.03 else rng.choice(pieces) for _ in range(rng.choice([width] * 9 + [width - 1, width + rough]))]
        lines.append(",".join(cells).replace("\n", rng.choice(["\n", eol])) if rng.random() < 0.95 else "")
    text = rng.choice(["", "", "\n\n"]) + eol.join(lines) + rng.choice(["", eol])
    enc = rng.choice(["utf-8", "utf-8-sig", "cp1252", "utf-8", "mixed"])
    if enc == "mixed":
        return rng.choice([b"", files.BOM]) + text.encode("cp1252", "replace") + b"\x81" * rng.randrange(2)
    return text.encode(enc, "replace")


def _cells(df):
    return sorted((r.file_name, r.row_idx, r.cells, r.read_error) for r in df.collect())


@pytest.fixture
def split_size(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _folder(rng, folder, files_):
    """Files written to a folder, and the cells that the whole-file parser gives."""
    folder.mkdir()
    want = []
    for name, data in files_:
        (folder / name).write_bytes(data)
        want += parse_csv_rows(name, data, DEFAULT_NULL_TOKENS)
    return sorted(want)


def test_ranges_equal_whole_files(spark, tmp_path, split_size):
    rng = random.Random(11)
    made = [(f"file %2B {i} é.csv", _file(rng, rng.randrange(1, 5), rng.randrange(0, 40), i % 4 == 0) + b"\0" * (i == 19)) for i in range(28)]
    made += [("mark.csv", files.BOM + b'"a\nb",c\r\n\xff,1\r\n"x\n\n\ny",2'), ("empty.csv", b"")]  # not utf-8: the mark counts as text
    want = _folder(rng, tmp_path / "all", made)
    errors = {w[3].split()[0] for w in want if w[3]}
    assert {"row", "not", "empty"} <= errors and len({w[0] for w in want if not w[3]}) > 12
    for size in (1 << 20, 120):
        split_size(size)
        assert _cells(read_raw_cells(spark, str(tmp_path / "all"))) == want, size
    assert len(cut_files(spark, str(tmp_path / "all"))) > 15
    short = [(f"s{i}.csv", _file(rng, rng.randrange(1, 4), 5, i == 0)) for i in range(5)] + made[-2:]
    want = _folder(rng, tmp_path / "short", short)
    for size in (31, 5):
        split_size(size)
        assert _cells(read_raw_cells(spark, str(tmp_path / "short"))) == want, size


def test_no_task_holds_a_file(spark, tmp_path, split_size):
    """A file of many ranges: every task's ranges stay small, and rows that cross borders are whole."""
    rows = [("id", "text")] + [(str(i), "line one\nline two, " + "x" * (i % 90)) for i in range(3000)]
    data = "".join('%s,"%s"\n' % r for r in rows)
    (tmp_path / "long.csv").write_text(data)
    split_size(4096)
    cut = cut_files(spark, str(tmp_path))["long.csv"]
    assert len(cut.starts) > 50 and cut.inside.any() and cut.width == 2 and cut.error is None
    got = _cells(read_raw_cells(spark, str(tmp_path)))
    assert [(r[1], tuple(r[2])) for r in got] == list(enumerate(rows))
    longest = files.raw_lines(spark, str(tmp_path)).groupBy("start").agg({"line": "count"}).agg({"count(line)": "max"}).first()[0]
    assert longest < 200


def test_rows_carry_the_header_mask(spark, tmp_path, split_size):
    """The combine needs neither a join nor a second look at the header, also where the header crosses ranges."""
    from cohortlink.config import PROVENANCE_DROP_BEFORE_CHECK
    from cohortlink.operators import intake
    (tmp_path / "a 1.csv").write_text("X,agencycode ,Y\n" + "".join(f"{i},9,y{i}\n" for i in range(30)))
    (tmp_path / "b 2.csv").write_bytes('"X\nlong header \u00e9",AGENCY_CODE,"Y\n\nmore"\n1,2,"3\n\n4"\n5,6\n'.encode("cp1252"))
    (tmp_path / "c 3.csv").write_bytes(files.BOM + b"FilenameFromDistrict,X,Y\nf,1,2\n")
    (tmp_path / "d 4.csv").write_text("X,Y,Z\n1,2,3\n")
    (tmp_path / "e 5.csv").write_text("X,Y\n1,2,3\n")
    for size in (1 << 20, 9):
        split_size(size)
        cells = read_raw_cells(spark, str(tmp_path), drop=PROVENANCE_DROP_BEFORE_CHECK)
        got = {(r.file_name, r.row_idx): r.keep for r in cells.collect()}
        assert got[("a 1.csv", 30)] == [True, False, True] and got[("b 2.csv", 1)] == [True, False, True] == got[("b 2.csv", 0)]
        assert got[("c 3.csv", 1)] == [False, True, True] and got[("e 5.csv", 0)] is None
        combined = intake.combine_with_template(cells, ["X", "Y"])
        assert "Join" not in combined._jdf.queryExecution().optimizedPlan().toString()
        rows = sorted((tuple(r) for r in combined.collect()), key=repr)
        assert rows == sorted((tuple(r) for r in intake.combine_with_template(cells.drop("keep"), ["X", "Y"]).collect()), key=repr)
        assert ("1", "3\n\n4", "b 2.csv", "2") in rows and ("1", "2", "c 3.csv", "3") in rows and len(rows) == 33


def test_unclosed_quote_is_reported(spark, tmp_path, split_size, monkeypatch):
    (tmp_path / "open.csv").write_text("a,b\n1,2\n" + '3,"never closed\n' + "x,y\n" * 500)
    split_size(64)
    assert [r[1] for r in _cells(read_raw_cells(spark, str(tmp_path)))] == [0, 1, 2]
    import pandas as pd
    facts = pd.DataFrame([dict(file_name="f", start=64 * i, size=200, bytes=64, utf8=True, cp1252=True, nul=False,
                               shapes='[[2,0,false,1,[[0,2]],["a","b"],null],[0,1,true,0,[],null,["z"]]]') for i in range(4)])
    monkeypatch.setattr(files, "MAX_RECORD", 100)
    assert files.fold(facts)["error"].iloc[0] == "row 1 is longer than 100 bytes"


def test_changed_ranges_are_an_error(spark, tmp_path, split_size):
    (tmp_path / "a.csv").write_text("a,b\n" + "1,2\n" * 200)
    split_size(100)
    cells = read_raw_cells(spark, str(tmp_path))
    split_size(70)
    with pytest.raises(Exception, match="byte ranges changed"):
        cells.count()


def test_listing(spark, tmp_path):
    (tmp_path / "B 1.CSV").write_bytes(b"a\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    os.mkdir(tmp_path / "sub")
    got = [(r.file_name, r.name_key, r.length) for r in file_listing(spark, str(tmp_path)).orderBy("name_key").collect()]
    assert got == [("B 1.CSV", "b 1.csv", 2), ("empty.csv", "empty.csv", 0)]
    assert file_listing(spark, str(tmp_path / "none")).count() == 0
