"""A second load reads and lands what changed, and leaves what a load of everything would."""

from __future__ import annotations

import os

import pytest

from caremeld.sources import incremental as I
from caremeld.sources.landing import Source

HEADER = "PATIENT,CODE,DESCRIPTION,START"
SOURCES = [Source("synthea", "synthetic", "synthea"), Source("metabric", "study", "metabric")]


def put(base, path, lines, header=HEADER, time=None):
    file = f"{base}/{path}"
    os.makedirs(os.path.dirname(file), exist_ok=True)
    with open(file, "w") as out:
        out.write("\n".join([header, *lines]) + "\n")
    if time:
        os.utime(file, (time, time))


@pytest.fixture
def base(tmp_path):
    base = str(tmp_path / "in")
    for part in range(3):
        put(base, f"synthea/csv/conditions.csv/part-{part}.csv", [f"S{part},{i},\"two\nlines\",2010" for i in range(3)], time=1_000_000)
    put(base, "synthea/csv/patients.csv", ["S1,F", "S2,M"], "Id,GENDER", time=1_000_000)
    put(base, "metabric/study/data_clinical_patient.txt/part-9.csv", ["MB-1\t3"], "#comment\nPATIENT_ID\tAGE", time=1_000_000)
    return base


@pytest.fixture
def location(tmp_path):
    return str(tmp_path / "landed")


def load(spark, base, location, **options):
    lines = I.land_changes(spark, base, location, SOURCES, **options).collect()
    return {(r.path.rsplit("/", 1)[1], r.status) for r in lines}


def content(frame):
    return sorted(map(tuple, frame.collect()))


def everything(spark, base, tmp_path):
    """A load of all files into an empty place."""
    place = str(tmp_path / f"whole-{len(os.listdir(tmp_path))}")
    I.land_changes(spark, base, place, SOURCES)
    return {name: content(t) for name, t in I.landed_tables(spark, place).items()}


def test_second_load_lands_nothing_and_opens_nothing(spark, base, location, monkeypatch):
    assert len(load(spark, base, location)) == 5
    tables = {name: content(t) for name, t in I.landed_tables(spark, location).items()}
    assert len(tables["synthea__conditions"]) == 9 and tables["metabric__data_clinical_patient"] == [("MB-1", "3")]

    def refused(*_):
        raise AssertionError("a file was opened")

    monkeypatch.setattr(I, "checksums", refused)
    monkeypatch.setattr(I, "read_landed", refused)
    assert load(spark, base, location) == set()
    assert {name: content(t) for name, t in I.landed_tables(spark, location).items()} == tables


def test_new_changed_touched_and_removed(spark, base, location, tmp_path, monkeypatch):
    load(spark, base, location)
    folder = "synthea/csv/conditions.csv"
    put(base, f"{folder}/part-0.csv", ["S0,0,changed,2011"])
    put(base, f"{folder}/part-3.csv", ["S3,9,new,2012"])
    put(base, f"{folder}/part-1.csv", [f"S1,{i},\"two\nlines\",2010" for i in range(3)], time=2_000_000)
    os.remove(f"{base}/{folder}/part-2.csv")
    opened, read = [], I.read_landed
    monkeypatch.setattr(I, "read_landed", lambda spark, path, *how: opened.append(path) or read(spark, path, *how))
    found = load(spark, base, location)
    assert found == {("part-0.csv", "CHANGED"), ("part-1.csv", "TOUCHED"), ("part-2.csv", "REMOVED"), ("part-3.csv", "NEW")}
    assert sorted(p.rsplit("/", 1)[1] for p in opened) == ["part-0.csv", "part-3.csv"]
    rows = content(I.table(spark, location, "synthea__conditions"))
    assert ("S0", "0", "changed", "2011") in rows and len([r for r in rows if r[0] == "S0"]) == 1 and ("S3", "9", "new", "2012") in rows
    assert len([r for r in rows if r[0] == "S2"]) == 3  # reported, not lost
    assert load(spark, base, location) == set()


def test_equals_a_load_of_everything(spark, base, location, tmp_path):
    load(spark, base, location)
    folder = f"{base}/synthea/csv/conditions.csv"
    put(base, "synthea/csv/conditions.csv/part-1.csv", [])  # a file without a row any more
    os.remove(f"{folder}/part-0.csv")
    put(base, "synthea/csv/patients.csv", ["S1,F", "S3,\"a, \"\"b\"\"\""], "Id,GENDER")
    assert load(spark, base, location, drop_removed=True) == {("part-0.csv", "REMOVED"), ("part-1.csv", "CHANGED"), ("patients.csv", "CHANGED")}
    assert {name: content(t) for name, t in I.landed_tables(spark, location).items()} == everything(spark, base, tmp_path)
    put(base, "synthea/csv/conditions.csv/part-0.csv", ["S9,1,back,2013"])  # a removed file comes back
    assert load(spark, base, location) == {("part-0.csv", "NEW")}
    assert {name: content(t) for name, t in I.landed_tables(spark, location).items()} == everything(spark, base, tmp_path)


def test_a_load_that_was_cut_short_is_taken_up(spark, base, location, tmp_path, monkeypatch):
    load(spark, base, location)
    put(base, "synthea/csv/conditions.csv/part-0.csv", ["S0,0,changed,2011"])
    put(base, "synthea/csv/conditions.csv/part-7.csv", ["S7,0,new,2011"])
    read = I.read_landed

    def dies(spark, path, *how):
        if path.endswith("part-7.csv"):
            raise OSError("lost")
        return read(spark, path, *how)

    monkeypatch.setattr(I, "read_landed", dies)
    with pytest.raises(OSError):
        load(spark, base, location)
    monkeypatch.setattr(I, "read_landed", read)
    assert load(spark, base, location) == {("part-0.csv", "CHANGED"), ("part-7.csv", "NEW")}
    assert {name: content(t) for name, t in I.landed_tables(spark, location).items()} == everything(spark, base, tmp_path)


def test_times_need_not_be_trusted(spark, base, location):
    load(spark, base, location)
    put(base, "synthea/csv/patients.csv", ["S1,F", "S9,M"], "Id,GENDER", time=1_000_000)  # same size, same time
    assert load(spark, base, location) == set()
    assert ("patients.csv", "CHANGED") in load(spark, base, location, trust_times=False)


def test_other_columns_stop_the_load(spark, base, location):
    load(spark, base, location)
    put(base, "synthea/csv/conditions.csv/part-5.csv", ["1,S1"], "CODE,PATIENT")
    before = content(I.table(spark, location, "synthea__conditions"))
    with pytest.raises(ValueError, match="part-5.csv has the columns"):
        load(spark, base, location)
    assert content(I.table(spark, location, "synthea__conditions")) == before
    os.remove(f"{base}/synthea/csv/conditions.csv/part-5.csv")
    put(base, "synthea/csv/patients.csv", ["S1,F,x"], "Id,GENDER,MORE")  # the only file of its table may change them
    assert load(spark, base, location) == {("patients.csv", "CHANGED")}
    assert content(I.table(spark, location, "synthea__patients")) == [("S1", "F", "x")]


def test_checksum_does_not_show_the_splits(spark, tmp_path):
    lines = [f"line {i} é" for i in range(5000)]
    for name, text in (("a", lines), ("b", lines), ("c", [lines[1], lines[0], *lines[2:]]), ("d", lines[:-1])):
        (tmp_path / name).write_text("\n".join(text) + "\n")
    paths = [str(tmp_path / n) for n in "abcd"]
    sums = []
    for size in ("1g", "10k", "3k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        sums.append({r.path.rsplit("/", 1)[1]: r.checksum for r in I.checksums(spark, paths).collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sums[0] == sums[1] == sums[2]
    assert sums[0]["a"] == sums[0]["b"] and len(set(sums[0].values())) == 3
    h = 0
    hashes = [r[0] for r in spark.createDataFrame([(x,) for x in lines], "v string").selectExpr("xxhash64(v)").collect()]
    for x in hashes:
        h = (h * I.BASES[0] + x) % I.PRIME
    assert sums[0]["a"].split("-")[:2] == ["5000", str(h)]


def test_no_file(spark, tmp_path, location):
    os.makedirs(tmp_path / "in")
    assert load(spark, str(tmp_path / "in"), location) == set() and I.landed_tables(spark, location) == {}
