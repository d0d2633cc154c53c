"""Raw files as received, and dimensions that refer to each other."""

import gzip
from graphlib import CycleError

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from almanac.errors import ValidationError
from almanac.operators.dimensions import Dimension, DimensionSet
from almanac.sources import files as FS
from almanac.sources import raw as RAW


def _drop(tmp_path, files):
    for name, content in files.items():
        path = tmp_path / "drop" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return str(tmp_path / "drop")


FILES = {"a.csv": b"x,y\n1,2\n", "sub/b.json": b'{"k": [1, 2]}', "sub/empty.bin": b"", "page.bin": bytes(range(256)) * 50,
         "utf.csv": "﻿y,x\r\né,\"1\"\r\n\r\n".encode()}


def test_bytes_and_names_survive(spark, tmp_path):
    drop, root = _drop(tmp_path, FILES), str(tmp_path / "raw")
    RAW.land_raw(RAW.received(spark, drop, under=drop), root, "d", "2024-01-01_05")
    got = {r.name: bytes(r.content) for r in RAW.read_raw(spark, root, "d", "2024-01-01_05").collect()}
    assert got == {n: c for n, c in FILES.items() if c}  # Spark lists no empty files
    only = RAW.received(spark, drop, pattern="*.csv")
    assert sorted(r.name for r in only.collect()) == ["a.csv", "utf.csv"]


def test_vintages_stand_apart(spark, tmp_path):
    root = str(tmp_path / "raw")
    files = lambda *rows: spark.createDataFrame([(n, bytearray(c)) for n, c in rows], "name string, content binary").withColumns(
        {"length": F.octet_length("content").cast("long"), "sha256": F.sha2("content", 256)})
    RAW.land_raw(files(("a", b"1"), ("b", b"22")), root, "d", "v1")
    RAW.land_raw(files(("a", b"3")), root, "d", "v2")
    RAW.land_raw(files(("a", b"4")), root, "e", "v1")
    RAW.land_raw(files(("c", b"555")), root, "d", "v1")  # again: replaced as a whole
    assert {tuple(r) for r in RAW.raw_vintages(spark, root).collect()} == {("d", "v1", 1, 3), ("d", "v2", 1, 1), ("e", "v1", 1, 1)}
    assert [(r.name, bytes(r.content)) for r in RAW.read_raw(spark, root, "d", "v1").collect()] == [("c", b"555")]
    for dataset, vintage in (("d", "v3"), ("f", "v1")):
        with pytest.raises(ValidationError, match="no raw files"):
            RAW.read_raw(spark, root, dataset, vintage)
    with pytest.raises(ValidationError, match="no raw files"):
        RAW.read_raw(spark, str(tmp_path / "nothing"), "d", "v1")
    with pytest.raises(ValidationError, match="files of one name"):
        RAW.land_raw(files(("a", b"1"), ("a", b"2")), root, "d", "v9")


def test_changed_bytes_fail_the_read(spark, tmp_path):
    root = str(tmp_path / "raw")
    bad = spark.createDataFrame([("a", bytearray(b"1"), 1, "0" * 64)], "name string, content binary, length long, sha256 string")
    RAW.land_raw(bad, root, "d", "v")
    with pytest.raises(PySparkException, match="stored bytes differ"):
        RAW.read_raw(spark, root, "d", "v").collect()


def test_decoding(spark, tmp_path):
    drop = _drop(tmp_path, {**FILES, "q.csv": b'y,"a b",x\n"1,5","say ""hi""", 7\n,,\n"",z,8\n', "latin.txt": "é\n".encode("latin-1")})
    files = RAW.received(spark, drop, under=drop)
    lines = RAW.raw_lines(files.where("name in ('a.csv', 'utf.csv', 'sub/empty.bin')"))
    assert sorted(tuple(r) for r in lines.collect()) == [
        ("a.csv", 0, "x,y"), ("a.csv", 1, "1,2"), ("utf.csv", 0, "y,x"), ("utf.csv", 1, 'é,"1"'), ("utf.csv", 2, "")]
    assert [r.line for r in RAW.raw_lines(files.where("name = 'latin.txt'"), "ISO-8859-1").collect()] == ["é"]
    rows = RAW.raw_csv(files.where("name like '%.csv'"), "x int, y string, `a b` string")
    assert sorted((tuple(r) for r in rows.collect()), key=str) == [
        ("a.csv", 1, 1, "2", None), ("q.csv", 1, 7, "1,5", 'say "hi"'), ("q.csv", 2, None, None, None), ("q.csv", 3, 8, None, "z"),
        ("utf.csv", 1, 1, "é", None)]
    with pytest.raises(PySparkException):
        RAW.raw_csv(files.where("name = 'a.csv'"), "x date").collect()


def test_headers_are_read_without_the_data(spark, tmp_path):
    """A file whose end can't be read still gives its header."""
    body = "k,v\n" + "".join(f"{i * 7919 % 100_003},{i * 104_729 % 1_000_003}\n" for i in range(200_000))
    broken = gzip.compress(body.encode())
    (tmp_path / "b.csv.gz").write_bytes(broken[:len(broken) // 2])
    (tmp_path / "a.csv").write_text("v,k\n1,2\n")
    (tmp_path / "c.csv").write_text("")
    layouts = FS._csv_layouts(spark, str(tmp_path), {})
    assert [(names, [f.rsplit("/", 1)[1] for f in files]) for names, files in layouts] == [(["k", "v"], ["b.csv.gz"]), (["v", "k"], ["a.csv"])]
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        FS.scan_csv(spark, str(tmp_path / "b.csv.gz"), "k int, v int").agg(F.sum("k")).collect()


def _dims(spark, tmp_path):
    return DimensionSet(spark, str(tmp_path / "dims"), [
        Dimension("place", ["name"], {"state": ("state", "name"), "within": ("place", "name")}),
        Dimension("state", ["name"], {"country": ("country", "name")}), Dimension("unit", ["name"]), Dimension("country", ["name"])])


def _frames(spark):
    return {"place": spark.createDataFrame([("p", "s", None), ("q", "s", "p"), ("r", None, "q")], "name string, state string, within string"),
            "state": spark.createDataFrame([("s", "c"), ("t", "c")], "name string, country string"),
            "country": spark.createDataFrame([("c",), ("d",)], "name string"), "unit": spark.createDataFrame([("people",)], "name string")}


def test_parents_load_first_and_children_go_first(spark, tmp_path):
    dims = _dims(spark, tmp_path)
    assert dims.order() == ["unit", "country", "state", "place"]
    assert dims.load(_frames(spark)) == ["unit", "country", "state", "place"]
    assert {r.name: r.id for r in dims.read("place").collect()} == {"p": 1, "q": 2, "r": 3}
    more = spark.createDataFrame([("a", "t", "r"), ("p", "t", None)], "name string, state string, within string")
    dims.load({"place": more})  # a stored key is left alone, a new one takes the next id
    assert {r.name: (r.id, r.state) for r in dims.read("place").collect()}["p"] == (1, "s")
    assert {r.name: r.id for r in dims.read("place").collect()}["a"] == 4
    assert dims.delete() == ["place", "state", "country", "unit"]
    assert all(dims.read(n).isEmpty() for n in dims.dimensions)
    again = dims.bootstrap(_frames(spark))
    assert sorted(r.id for r in again["place"].collect()) == [1, 2, 3]


def test_unknown_parents_are_refused(spark, tmp_path):
    dims = _dims(spark, tmp_path)
    frames = _frames(spark)
    with pytest.raises(ValidationError, match=r"state.country refers to country rows that don't exist: \['x'\]"):
        dims.load({**frames, "state": spark.createDataFrame([("s", "x")], "name string, country string")})
    assert dims.table("country").exists() and not dims.table("state").exists() and not dims.table("place").exists()
    with pytest.raises(ValidationError, match="place.within"):
        dims.load({**frames, "place": spark.createDataFrame([("p", "s", "nowhere")], "name string, state string, within string")})
    with pytest.raises(ValidationError, match="unknown ones"):
        DimensionSet(spark, "x", [Dimension("a", ["name"], {"b": ("b", "name")})])
    with pytest.raises(CycleError):
        DimensionSet(spark, "x", [Dimension("a", ["name"], {"b": ("b", "name")}), Dimension("b", ["name"], {"a": ("a", "name")})]).order()


def test_deletes_are_refused_while_rows_refer(spark, tmp_path):
    dims = _dims(spark, tmp_path)
    dims.load(_frames(spark))
    facts = spark.createDataFrame([(1, 2), (2, None)], "place_id int, unit_id int")
    with pytest.raises(ValidationError, match="place can't be deleted: facts"):
        dims.delete(facts={"place": [(facts, "place_id", "id")]})
    with pytest.raises(ValidationError, match="state can't be deleted: place"):
        dims.delete(["state"])
    assert dims.read("place").count() == 3 and dims.read("state").count() == 2
    assert dims.delete(["unit"], facts={"unit": [(facts, "unit_id", "id")]}) == ["unit"]  # id 2 is no unit's
    assert dims.delete(["state", "place"]) == ["place", "state"] and dims.read("country").count() == 2
    with pytest.raises(ValidationError):
        dims.bootstrap(_frames(spark), delete_first=True, facts={"country": [(facts.where("place_id = 1"), "place_id", "id")]})
    assert set(dims.bootstrap(_frames(spark), delete_first=True)) == set(dims.dimensions)
