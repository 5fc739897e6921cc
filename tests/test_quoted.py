"""Quoted text read by splits, against the standard library's reader."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from refloom.schemas import text_schema
from refloom.sources.delimited import read_positional
from refloom.sources.quoted import quoted_records, read_quoted
from refloom.sources.sinks import read_written, write_dataset

rnd = random.Random(12)


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that records lie across their borders."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def cell():
    return rnd.choice(["", "a", "b c", 'say "hi"', "x,y", "one\ntwo", "\n\n", 'end"\n"', "ä€", "plain text of some length", '"', ",\n,", "long " * 30])


def written(rows, path, encoding="utf-8"):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows(rows)
    path.write_bytes(out.getvalue().encode(encoding))


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def want(rows):
    return sorted((tuple(None if x == "" else x for x in r) for r in rows if any(r)), key=repr)


def test_records_over_many_splits(spark, tmp_path, small_splits):
    files = {f"drug_{k}.txt": [[str(i), cell(), cell(), cell()] for i in range(rnd.randint(1, 60))] for k in range(4)}
    for name, rows in files.items():
        written(rows, tmp_path / name)
    schema = text_schema(["i", "a", "b", "c"])
    out = read_quoted(spark, f"{tmp_path}/drug_*.txt", schema)
    assert out.rdd.getNumPartitions() > 8
    assert got(out) == want(sum(files.values(), []))
    # Records carry their place: in order, they are the file.
    found = quoted_records(spark, f"{tmp_path}/drug_0.txt").orderBy("block", "n").collect()
    text = (tmp_path / "drug_0.txt").read_text()
    assert "\n".join(r["record"] for r in found) + "\n" == text and (found[0]["block"], found[0]["n"]) == (0, 0)
    assert len({r["block"] for r in found}) > 1


def test_a_field_longer_than_splits(spark, tmp_path, small_splits):
    rows = [["1", "x" * 150 + "\n" + "y" * 300 + "\n" * 40 + "z"], ["2", "\n".join(f"line {k}" for k in range(80))], ["3", "q"]]
    written(rows, tmp_path / "f.txt")
    assert got(read_quoted(spark, str(tmp_path / "f.txt"), text_schema(["i", "a"]))) == want(rows)


def test_stray_quotes_do_not_flip_the_rest(spark, tmp_path, small_splits):
    lines = ['1,5" pipe,a', '2,"b\nc",d', '3,6" x 7",e', "", '4,"f"g,h', "5,short", "6,a,b,surplus"] + [f'{k},"n\n{k}",t' for k in range(10, 60)]
    (tmp_path / "f.txt").write_text("\n".join(lines) + "\n")
    out = got(read_quoted(spark, str(tmp_path / "f.txt"), text_schema(["i", "a", "b"])))
    expected = [("1", '5" pipe', "a"), ("2", "b\nc", "d"), ("3", '6" x 7"', "e"), ("4", '"f"g', "h"), ("5", "short", None), ("6", "a", "b")]
    assert out == sorted(expected + [(str(k), f"n\n{k}", "t") for k in range(10, 60)], key=repr)
    one = spark.read.schema(text_schema(["i", "a", "b"])).options(quote='"', escape='"', multiLine=True).csv(str(tmp_path / "f.txt"))
    assert out == got(one)


def test_encoding_is_a_matter_of_the_file(spark, tmp_path, small_splits):
    for folder, encoding in (("a", "utf-8"), ("b", "latin-1")):
        (tmp_path / folder).mkdir()
        written([[str(k), "é" if k == 70 else "plain", "two\nlines"] for k in range(80)], tmp_path / folder / "drug.txt", encoding)
        out = read_positional(spark, {"x": f"{tmp_path}/{folder}"}, "drug", {"drug": ["i", "a", "b"]}, tag="t")
        assert got(out) == sorted([(str(k), "é" if k == 70 else "plain", "two\nlines", "x") for k in range(80)], key=repr)
    # One line that is not UTF-8 decides for the whole file, also for lines that would be valid by themselves.
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "drug.txt").write_bytes(b"1,\xc3\xa9,\n2,\xe9,\n")
    out = read_positional(spark, {"x": f"{tmp_path}/c"}, "drug", {"drug": ["i", "a", "b"]})
    assert got(out) == [("1", "Ã©", None), ("2", "é", None)]


@pytest.mark.parametrize("broken", [False, True])
def test_headers(spark, tmp_path, small_splits, broken):
    rows = [(str(k), "one\ntwo" if broken and k % 7 == 0 else "text", None) for k in range(60)]
    df = spark.createDataFrame(rows, "id string, note string, empty string")
    write_dataset(df.repartition(3), f"{tmp_path}/out", "tsv")
    back = read_written(spark, f"{tmp_path}/out", ["id", "note", "empty"], "tsv")
    assert got(back) == sorted(((i, t, "") for i, t, _ in rows), key=repr)
    with pytest.raises(Exception, match="eader"):
        read_written(spark, f"{tmp_path}/out", ["id", "other", "empty"], "tsv").collect()


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "e.txt").write_text("")
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert read_quoted(spark, str(tmp_path / "e.txt"), schema).count() == 0
    assert quoted_records(spark, str(tmp_path / "e.txt")).count() == 0
