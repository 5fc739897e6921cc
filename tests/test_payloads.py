"""Large JSON payloads read by splits, against the standard library's reader."""

import json
import random

import pytest

from refloom.sources.documents import read_results_json
from refloom.sources.payloads import payload_records

rnd = random.Random(31)


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


TEXTS = ["", "plain", 'a "quoted" word', "}{][", '"results": [', '\\', 'ends in \\', '\\"', "ä€\n\t", "} , {", '{"results": [{"x": 1}]}', "x" * 200]


def value(depth=0):
    kind = rnd.random()
    if depth < 3 and kind < 0.3:
        return {rnd.choice(["a", "b", "results", "x}"]): value(depth + 1) for _ in range(rnd.randint(0, 3))}
    if depth < 3 and kind < 0.5:
        return [value(depth + 1) for _ in range(rnd.randint(0, 3))]
    return rnd.choice([*TEXTS, 1, 2.5, None, True])


def document(n):
    records = [{"id": k, "note": rnd.choice(TEXTS), "more": value()} for k in range(n)]
    doc = {"meta": {"results": {"skip": 0}, "list": [{"results": [{"id": -1}]}]}, "results": records, "after": [{"id": -2}], "last": {"results": [{"id": -3}]}}
    return doc, records


def test_records_over_many_splits(spark, tmp_path, small_splits):
    want = []
    for k, (n, indent) in enumerate([(40, None), (25, 1), (0, None), (1, 2), (60, None), (3, None)]):
        doc, records = document(n)
        (tmp_path / f"{k}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=bool(k % 2)))
        want += records
    found = payload_records(spark, f"{tmp_path}/*.json")
    assert found.rdd.getNumPartitions() > 8
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, (json.loads(r["record"]) for r in found.collect()))) == sorted(map(key, want))
    got = read_results_json(spark, f"{tmp_path}/*.json", "id long, note string").collect()
    assert sorted((r["id"], r["note"]) for r in got) == sorted((r["id"], r["note"]) for r in want)


def test_a_record_longer_than_splits(spark, tmp_path, small_splits):
    records = [{"id": 1, "note": "y" * 2000, "deep": [{"k": {"j": i}} for i in range(200)]}, {"id": 2, "note": "}" * 500}, {"id": 3, "note": ""}]
    (tmp_path / "r.json").write_text(json.dumps({"results": records}))
    found = [json.loads(r["record"]) for r in payload_records(spark, str(tmp_path / "r.json")).collect()]
    assert sorted(found, key=lambda r: r["id"]) == records


@pytest.mark.parametrize("text", ["", "{}", "[]", '{"results": []}', '{"results": null, "x": [{"a": 1}]}', '{"results": {"a": [{"b": 1}]}}', "\n"])
def test_no_records(spark, tmp_path, text):
    (tmp_path / "r.json").write_text(text)
    assert payload_records(spark, str(tmp_path / "r.json")).count() == 0


def test_array_opened_late_and_closed(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"a": {"b": [1]}, "results" :\n [ {"id": 1}, {"id": 2, "results": [{"id": 9}]} ] , "z": [{"id": 3}]}')
    assert sorted(json.loads(r["record"])["id"] for r in payload_records(spark, str(tmp_path / "r.json")).collect()) == [1, 2]
