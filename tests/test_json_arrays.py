"""Arrays read by byte ranges against the json module."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lotframe.sources import json_arrays, json_records


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few bytes, so that records, strings and escapes cross their borders."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def values(rng, n):
    text = lambda: "".join(rng.choice(['}', '{', '[', ']', '"', "\\", ",", " ", "ä", "漢", "\n", "a"]) for _ in range(rng.randint(0, 9)))
    value = lambda deep: rng.choice([text, lambda: rng.randint(-5, 5), lambda: None, lambda: True, lambda: {text(): value(deep - 1) for _ in range(rng.randint(0, 3))} if deep else {}, lambda: [value(deep - 1) for _ in range(rng.randint(0, 3))] if deep else []])()
    return [value(3) if rng.random() < 0.3 else {"k": i, text(): value(2)} for i in range(n)]


def scanned(spark, *paths, **options):
    rows = json_records.scan_records(spark, *paths, **options).select("_file", "_pos", F.to_json("record").alias("r")).collect()
    return sorted((r[0], r[1], json.dumps(json.loads(r[2]), sort_keys=True)) for r in rows)


def wanted(*lists):
    return sorted((i, k, json.dumps(v, sort_keys=True)) for i, some in enumerate(lists) for k, v in enumerate(some or ()))


@pytest.mark.parametrize("seed", range(2))
def test_arrays_of_anything(spark, small_ranges, tmp_path, seed):
    rng = random.Random(seed)
    lists = [values(rng, n) for n in (0, 1, 3, 60)] + [[1, "a", [2]], [[{"a": 1}, {}], 5, {}, 6], [{}] * 70, [{"long": "x" * 1700}, {"b": "}" * 900}, 1]]
    dumps = [lambda v: json.dumps(v), lambda v: json.dumps(v, indent=4, ensure_ascii=False), lambda v: "\n " + json.dumps(v, separators=(",", ":")) + "\n\n"]
    paths = []
    for i, some in enumerate(lists):
        path = tmp_path / f"a {i}+%.json"
        path.write_text(dumps[(i + seed) % 3](some), encoding="utf-8")
        paths.append(str(path))
    assert scanned(spark, *paths) == wanted(*lists)


BAD = ["", " ", "{}", "nope", '{"a": [1]}', "[{}", "[{},]", "[{}{}]", "[,{}]", "[{},,{}]", "[{}] x", "[{}]]", "[[{}]", '[{"a": "}]', "[{}]}", "[{} 1]", "[{}, nope]", "[{}],[{}]", "[1 2]", "[{}, 1,]", "[]]", "]["]


def test_what_is_no_array(spark, small_ranges, tmp_path):
    good = tmp_path / "good.json"
    good.write_text('[{"a": 1}, {"b": "} ]"}]')
    paths = []
    for i, text in enumerate(BAD):
        (tmp_path / f"{i}.json").write_text(text + " " * 400 * (i % 2))
        paths.append(str(tmp_path / f"{i}.json"))
    assert {r[0] for r in scanned(spark, *paths, str(good))} == {len(BAD)}
    with pytest.raises(ValueError):
        json_records.scan_records(spark, str(good), *paths[2:4], strict=True)
    with pytest.raises(ValueError):
        json_records.scan_records(spark, *paths[:3])
    assert json_records.scan_records(spark, paths[3]).count() == 0
    assert len(scanned(spark, str(good), strict=True)) == 2


def test_a_byte_order_mark_and_missing_files(spark, tmp_path):
    (tmp_path / "m.json").write_bytes(b'\xef\xbb\xbf[{"a": 1}]')
    (tmp_path / "n.json").write_text("[{}, {}]")
    got = scanned(spark, str(tmp_path / "gone.json"), str(tmp_path / "n.json"), "/nowhere/x.json", str(tmp_path / "n.json"))
    assert [r[:2] for r in got] == [(1, 0), (1, 1), (3, 0), (3, 1)]
    assert len(scanned(spark, str(tmp_path / "m.json"))) == 1
    (tmp_path / "b.json").write_bytes(b'[{"a": "x\xff}y"}, {"a": "\xe4"}]')
    assert [json.loads(r[2])["a"] for r in scanned(spark, str(tmp_path / "b.json"))] == ["x\ufffd}y", "\ufffd"]
    with pytest.raises(ValueError):
        json_records.scan_records(spark, "/nowhere/x.json", str(tmp_path / "gone.json"))
    assert json_records.scan_records(spark, "/nowhere/x.json").count() == 0


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path):
    """One line of 40 MB: no task reads more than a range of it."""
    path = tmp_path / "large.json"
    item = {"text": 'a "quoted" } and { \\ brackets ] ' * 20, "more": [{"x": 1}] * 5}
    path.write_text("[" + ", ".join(json.dumps({"i": i, **item}) for i in range(45_000)) + "]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        rows = json_records.scan_records(spark, str(path)).select("_pos", json_records.field("i", "int").alias("i"), json_records.field("text").alias("t"))
        assert rows.agg(F.count("*"), F.sum(F.when(F.col("_pos") == F.col("i"), 1)), F.countDistinct("t"), F.max("i")).first()[:] == (45_000, 45_000, 1, 44_999)
        read = spark.read.option("lineSep", "}").text(str(path)).groupBy(F.spark_partition_id().alias("task")).agg(F.sum(F.octet_length("value") + 1).alias("bytes")).collect()
        assert len(read) > 8 and max(r["bytes"] for r in read) < 6 << 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_values_of_a_segment():
    for text, n in [(",{}", 1), (' , 5 , "a,b" , {"x": [1, 2]}', 3), (",[1,2],{}", 2), (", ", 0), (',{"a": {"b": 1}}', 1)]:
        assert json_arrays._items(text) == n
