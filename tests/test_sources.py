"""Scans of JSON files, parameter files, sinks, the stream, and the registry."""

import json

import pytest
from pyspark.sql import functions as F

from lotframe import streaming
from lotframe.sources import json_records as J


@pytest.fixture
def write(tmp_path):
    def put(name, value):
        path = tmp_path / name
        path.write_text(value if isinstance(value, str) else json.dumps(value))
        return str(path)

    return put


def test_scan_records(spark, write):
    a, b, c = write("a.json", [{"url": "u1", "x": None}, {"url": "u2", "price": 5}]), write("b.json", {"url": "no list"}), write("c.json", "not json")
    rows = J.scan_records(spark, b, a, "/nowhere/d.json", c)
    got = rows.select("_file", "_pos", J.field("url").alias("url"), J.present("x").alias("has_x"), J.field("price", "bigint").alias("price")).orderBy("_file", "_pos").collect()
    assert [tuple(r) for r in got] == [(1, 0, "u1", True, None), (1, 1, "u2", False, 5)]
    with pytest.raises(ValueError):
        J.scan_records(spark, a, b, strict=True)
    listing = J.load_listings(spark, a).orderBy("_pos").collect()
    assert (listing[0]["source"], listing[0]["title"], listing[0]["convertible"], listing[0]["excerpt"], listing[1]["price"]) == ("unknown", "", False, [], 5)
    assert J.load_listings(spark, "/nowhere/x.json").count() == 0


def test_paths_are_whole_names(spark, write, tmp_path, monkeypatch):
    """A name that ends another's, a relative one, and one given twice."""
    a, data = write("a.json", [{"url": "short"}]), write("data.json", [{"url": "long"}, {"url": "long"}])
    monkeypatch.chdir(tmp_path)
    rows = J.scan_records(spark, data, a, a).select("_file", J.field("url").alias("url"))
    assert sorted(map(tuple, rows.collect())) == [(0, "long"), (0, "long"), (1, "short"), (2, "short")]
    assert J.scan_records(spark, f"file:{a}").count() == 1


def test_arrays_are_read_as_written(spark, tmp_path):
    rows = spark.range(25).select(F.col("id").alias("_pos"), F.to_json(F.struct("id")).alias("json"))
    paths = J.save_arrays(rows, str(tmp_path / "arrays"), per_file=10)
    got = J.scan_records(spark, *paths).select("_file", "_pos", J.field("id", "bigint").alias("id")).orderBy("_file", "_pos").collect()
    assert len(paths) == 3 and [tuple(r) for r in got] == [(i // 10, i % 10, i) for i in range(25)]


def test_shared_folder(spark):
    from lotframe.sources import shared

    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "spark://x", "applicationId": "y"})

    assert shared.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    with pytest.raises(ValueError):
        shared.shared_folder(Elsewhere())


def test_targets_rules_interface(spark, write):
    t = write("t.json", [{"slug": "s1", "make": "A", "modelSHort": "X ", "minYear": 1990}, {"slug": ["s2", "s3"], "make": "B", "modelfull": "Full"}, {"slug": "s4", "make": "C", "modelShort": "", "modelFull": "F"}])
    got = [tuple(r)[1:] for r in J.scan_targets(spark, t).orderBy("car", "slug_ord").collect()]
    assert got == [(0, "s1", "A", "X", "X ", 1990, None), (0, "s2", "B", "Full", "Full", None, None), (1, "s3", "B", "Full", "Full", None, None), (0, "s4", "C", "F", "F", None, None)]
    r = write("r.json", {"engine": {"v8": "V8"}, "variant": {"gt": "GT", "Gt": "last"}})
    assert {tuple(x) for x in J.scan_rules(spark, r).collect()} == {("engine", "v8", "V8"), ("variant", "GT", "last")}
    i = write("i.json", {"url": "string", "result": ["Sold", "No"]})
    assert {(x[0], x[1], tuple(x[2] or ())) for x in J.scan_interface(spark, i).collect()} == {("url", "string", ()), ("result", "enum", ("Sold", "No"))}


def test_preflight(spark, write):
    good, empty, odd, bad = write("g.json", [{"url": 1, "b": 2}]), write("e.json", []), write("o.json", [1]), write("b.json", "{")
    got = {r["_file"]: r for r in J.preflight(spark, good, empty, odd, bad, "/nowhere/f.json").collect()}
    assert (got[0]["ok"], got[0]["n_items"], got[0]["has_key"], sorted(got[0]["first_keys"])) == (True, 1, True, ["b", "url"])
    assert (got[1]["ok"], got[1]["is_empty"]) == (True, True)
    assert (got[2]["ok"], got[2]["first_is_object"]) == (False, False)
    assert (got[3]["exists"], got[3]["valid_json"], got[3]["ok"]) == (True, False, False)
    assert (got[4]["exists"], got[4]["ok"]) == (False, False)


def test_sinks(spark, write, tmp_path):
    rows = J.load_listings(spark, write("a.json", [{"url": "u1", "country": "USA", "lot_number": "7"}, {"url": "u2", "price": 5, "lot_number": "N/A"}]))
    path = J.save_batch(rows, str(tmp_path / "out" / "batch"))
    assert path.endswith("batch_n2")
    lines = [json.loads(x["value"]) for x in spark.read.text(path).collect()]
    one = next(x for x in lines if x["url"] == "u1")
    assert one["vin"] == "N/A" and one["price"] is None and "country" not in one
    assert [r[0] for r in J.known_lots(rows).collect()] == ["7"]
    J.save_run(spark.range(1), spark.range(2), spark.range(0), spark.range(2), str(tmp_path / "run"))
    assert spark.read.parquet(str(tmp_path / "run" / "results")).count() == 2


def test_stream(spark, tmp_path):
    html = '<h1 class="post-title">2003 BMW M3 GT</h1><div class="essentials"><ul><li><a>NVT00Y7654321098B</a></li></ul></div>'
    spark.createDataFrame([("u1", "s", html), ("u2", "s", "<p>")], "url string, slug string, html string").write.parquet(str(tmp_path / "pages"))
    targets = spark.createDataFrame([("s", "BMW", "M3", "M3", 2000, None)], "slug string, make string, model_full string, model_short string, min_year int, max_year int")
    pages = spark.readStream.schema("url string, slug string, html string").parquet(str(tmp_path / "pages"))
    for _ in range(2):
        streaming.extract_stream(pages, targets, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "out" / "listings")).collect()
    assert [(r["url"], r["variant"], r["vin"]) for r in kept] == [("u1", "GT", "NVT00Y7654321098B")]
    bad = spark.read.parquet(str(tmp_path / "out" / "quarantine"))
    assert [r["_error"] for r in bad.select(F.col("_error")).collect()] == ["year is null"]


def test_registry():
    import __spark_entry__ as e

    queries, sql = e.queries(), e.oracle_sql()
    assert len(queries) >= 30 and set(sql) <= set(queries)
