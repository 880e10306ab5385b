"""Filters, order, dedupe, append, profiles, normalisation, inference, load."""

import json

import pytest
from pyspark.sql import functions as F

from lotframe import schema
from lotframe.operators import curate, infer, load, normalize, profile


def ids(df, column="i"):
    return [r[column] for r in df.collect()]


def test_skip_reason(spark):
    rows = [
        (1, "a", "USA", 2000, "V", None, None),
        (2, "a", "Japan", 2000, "V", None, None),
        (3, "Unmodified a", "", 2000, "V", None, None),
        (4, "a", None, 1990, "V", 1995, 0),
        (5, "a", None, None, "V", 1995, None),
        (6, "a", None, None, "V", None, 0),
        (7, "a", None, 2000, "N/A", None, None),
    ]
    df = spark.createDataFrame(rows, "i int, title string, country string, year int, vin string, min_year int, max_year int")
    got = {r["i"]: (r["skip_reason"], r["_error"]) for r in curate.skip_reason(df).collect()}
    assert got == {1: (None, None), 2: ("country", None), 3: ("modified", None), 4: ("year", None), 5: (None, "year is null"), 6: (None, None), 7: ("vin", None)}
    assert {r["outcome"]: r["n"] for r in curate.skip_counts(curate.skip_reason(df)).collect()}["kept"] == 2


def test_keep_first_and_order(spark):
    df = spark.createDataFrame([(0, "b", 1), (1, "a", 1), (2, "b", 2), (3, None, 2), (4, "", 3), (5, "a", None)], "i int, k string, n int").withColumn("_pos", F.col("i"))
    assert sorted(ids(curate.keep_first(df, "k"))) == [0, 1]
    assert sorted(ids(curate.keep_first(df, "k", drop_falsy=False))) == [0, 1, 3, 4]
    once = curate.keep_first(df, "k")
    assert sorted(ids(curate.keep_first(once, "k"))) == sorted(ids(once))
    assert ids(curate.sort_rows(df, ["n"])) == [0, 1, 2, 3, 4, 5]
    assert ids(curate.sort_rows(df, ["n"], reverse=True)) == [4, 2, 3, 0, 1, 5]
    assert ids(curate.sort_rows(df, ["n"], reverse=True, strict=True)) == [0, 1, 2, 3, 4, 5]
    both = curate.union_all([df, df.drop("n")])
    assert both.count() == 12 and both.where("_pos.frame = 1 and n is null").count() == 6


def test_append(spark):
    rows = [("s", 0, "1"), ("s", 1, "2"), ("s", 2, "3"), ("t", 0, "N/A"), ("t", 1, None)]
    df = spark.createDataFrame(rows, "slug string, _pos int, lot_number string")
    known = spark.createDataFrame([("2",), ("N/A",), (None,)], "lot_number string")
    got = curate.until_known(curate.mark_known(df, known))
    assert sorted((r["slug"], r["_pos"]) for r in got.collect()) == [("s", 0), ("t", 0), ("t", 1)]
    runs = spark.createDataFrame([(0, "x", 1), (1, None, 2), (1, "x", 3), (2, None, 4)], "slug_ord int, skip_reason string, i int")
    assert sorted(ids(curate.first_yielding_group(runs))) == [2, 3]
    assert ids(curate.first_yielding_group(runs.where("i = 1"))) == []
    assert sorted(ids(curate.limit_per_group(runs.withColumn("_pos", F.col("i")), "slug_ord", 1))) == [1, 2, 4]


def test_projection_and_value_filter(spark):
    df = spark.createDataFrame([("u", "N/A", 5, ["x"], "k")], "url string, vin string, price bigint, excerpt array<string>, other string")
    r = curate.project(df, ["price"]).first()
    assert (r["url"], r["vin"], r["price"], r["excerpt"], r["other"]) == ("", None, 5, [], "k")
    assert curate.value_filter(df, "N/A").count() == 1 and curate.value_filter(df, "N/A", ["url"]).count() == 0
    typed = spark.createDataFrame([(2003, 2003, 2003.0, True, "2003"), (1, None, 0.5, False, None)], "year int, n bigint, x double, flag boolean, s string")
    assert [curate.value_filter(typed, v, [f]).count() for v, f in ((2003, "year"), (2003, "n"), (2003, "x"), (1, "flag"), (True, "year"), ("2003", "s"), (2003, "s"), (0.5, "x"), (None, "n"), (2.5, "year"))] == [1, 1, 1, 1, 1, 1, 0, 1, 1, 0]
    assert {r["field"]: r["n"] for r in profile.value_occurrences(typed, 2003).collect()} == {"year": 1, "n": 1, "x": 1}
    assert curate.value_filter(df, 5, ["price", "gone"]).count() == 1 and curate.value_filter(df, "N/A", invert=True).count() == 0


def test_four_kinds_of_missing(spark):
    df = spark.createDataFrame([("",), ("  ",), ("N/A",), (None,), ("x",)], "c string")
    c = F.col("c")
    got = [tuple(r) for r in df.select(schema.render_missing(c), schema.quality_missing(c), schema.infer_missing(c), schema.value_match(c, "N/A")).collect()]
    assert got == [("N/A", False, True, False), ("  ", False, True, False), ("N/A", True, True, True), ("N/A", True, True, False), ("x", False, False, False)]


def test_profiles(spark):
    df = spark.createDataFrame([("N/A", 1, [], 10), (None, None, ["a"], None), ("e", 2, None, 0), ("e", 3, ["b"], 30)], "engine string, mileage int, listing_details array<string>, price bigint")
    got = {r["field"]: (r["missing"], r["percent"], r["complete"]) for r in profile.missing_fields(df).collect()}
    assert got == {"engine": (2, 50.0, False), "mileage": (1, 25.0, False), "listing_details": (2, 50.0, False)}
    assert [tuple(r) for r in profile.value_occurrences(df).collect()] == [("engine", 1, 25.0)]
    assert profile.price_summary(df).first()[:] == (4, 2, 20.0, 10, 30)
    assert {(r["value"], r["n"]) for r in profile.frequencies(df, ("engine",)).collect()} == {("N/A", 1), ("e", 2)}
    assert profile.dry_run(df, ["engine"]).first()[:] == (2, 2, 2, 0.0)
    empty = df.limit(0)
    assert profile.price_summary(empty).first()[:] == (0, 0, None, None, None)
    assert {r["percent"] for r in profile.missing_fields(empty).collect()} == {0.0}
    samples = profile.dry_run_samples(df.withColumns({"_pos": F.monotonically_increasing_id(), "title": F.lit("t" * 60)}), ["engine"]).collect()
    assert len(samples) == 2 and len(samples[0]["title"]) == 50


@pytest.mark.parametrize("literal", [True, False])
def test_normalize(spark, monkeypatch, literal):
    if not literal:
        monkeypatch.setattr(normalize, "LITERAL_RULES", 0)
    df = spark.createDataFrame([(0, "v8", "N/A", "N/A"), (1, "V8", None, "gt Coupe"), (2, "", "x", None)], "_pos int, engine string, transmission string, variant string")
    rules = spark.createDataFrame([("engine", "v8", "V8"), ("transmission", "N/A", "bad"), ("variant", "Gt COUPE", "GT"), ("variant", "n/a", "Standard"), ("engine", "", "bad")], "field string, from_value string, to_value string")
    got = normalize.normalize(df, rules).orderBy("_pos")
    assert [tuple(r) for r in got.collect()] == [(0, "V8", "N/A", "Standard"), (1, "V8", None, "GT"), (2, "", "x", None)]
    assert normalize.normalize(got, rules).orderBy("_pos").collect() == got.collect()
    assert normalize.normalize(df, rules.limit(0)).collect() == df.collect()
    twice = spark.createDataFrame([("variant", "gt coupe", "Z"), ("variant", "GT Coupe", "B"), ("engine", "v8", None)], "field string, from_value string, to_value string")
    assert normalize.normalize(df, twice).where("_pos = 1").first()["variant"] == "Z"
    placed = twice.withColumn("_pos", F.when(F.col("to_value") == "Z", 0).otherwise(1))
    assert normalize.normalize(df, placed).where("_pos = 1").first()["variant"] == "B"
    assert {r["field"]: (r["before"], r["after"]) for r in profile.reduction(df, got).collect()}["engine"] == (2, 1)


def test_prompt_text(spark):
    df = spark.createDataFrame([("N/A", "x", ["d1", "d2"], ["e"])], "seller_type string, engine string, listing_details array<string>, excerpt array<string>")
    r = infer.with_prompts(df, ["engine", "seller_type", "year", "location"]).first()
    assert r["na_fields"] == ["seller_type", "year", "location"] and r["skipped_fields"] == ["engine"]
    assert r["prompt"].startswith('Given this car listing data, infer the missing fields ("seller_type", "year", "location") based on')
    assert '    "seller_type": one of ["Private Party", "Dealer"],\n    "year": integer,\n    "location": string\n\nFor enum' in r["prompt"]
    assert r["prompt"].endswith('{\n    "seller_type": "...",\n    "year": 0,\n    "location": "..."\n}') and "Listing Details:\nd1\nd2\n\nExcerpt:\ne\n" in r["prompt"]


def test_parse_and_validate():
    assert infer.parse_answer('so {"a": 1} and {"b": 2}', ["a", "c"]) == {"a": 1, "c": None}
    assert infer.parse_answer('{"a": {"b": 2}}', ["a"]) == {"a": None, "b": 2}
    for bad in ("none", "[1]", '{"a": }'):
        with pytest.raises(ValueError):
            infer.parse_answer(bad, ["a"])
    assert [infer.validate_value(v, "integer") for v in (3.7, "12.0", " 12 ", True, None, [])] == [3, None, 12, 1, None, None]
    assert [infer.validate_value(v, "boolean") for v in (True, "Yes", "no", 1, None)] == [True, True, False, None, None]
    assert [infer.validate_value(v, ["A"]) for v in ("A", "B", None)] == ["A", None, None]


def test_infer_merge_and_stats(spark):
    def generate(prompt):
        if "bad" in prompt:
            raise RuntimeError("down")
        return json.dumps({"engine": "V8", "seller_type": "Nobody"})

    asked = spark.sparkContext.accumulator(0)
    answer = generate

    def generate(prompt):
        asked.add(1)
        return answer(prompt)

    rows = [(0, "u0", "t", "N/A", "N/A", ["d"], []), (1, "u1", "t", None, "Dealer", ["d"], []), (2, "u2", "t", "N/A", "Dealer", ["bad"], []), (3, "u3", "t", "V6", "Dealer", [], [])]
    df = spark.createDataFrame(rows, "_pos int, url string, title string, engine string, seller_type string, listing_details array<string>, excerpt array<string>")
    done = infer.infer(df, generate, ["engine", "seller_type"])
    merged = {r["url"]: (r["engine"], r["seller_type"]) for r in infer.merge(done).collect()}
    assert merged == {"u0": ("V8", "N/A"), "u1": (None, "Dealer"), "u2": ("N/A", "Dealer"), "u3": ("V6", "Dealer")}
    table = infer.results(done, ["engine", "seller_type"])
    stats = infer.run_stats(table, ["engine", "seller_type"]).first()
    assert (stats["total_entries"], stats["entries_with_na"], stats["entries_skipped"], stats["llm_calls"], stats["successful"], stats["failed"]) == (4, 3, 1, 5, 3, 1)
    assert stats["fields_inferred"] == {"engine": 2, "seller_type": 0}
    assert [tuple(r) for r in infer.errors(table).collect()] == [(2, "down")]
    assert asked.value == 5  # once for each row and attempt, however often the table is read


def test_infer_writes_where_told(spark, tmp_path):
    df = spark.createDataFrame([(0, "N/A", ["d"], [])], "_pos int, engine string, listing_details array<string>, excerpt array<string>")
    infer.infer(df, lambda p: '{"engine": "V8"}', ["engine"], path=str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).first()["inferred"] == {"engine": "V8"}


def test_load(spark):
    kind = "_pos int, url string, make string, model string, variant string, price bigint, listing_details array<string>, source string"
    df = spark.createDataFrame([(0, "a", "bmw", "m3", "", 10, ["x"], None), (1, "a", "bmw", "m3", "gt", None, [], "s"), (2, None, "bmw", "m3", None, 1, [], "s")], kind)
    sound, bad = load.quarantine(df)
    assert bad.first()["_error"] == "no url" and load.quarantine(df, strict=True)[1].count() == 2
    facts = load.conform(sound).orderBy("_pos").collect()
    assert [(r["sale_price"], r["reserve_met"], r["listing_details"], r["variant"], r["source"]) for r in facts] == [(1000, True, '["x"]', "STANDARD", "bringatrailer"), (None, None, None, "GT", "s")]
    makes, models, variants = load.dimensions(sound)
    assert sorted(ids(variants, "name")) == ["GT", "STANDARD"] and ids(makes, "name") == ["BMW"]
    again = load.dimensions(sound, makes, models, variants)
    assert [d.count() for d in again] == [1, 1, 2] and sorted(ids(again[2], "id")) == sorted(ids(variants, "id"))
    assert load.with_ids(load.conform(sound), makes, models, variants).count() == 2
    current = spark.createDataFrame([("a", 1), ("b", 2)], "url string, sale_price bigint")
    incoming = load.conform(sound).select("url", "sale_price", "_pos")
    after = load.upsert(current, incoming)
    assert {tuple(r) for r in after.collect()} == {("a", None, "updated"), ("b", 2, "unchanged")}
    twice = load.upsert(after.drop("action"), incoming)
    assert {r[:2] for r in map(tuple, twice.collect())} == {r[:2] for r in map(tuple, after.collect())}
    assert load.load_counts(sound, current.where("url = 'b'"), bad).first()[:] == (1, 1, 1, 3)


def test_no_fact_is_lost(spark):
    kind = "_pos int, url string, make string, model string, variant string, price bigint, listing_details array<string>, source string"
    df = spark.createDataFrame([(0, "a", None, "m3", "gt", 1, [], "s"), (1, "b", "bmw", None, None, 2, [], "s"), (2, "c", "bmw", "m3", None, 3, [], "s")], kind)
    loaded, failed, _ = load.load_facts(df)
    assert sorted((r["_pos"], r["_error"]) for r in failed.collect()) == [(0, "no make"), (1, "no model")]
    assert [(r["_pos"], r["variant_id"] is None) for r in loaded.collect()] == [(2, False)]
    makes = spark.createDataFrame([], "id bigint, name string")
    assert load.with_ids(load.conform(df), makes, spark.createDataFrame([], "id bigint, make_id bigint, name string"), spark.createDataFrame([], "id bigint, model_id bigint, name string")).count() == 3
