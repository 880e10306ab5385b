"""Answers that are kept, snapshots in buckets, dense ids and ranks, key filters, counts made while writing, and state of streams."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lotframe import streaming
from lotframe.operators import curate, infer, load, normalize
from lotframe.sources import json_records as J

ROWS = "_pos int, url string, title string, engine string, listing_details array<string>, excerpt array<string>"


def listings(spark, n, prompts):
    return spark.createDataFrame([(i, f"u{i}", "t", "N/A" if i % 5 else "V6", [f"d{i % prompts}"], []) for i in range(n)], ROWS)


def test_equal_prompts_are_asked_once_and_a_broken_run_goes_on(spark, tmp_path, monkeypatch):
    asked = str(tmp_path / "asked")
    Path(asked).mkdir()

    def generate(prompt):
        import os
        import uuid

        detail = prompt.split("Listing Details:\n")[1].split("\n")[0]
        Path(os.path.join(asked, f"{detail}-{uuid.uuid4().hex}")).touch()
        if detail == "d3":
            raise RuntimeError("down")
        return json.dumps({"engine": f"E {detail}"})

    df, store = listings(spark, 200, 40), str(tmp_path / "store")
    real, calls = infer.answer_store, []

    def broken(spark, path):
        calls.append(path)
        if len(calls) == 3:
            raise KeyboardInterrupt
        return real(spark, path)

    monkeypatch.setattr(infer, "answer_store", broken)
    with pytest.raises(KeyboardInterrupt):
        infer.infer(df, generate, ["engine"], max_retries=1, store=store)
    monkeypatch.setattr(infer, "answer_store", real)
    before = len(list(Path(asked).iterdir()))
    assert 0 < before < 40
    done = infer.infer(df, generate, ["engine"], max_retries=1, store=store)
    names = [p.name.split("-")[0] for p in Path(asked).iterdir()]
    needed = {f"d{i % 40}" for i in range(200) if i % 5}
    assert sorted(names) == sorted(needed)  # each once, over both runs
    got = {r["url"]: (r["engine"], r["error"]) for r in done.select("url", F.try_element_at("inferred", F.lit("engine")).alias("engine"), "error").collect()}
    assert got == {f"u{i}": (None, None) if i % 5 == 0 else (None, "down") if i % 40 == 3 else (f"E d{i % 40}", None) for i in range(200)}
    infer.infer(df, generate, ["engine"], max_retries=1, store=store)
    assert len(list(Path(asked).iterdir())) == len(names)
    better = infer.infer(df, lambda p: json.dumps({"engine": "again"}), ["engine"], store=store, ask_failed=True)
    assert better.where("error IS NOT NULL").count() == 0 and better.where("inferred['engine'] = 'again'").select("listing_details").distinct().count() == 1


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("data/**/*.parquet")}


def test_a_snapshot_rewrites_only_what_it_touches(spark, tmp_path):
    table = load.Snapshot(spark, str(tmp_path / "facts"), buckets=16)
    assert table.read() is None and table.version() == 0
    rows = [(f"u{i}", i, f"a{i}") for i in range(400)]
    kind = "url string, _pos int, title string"
    assert table.upsert(spark.createDataFrame([*rows, ("u0", 1000, "last")], kind)) == {"inserted": 400, "updated": 0, "buckets": 16}
    before = files_of(tmp_path / "facts")
    assert table.upsert(spark.createDataFrame([("u1", 0, "new"), ("v", 1, "more")], kind))["inserted"] == 1
    after = files_of(tmp_path / "facts")
    assert before.items() <= after.items()  # nothing that was there has changed
    written = {n.split("bucket=")[1].split("/")[0] for n in set(after) - set(before)}
    assert 1 <= len(written) <= 2
    got = {r["url"]: r["title"] for r in table.read().collect()}
    assert got == {**{u: t for u, _, t in rows}, "u0": "last", "u1": "new", "v": "more"}
    assert table.read(1).count() == 400 and table.version() == 2
    assert table.upsert(spark.createDataFrame([], kind)) == {"inserted": 0, "updated": 0, "buckets": 0}
    (tmp_path / "facts" / "versions" / "3").mkdir()  # an upsert that broke off before its list was complete
    assert table.version() == 2 and table.upsert(spark.createDataFrame([("w", 0, None)], kind))["inserted"] == 1 and table.version() == 3
    with pytest.raises(ValueError):
        load.Snapshot(spark, str(tmp_path / "facts"), buckets=8).read()


def test_ids_are_dense_unique_and_stable(spark):
    keys = [(i % 70, f"k{i % 91}") for i in range(900)] + [(1, None)]
    df = spark.createDataFrame(keys, "make_id long, name string").repartition(5)
    first = load.dimension(None, df.where("make_id < 40"))
    again = load.dimension(None, df.where("make_id < 40").repartition(2))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    both = load.dimension(first, df)
    n = len({k for k in keys if k[1]})
    assert sorted(r["id"] for r in both.collect()) == list(range(1, n + 1))
    assert set(map(tuple, first.collect())) <= set(map(tuple, both.collect()))
    assert load.dimension(both, df).count() == n and load.dimension(None, df.limit(0)).count() == 0


def test_ranks(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, 1, 2, 3])) for i in range(500)]
    df = spark.createDataFrame(rows, "_pos int, n int").repartition(7)
    got = [r["_pos"] for r in curate.rank_rows(df, ["n"], reverse=True).orderBy("rank").collect()]
    assert got == [r["_pos"] for r in curate.sort_rows(df, ["n"], reverse=True).collect()]
    assert sorted(r["rank"] for r in curate.rank_rows(df, ["n"]).collect()) == list(range(1, 501))


def test_a_key_filter_keeps_rows_from_the_join(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("lot_number")).unionByName(spark.createDataFrame([(None,), ("N/A",)], "lot_number string"))
    known = spark.range(0, 20_000, 40).select(F.col("id").cast("string").alias("lot_number"))
    bits = 32 * 500
    passed = curate.may_hold(df, curate.key_filter(known, "lot_number", bits), "lot_number", bits, "may")
    n = passed.where("may").count()
    assert 500 <= n < 2000 and passed.where("may").join(known, "lot_number", "left_semi").count() == 500
    plain, filtered = (curate.mark_known(df, known, prefilter=p).groupBy("known").count().collect() for p in (False, True))
    assert {tuple(r) for r in plain} == {tuple(r) for r in filtered} == {(True, 500), (False, 19_502)}
    assert curate.mark_known(df, known.limit(0), prefilter=True).where("known").count() == 0


def jobs(spark, run):
    spark.sparkContext.setJobGroup("counted", "")
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    out = run()
    after = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(after - before)


def test_batches_are_counted_while_they_are_written(spark, tmp_path):
    rows = spark.range(37).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("7").alias("lot_number"))
    path, n = jobs(spark, lambda: J.save_batch(rows, str(tmp_path / "b")))
    assert path.endswith("b_n37") and n == 1 and spark.read.json(path).count() == 37
    with pytest.raises(FileExistsError):
        J.save_batch(rows, str(tmp_path / "b"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["b_n37"]
    cards = spark.createDataFrame([(1, None, None), (2, "vin", None), (3, None, "year is null"), (4, None, None)], "i int, skip_reason string, _error string")
    counts, n = jobs(spark, lambda: curate.write_kept(cards, str(tmp_path / "kept")))
    assert counts == {"kept": 2, "vin": 1, "year is null": 1} and n == 1
    assert sorted(r["i"] for r in spark.read.parquet(str(tmp_path / "kept")).collect()) == [1, 4]


def test_a_stream_remembers_where_a_slug_is_known(spark, tmp_path):
    rng = random.Random(9)
    rows = [(f"s{i % 7}", i, None if i % 11 == 0 else str(i)) for i in range(300)]
    known = spark.createDataFrame([(str(i),) for i in rng.sample(range(60, 300), 25)] + [("N/A",), (None,)], "lot_number string")
    kind = "slug string, _pos int, lot_number string"
    for part in range(5):
        some = rows[60 * part : 60 * part + 60]
        rng.shuffle(some)
        spark.createDataFrame(some, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "cards"))
        stream = streaming.append_stream(spark.readStream.schema(kind).parquet(str(tmp_path / "cards")), known, str(tmp_path / "out"), str(tmp_path / "state"))
        stream.awaitTermination()
    batch = curate.until_known(curate.mark_known(spark.createDataFrame(rows, kind), known)).drop("known")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, got.select("slug", "_pos", "lot_number").collect())) == sorted(map(repr, batch.select("slug", "_pos", "lot_number").collect()))
    with pytest.raises(ValueError):
        streaming.until_known(batch.withColumn("_pos", F.lit("x")).withColumn("known", F.lit(True)))


def test_saved_rules_mean_the_same(spark, tmp_path):
    df = spark.createDataFrame([(0, "v8")], "_pos int, engine string")
    rules = spark.createDataFrame([(0, "engine", "v8", "Z"), (1, "engine", "v8", "A")], "_pos int, field string, from_value string, to_value string")
    normalize.save_rules(rules, str(tmp_path / "rules"))
    again = normalize.read_rules(spark, str(tmp_path / "rules"))
    assert normalize.normalize(df, again).first()["engine"] == normalize.normalize(df, rules).first()["engine"] == "A"
    normalize.save_rules(rules.drop("_pos"), str(tmp_path / "plain"))
    assert normalize.read_rules(spark, str(tmp_path / "plain")).columns == ["field", "from_value", "to_value"]


def test_inference_evaluates_its_input_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def engine(i):
        made.add(1)
        return "N/A" if i % 5 else "V6"

    df = listings(spark, 100, 4).withColumn("engine", engine("_pos"))
    done = infer.infer(df, lambda p: json.dumps({"engine": "E"}), ["engine"])
    assert infer.merge(done).groupBy("engine").count().orderBy("engine").collect() == [("E", 80), ("V6", 20)]
    assert made.value == 100


def test_answered_rows_hold_no_prompts_unless_they_are_written_where_told(spark, tmp_path):
    df, path = listings(spark, 60, 3), str(tmp_path / "told")
    own, told = infer.infer(df, lambda p: "{}", ["engine"]), infer.infer(df, lambda p: "{}", ["engine"], path=path)
    assert own.columns == told.columns and sorted(map(repr, own.collect())) == sorted(map(repr, told.collect()))
    assert sorted(map(repr, own.select("url", "prompt").collect())) == sorted(map(repr, infer.with_prompts(df, ["engine"]).select("url", "prompt").collect()))
    stored = [spark.read.parquet(f).columns for f in (own.inputFiles()[0], told.inputFiles()[0])]
    assert ["prompt" in c for c in stored] == [False, True]


def test_a_stream_keeps_whole_numbers_and_groups_without_a_name(spark, tmp_path):
    big, rows = 1 << 60, []
    for i in range(900):
        rows.append((None if i % 300 == 299 else f"s{i % 300}", None if i == 700 else big + i, None if i % 4 else big + 3 * i, i % 7 == 3 if i % 5 else None))
    kind = "slug string, _pos bigint, n bigint, known boolean"
    for part in range(3):
        spark.createDataFrame(rows[300 * part : 300 * part + 300], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "cards"))
        kept = streaming.until_known(spark.readStream.schema(kind).parquet(str(tmp_path / "cards"))).writeStream.format("parquet")
        kept.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    cuts: dict = {}
    for slug, pos, _, known in rows:
        if known:
            cuts[slug] = min(cuts.get(slug, 1 << 63), pos)
    want = [r for r in rows if r[0] not in cuts or r[1] is not None and r[1] < cuts[r[0]]]
    assert sorted(map(repr, map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))) == sorted(map(repr, want))


def test_a_stream_calls_python_no_more_often_with_more_groups(spark, tmp_path, monkeypatch):
    calls = spark.sparkContext.accumulator(0)
    spark.range(500).selectExpr("concat('s', id) slug", "id _pos", "id % 2 = 0 known").write.parquet(str(tmp_path / "cards"))
    cards = spark.readStream.schema("slug string, _pos bigint, known boolean").parquet(str(tmp_path / "cards"))
    kind = type(cards.groupBy("slug"))
    real = kind.applyInPandasWithState

    def counted(self, f, *rest):
        def call(key, frames, state):
            calls.add(1)
            yield from f(key, frames, state)

        return real(self, call, *rest)

    monkeypatch.setattr(kind, "applyInPandasWithState", counted)
    kept = streaming.until_known(cards, buckets=4).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
    kept.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 250 and calls.value <= 4
