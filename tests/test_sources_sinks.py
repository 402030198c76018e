"""Sources, sinks and streaming on temporary folders."""

import json

import pytest
from pyspark.sql import functions as F

from quillfeed.operators import manifest, merge
from quillfeed.sources import landed, sinks, versions
from quillfeed.streaming import merge_stream


def test_strict_json(spark, tmp_path):
    path = str(tmp_path / "posts.json")
    assert landed.read_json_strict(spark, path, "id string, n long").count() == 0
    (tmp_path / "posts.json").write_text(json.dumps([{"id": "1", "n": 2}, {"id": "2", "n": 3}]))
    assert landed.read_json_strict(spark, path, "id string, n long", unique="id").count() == 2
    (tmp_path / "posts.json").write_text("[{broken")
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED"):
        landed.read_json_strict(spark, path, "id string, n long").collect()


def test_pages_push_down(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([("posts", "7", p, 20, 200, "application/json", "{}", p) for p in range(1, 6)], landed.PAGE_SCHEMA).write.parquet(path)
    found = landed.read_pages(spark, path, streams=["posts"], max_page=3).select("page")
    assert sorted(r["page"] for r in found.collect()) == [1, 2, 3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(page,3)" in plan and "body" not in plan.split("ReadSchema")[1]


def test_atomic_replace(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.replace_atomically(spark.range(3), path)
    sinks.replace_atomically(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_atomically(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_markdown(spark, tmp_path):
    df = spark.createDataFrame([("2", "t", "u", 1, 2, 3, "T", "body"), ("10", "t", "u", 1, 2, 3, "", "long")], "id string, created_at string, target string, reply_count int, like_count int, retweet_count int, title string, clean_text string")
    blocks = sinks.render_markdown(df.withColumn("epoch_ms", F.lit(0)), "posts", merge.total_order(), "now")
    path = str(tmp_path / "md")
    sinks.write_markdown(blocks, path)
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    assert text.index("## Post 1\n\nID: 10") < text.index("## Post 2\n\nID: 2") and "Title: T" in text and "Total: 2" in text


def test_report_is_always_written(spark, tmp_path):
    path = str(tmp_path / "report")

    def work(report):
        report["posts"] = 1
        raise RuntimeError("boom")

    with pytest.raises(RuntimeError):
        sinks.run_with_report(spark, path, work)
    report = json.loads(spark.read.text(path).first()[0])
    assert report["status"] == "failed" and report["error"]["message"] == "boom" and report["posts"] == 1
    assert sinks.run_with_report(spark, path, lambda r: None)["status"] == "complete"


class Stop(Exception):
    """The run ends here, as if its process had died."""


def stopping(monkeypatch, module, name, after):
    """Lets `after` calls of a function pass and stops at the next."""
    real, calls = getattr(module, name), []

    def call(*args, **kwargs):
        calls.append(1)
        if len(calls) > after:
            raise Stop
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, call)


@pytest.mark.parametrize("step", ["staged", "half staged", "moved aside", "moved aside and half staged", "renamed"])
def test_a_replacement_that_stops_loses_nothing(spark, tmp_path, step):
    path = tmp_path / "out"
    sinks.replace_atomically(spark.range(3), str(path))
    stage, old = tmp_path / "out.stage-1a", tmp_path / "out.old-1a"
    spark.range(5).write.parquet(str(stage))
    if "half" in step:
        (stage / "_SUCCESS").unlink()
    if step.startswith("moved"):
        path.rename(old)
    if step == "renamed":
        path.rename(old)
        stage.rename(path)
    got = sinks.read_stored(spark, str(path)).count()
    assert got == (5 if step in ("moved aside", "renamed") else 3)
    sinks.replace_atomically(spark.range(7), str(path))
    assert sinks.read_stored(spark, str(path)).count() == 7 and [p.name for p in tmp_path.iterdir()] == ["out"]
    assert sinks.read_stored(spark, str(tmp_path / "none")) is None


def test_json_corpus(spark, tmp_path):
    path = str(tmp_path / "corpus")
    sinks.write_json(spark.createDataFrame([("1", None), ("2", "é")], "id string, title string"), path)
    lines = sorted(r[0] for r in spark.read.text(path).collect())
    assert [json.loads(x) for x in lines] == [{"id": "1", "title": None}, {"id": "2", "title": "é"}]


def test_json_lines_and_arrays_are_read_whole(spark, tmp_path):
    schema = "id string, title string"
    sinks.write_json(spark.createDataFrame([(str(i), None if i % 2 else "é\n") for i in range(50)], schema).repartition(3), str(tmp_path / "lines"))
    assert sorted(int(r["id"]) for r in landed.read_json_strict(spark, str(tmp_path / "lines"), schema, unique="id").collect()) == list(range(50))
    (tmp_path / "a.json").write_text('[{"id": "1"},\n {"id": "2", "title": "x"}]')
    (tmp_path / "b.json").write_text('\n[\n{"id": "1"}]')
    (tmp_path / "c.json").write_text('{"id": "1"}\n{"id": \n')
    (tmp_path / "d.json").write_text("")
    count = lambda name: len(landed.read_json_strict(spark, str(tmp_path / name), schema).collect())
    assert (count("a.json"), count("b.json"), count("d.json")) == (2, 1, 0)
    with pytest.raises(Exception):  # noqa: B017
        count("c.json")


def test_promotion(spark, tmp_path):
    none, some = spark.createDataFrame([], "x string"), spark.createDataFrame([("bad",)], "x string")
    base, bad = str(tmp_path / "store"), spark.range(2).select(F.raise_error(F.lit("no")).alias("x"))
    assert all(sinks.promote(spark, base, {"posts": spark.range(2)}, some).values()) and versions.read(spark, base, "posts") is None
    assert sinks.promote(spark, base, {"posts": spark.range(2), "articles": spark.range(3)}, none) == {"posts": None, "articles": None}
    out = sinks.promote(spark, base, {"posts": spark.range(9), "articles": bad}, none)
    assert "no" in out["articles"] and out["posts"] and versions.read(spark, base, "posts").count() == 2
    out = sinks.promote(spark, base, {"posts": spark.range(9), "articles": bad}, some, all_or_nothing=False)
    assert out["posts"] is None and "no" in out["articles"]
    assert versions.read(spark, base, "posts").count() == 9 and versions.read(spark, base, "articles").count() == 3


@pytest.mark.parametrize(("name", "after"), [("write_version", 0), ("write_version", 1), ("commit", 0), ("_clean", 0)])
def test_a_promotion_that_stops_changes_all_or_nothing(spark, tmp_path, monkeypatch, name, after):
    base = str(tmp_path / "store")
    versions.publish(spark, base, {"posts": spark.range(2), "articles": spark.range(3)})
    with monkeypatch.context() as m:
        stopping(m, versions, name, after)
        with pytest.raises(Stop):
            versions.publish(spark, base, {"posts": spark.range(20), "articles": spark.range(30)})
    counts = {n: versions.read(spark, base, n).count() for n in ("posts", "articles")}
    assert counts == ({"posts": 20, "articles": 30} if name == "_clean" else {"posts": 2, "articles": 3})
    for n in (4, 5, 6):
        versions.publish(spark, base, {"posts": spark.range(n)})
    assert versions.read(spark, base, "posts").count() == 6 and versions.read(spark, base, "articles").count() == counts["articles"]
    folders = [p.name for p in (tmp_path / "store").iterdir() if p.name != "_commits"]
    assert len(folders) == 3 and len([p for p in (tmp_path / "store" / "_commits").iterdir() if p.suffix == ".json"]) == 2


def test_a_commit_half_written_is_none(spark, tmp_path):
    base = str(tmp_path / "store")
    versions.publish(spark, base, {"posts": spark.range(2)})
    (tmp_path / "store" / "_commits" / ".draft-1").write_text('{"posts"')
    assert versions.read(spark, base, "posts").count() == 2


@pytest.mark.parametrize(("name", "after"), [("write_version", 0), ("commit", 0), ("_clean", 0)])
def test_a_merge_that_stops_loses_nothing(spark, tmp_path, monkeypatch, name, after):
    rules, path = merge.MergeRules(latest=("n",)), str(tmp_path / "c")
    batch = lambda a, b, seq: spark.createDataFrame([(k, seq, k + seq) for k in range(a, b)], "k int, seq long, n long")
    merge_stream.merge_batch(batch(0, 100, 0), path, "k", "seq", rules)
    with monkeypatch.context() as m:
        stopping(m, versions, name, after)
        with pytest.raises(Stop):
            merge_stream.merge_batch(batch(95, 100, 1000), path, "k", "seq", rules)
    merge_stream.merge_batch(batch(95, 100, 1000), path, "k", "seq", rules)  # the micro-batch comes again
    merge_stream.merge_batch(batch(100, 101, 7), path, "k", "seq", rules)
    got = {r["k"]: r["n"] for r in merge_stream.read_corpus(spark, path).collect()}
    assert got == {k: k + (7 if k == 100 else 1000 if k >= 95 else 0) for k in range(101)}


def test_a_batch_rewrites_its_buckets_alone(spark, tmp_path):
    rules, path = merge.MergeRules(latest=("n",)), str(tmp_path / "c")
    merge_stream.merge_batch(spark.range(500).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("seq"), F.lit(1).alias("n")), path, "k", "seq", rules, buckets=16)
    before = versions.current(spark, path)
    merge_stream.merge_batch(spark.createDataFrame([(3, 0, 9)], "k long, seq long, n int"), path, "k", "seq", rules, buckets=16)
    after = versions.current(spark, path)
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    merge_stream.merge_batch(spark.createDataFrame([], "k long, seq long, n int"), path, "k", "seq", rules, buckets=16)
    assert merge_stream.read_corpus(spark, path).count() == 500 and merge_stream.read_corpus(spark, str(tmp_path / "none")) is None


def test_only_the_stores_own_folders_are_deleted(spark, tmp_path):
    base = tmp_path / "store"
    for i in range(4):
        versions.publish(spark, str(base), {"posts": spark.range(i + 1)})
        if i == 0:
            for name in ("reports", "checkpoint/offsets", "v-notes", "v-" + "g" * 32):
                (base / name).mkdir(parents=True)
                (base / name / "file").write_text("kept")
    assert all((base / name / "file").read_text() == "kept" for name in ("reports", "checkpoint/offsets", "v-notes", "v-" + "g" * 32))
    assert len([p for p in base.iterdir() if versions._OWN.match(p.name)]) == 2 and versions.read(spark, str(base), "posts").count() == 4


def test_buckets_follow_the_corpus(spark, tmp_path, monkeypatch):
    """A small batch of random keys rewrites a small part, however large the corpus has become."""
    monkeypatch.setattr(merge_stream, "ROWS_PER_BUCKET", 50)
    rules, path = merge.MergeRules(latest=("n",)), str(tmp_path / "c")
    batch = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), F.col("id").alias("seq"), F.col("id").alias("n"))
    merge_stream.merge_batch(batch(0, 40), path, "k", "seq", rules)
    assert versions.notes(spark, path) == {"buckets": "1", "rows": "40"}
    merge_stream.merge_batch(batch(30, 3000), path, "k", "seq", rules)
    before = versions.current(spark, path)
    assert versions.notes(spark, path) == {"buckets": "64", "rows": "3000"} and len(before) == 64
    merge_stream.merge_batch(batch(2999, 3002), path, "k", "seq", rules)
    after = versions.current(spark, path)
    assert sum(before.get(b) != after[b] for b in after) <= 3 and versions.notes(spark, path)["rows"] == "3002"
    assert sorted((r["k"], r["n"]) for r in merge_stream.read_corpus(spark, path).collect()) == [(i, i) for i in range(3002)]


def test_a_batch_leaves_no_scratch(spark, tmp_path):
    from pathlib import Path

    from quillfeed.session import ensure_checkpoint_dir

    files = lambda: sorted(p for p in Path(ensure_checkpoint_dir(spark).removeprefix("file:")).rglob("*") if p.is_file())
    rules, path = merge.MergeRules(latest=("n",)), str(tmp_path / "c")
    batch = spark.createDataFrame([(1, 1, 1)], "k long, seq long, n long")
    before = files()
    for _ in range(2):
        merge_stream.merge_batch(batch, path, "k", "seq", rules)
        merge_stream.merge_batch(batch.limit(0), path, "k", "seq", rules)
    with pytest.raises(ValueError):
        merge_stream.merge_batch(spark.createDataFrame([(1, 1, 1), (1, 2, 2)], "k long, seq long, n long"), path, "k", "seq", merge.MergeRules(same=("n",)))
    assert files() == before


def test_snapshot_digest(spark, tmp_path):
    tree = tmp_path / "tree"
    (tree / "b").mkdir(parents=True)
    (tree / "a.txt").write_text("one")
    (tree / "b" / "c.txt").write_text("two")
    root = f"file:{tree}/"
    digest = lambda framed=True: manifest.snapshot_digest(landed.read_files(spark, str(tree)), root, framed).first()
    first = digest()
    assert first["n_files"] == 2 and first["digest"] == manifest.local_tree_digest(str(tree)) and digest(False)["digest"] != first["digest"]
    (tree / "a.txt").write_text("three")
    assert digest()["digest"] != first["digest"]


def test_stream_equals_batch(spark, tmp_path):
    rules = merge.MergeRules(richest=("title",), latest=("n",))
    schema = "k int, seq long, title string, n long"
    rows = [(i % 5, i, "x" * (i % 4), i if i % 3 else None) for i in range(40)]
    for part in range(4):
        spark.createDataFrame(rows[part::4], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{part}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    merge_stream.merge_stream(stream.orderBy("seq") if False else stream, str(tmp_path / "corpus"), str(tmp_path / "state"), "k", "seq", rules).awaitTermination()
    got = {r["k"]: len(r["title"]) for r in merge_stream.read_corpus(spark, str(tmp_path / "corpus")).collect()}
    want = {r["k"]: len(r["title"]) for r in merge.merge_versions(spark.createDataFrame(rows, schema), "k", "seq", rules).collect()}
    assert got == want


def test_stream_conflict_keeps_the_corpus(spark, tmp_path):
    rules = merge.MergeRules(same=("url",))
    batch = lambda url: spark.createDataFrame([(1, 0, url)], "k int, seq long, url string")
    merge_stream.merge_batch(batch("a"), str(tmp_path / "c"), "k", "seq", rules)
    with pytest.raises(ValueError):
        merge_stream.merge_batch(batch("b"), str(tmp_path / "c"), "k", "seq", rules)
    assert merge_stream.read_corpus(spark, str(tmp_path / "c")).first()["url"] == "a"


def test_deduplicated(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:05:00"), (2, "2024-01-01 00:06:00")]
    df = spark.createDataFrame(rows, "k int, t string").withColumn("t", F.to_timestamp("t"))
    assert sorted(r["k"] for r in merge_stream.deduplicated(df, "k", "t").collect()) == [1, 2]
    df.write.parquet(str(tmp_path / "in"))
    stream = merge_stream.deduplicated(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "k", "t")
    stream.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["k"] for r in spark.table("once").collect()) == [1, 2]
