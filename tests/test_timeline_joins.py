"""As-of joins, sessions, levels and sketches against plain computations; hash trees of snapshots."""

import random
from itertools import pairwise

from pyspark.sql import functions as F

from quillfeed.operators import snapshots
from quillfeed.operators import timeline_joins as joins
from quillfeed.sources import landed


def test_as_of_against_a_plain_search(spark):
    rng = random.Random(1)
    marks = [(rng.randint(1, 3), rng.randint(-50, 400), rng.randint(0, 9)) for _ in range(60)] + [(None, 5, 1), (1, None, 1)]
    seen = [(i, rng.choice([1, 1, 1, 2, 4, None]), rng.choice([None, *range(-80, 500)])) for i in range(300)]
    a, b = spark.createDataFrame(seen, "i int, k int, t long"), spark.createDataFrame(marks, "k int, t long, v int")
    for span in (7, 100, 10_000):
        got = {r["i"]: (r["v"], r["v_time"]) for r in joins.as_of(a, b, "k", "t", "v", span).collect()}
        for i, k, t in seen:
            own = [(u, v) for q, u, v in marks if q is not None and u is not None and q == k and t is not None and u <= t]
            assert got[i] == ((max(own)[1], max(own)[0]) if own else (None, None)), (i, span)
    plan = joins.as_of(a, b, "k", "t", "v", 100)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_sessions_batch_equals_stream(spark, tmp_path):
    rng, rows, t = random.Random(2), [], 1_700_000_000
    for _ in range(300):
        t += rng.choice([10, 100, 1000, 3000])
        rows.append((rng.randint(1, 3), t))
    frame = lambda r: spark.createDataFrame(r, "u int, s long").select("u", F.timestamp_seconds("s").alias("ts"))
    key = lambda df: sorted((r["u"], r["session_start"].timestamp(), r["session_end"].timestamp(), r["n_events"]) for r in df.collect())
    got, want = key(joins.sessions(frame(rows), "u", "ts", "20 minutes")), []
    for u in (1, 2, 3):
        own = sorted(s for v, s in rows if v == u)
        cuts = [0, *(i + 1 for i, (x, y) in enumerate(pairwise(own)) if y - x > 1200), len(own)]
        want += [(u, own[a], own[b - 1] + 1200, b - a) for a, b in pairwise(cuts)]
    assert got == sorted(want)
    late = [(20 + i, rows[0][1]) for i in range(4)]
    for k, part in enumerate([rows[:100], rows[100:200], rows[200:] + late, [(9, t + 10**6)]]):
        frame(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"p{k}"))
        stream = joins.sessions(spark.readStream.schema("u int, ts timestamp").parquet(str(tmp_path / "in" / "*")), "u", "ts", "20 minutes")
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert joins.late_rows(query) == (4 if k == 2 else 0)
    assert key(spark.read.parquet(str(tmp_path / "out"))) == got
    in_time, after = joins.split_late(frame(rows[:5] + [(1, None)]), "ts", F.timestamp_seconds(F.lit(rows[3][1])))
    assert (in_time.count(), after.count()) == (2, 4)


def test_levels_in_one_expansion(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice(["x", None]), rng.randint(1, 9), rng.random() < 0.5) for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b string, u int, bad boolean")
    out = joins.levels(df, [["a", "b"], ["a"], []], "u", n_bad=F.count_if("bad"))
    got = {(r["a"], r["b"], r["level"]): (r["n_rows"], r["n_distinct"], r["n_bad"]) for r in out.collect()}
    want = {}
    for level, pick in ((0, lambda r: (r[0], r[1])), (1, lambda r: (r[0], None)), (3, lambda r: (None, None))):
        for k in {pick(r) for r in rows}:
            own = [r for r in rows if pick(r) == k]
            want[(*k, level)] = (len(own), len({r[2] for r in own}), sum(r[3] for r in own))
    assert got == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Expand") == 1


def test_sketches_keep_to_their_error(spark):
    a, b = spark.range(0, 60_000), spark.range(20_000, 100_000)
    sketch = lambda df: joins.key_sketches(df, F.when(F.col("id") % 2 == 0, "even").otherwise("odd"), "id")
    for r in joins.estimated_overlap(sketch(a), sketch(b)).collect():
        for name, exact in (("left_keys", 30_000), ("right_keys", 40_000), ("union_keys", 50_000)):
            assert abs(r[name] - exact) <= 4 * joins.SKETCH_ERROR * exact
        assert abs(r["shared_keys"] - 20_000) <= 4 * joins.SKETCH_ERROR * 120_000
    alone = joins.estimated_overlap(sketch(a), sketch(b).filter("segment = 'odd'")).filter("segment = 'even'").first()
    assert alone["right_keys"] == 0 and alone["shared_keys"] == 0


def lines(spark, files, parts=3):
    return spark.createDataFrame(sorted(files.items()), "path string, content string").repartition(parts)


def test_tree_and_difference_against_full_comparison(spark):
    rng = random.Random(4)
    old = {"/".join(rng.choice("abc") + str(rng.randint(0, 2)) for _ in range(rng.randint(1, 4))) + f"/f{i}": str(rng.random()) for i in range(120)}
    new = {p: (c if rng.random() < 0.9 else c + "x") for p, c in old.items() if rng.random() < 0.9} | {"new/deep/er/f": "1", "top": "2", "a0/f0": "3"}
    one, two = snapshots.tree(lines(spark, old)), snapshots.tree(lines(spark, new))
    got = {r["path"]: r["change"] for r in snapshots.difference(one, two).collect()}
    want = {p: "added" if p not in old else "removed" if p not in new else "changed" for p in old.keys() | new.keys() if old.get(p) != new.get(p)}
    assert got == want and snapshots.difference(one, one).collect() == []
    digest = lambda t: {r["node"]: (r["digest"], r["n_files"]) for r in t.collect()}
    assert digest(one) == digest(snapshots.tree(lines(spark, old, 1))) and digest(one)[""][1] == len(old)
    assert digest(one)[""] != digest(two)[""]


def test_a_file_that_becomes_a_folder(spark):
    one, two = snapshots.tree(lines(spark, {"a": "1", "b/c": "2"})), snapshots.tree(lines(spark, {"a/x": "1", "b/c": "2"}))
    assert {r["path"]: r["change"] for r in snapshots.difference(one, two).collect()} == {"a": "removed", "a/x": "added"}
    none = snapshots.tree(lines(spark, {"a": "1"}).limit(0))
    assert {r["path"]: r["change"] for r in snapshots.difference(none, one).collect()} == {"a": "added", "b/c": "added"}


def test_tree_of_files(spark, tmp_path):
    (tmp_path / "t" / "b").mkdir(parents=True)
    for name in ("a.txt", "b/c.txt", ".hidden"):
        (tmp_path / "t" / name).write_text(name)
    found = snapshots.file_lines(landed.read_files(spark, str(tmp_path / "t")), f"file:{tmp_path}/t/")
    assert sorted(r["node"] for r in snapshots.tree(found).collect()) == ["", "a.txt", "b", "b/c.txt"]
