"""Checkpoint states as rows against the same rules on dicts, and as stream state against a batch."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillfeed.operators import select, states
from quillfeed.streaming import checkpoints


def good(**more):
    gap = {"post_id": "3", "declared_count": 5, "visible_count": 3, "unavailable_count": 2, "count_source": "timeline"}
    return select.initial_checkpoint("7") | {"post_reply_counts": {"1": 4, "22": 0}, "scanned_post_ids": ["1", "2"], "latest_post_id": "2", "comment_visibility_gaps": [gap]} | more


def random_state(rng):
    state = good()
    odd = [None, 1, 1.0, 2, -1, 1.5, "", "7", "x", "0012", [], ["1", "1"], ["1", 2], ["1", "x"], {}, {"1": -1}, {"a": 1}, {"5": 1.0}, {"5": "1"}, {"5": None}, True, 2**53, "two\nlines"]
    for _ in range(rng.randint(0, 3)):
        name = rng.choice(list(state))
        if rng.random() < 0.2:
            state.pop(name)
        else:
            state[name] = rng.choice(odd)
    if rng.random() < 0.5 and isinstance(state.get("comment_visibility_gaps"), list):
        gaps = [dict(good()["comment_visibility_gaps"][0], post_id=str(i)) for i in range(rng.randint(0, 3))]
        for g in gaps:
            if rng.random() < 0.4:
                key = rng.choice([*g, "more"])
                g[key] = rng.choice([*odd, 3, 5, "comment_endpoint_final_page"])
                if rng.random() < 0.3:
                    g.pop(key)
        state["comment_visibility_gaps"] = gaps + gaps[:1] * rng.choice([0, 0, 1])
    return state


def plain(state):
    """The rules on a dict, where booleans are no numbers and whole numbers end at 2^53 - 1."""

    def numbers(x):
        if isinstance(x, dict):
            return {k: numbers(v) for k, v in x.items()}
        if isinstance(x, list):
            return [numbers(v) for v in x]
        if isinstance(x, bool):
            return 0.5
        if isinstance(x, float) and x.is_integer():
            x = int(x)
        return -1 if isinstance(x, int) and x > 2**53 - 1 else x

    state = numbers(state)
    gaps = state.get("comment_visibility_gaps", [])
    if isinstance(gaps, list) and not all(isinstance(g, dict) for g in gaps):
        state = state | {"comment_visibility_gaps": None}
    return select.checkpoint_violations(state, "7")


def test_random_states_against_dicts(spark):
    rng = random.Random(20)
    made = [good(), *(random_state(rng) for _ in range(600))]
    df = spark.createDataFrame([(i, json.dumps(s), 7) for i, s in enumerate(made)], "i int, state string, user_id int")
    got = {r["i"]: r["violations"] for r in states.judged_states(df).collect()}
    wrong = [(s, got[i], plain(s)) for i, s in enumerate(made) if got[i] != plain(s)]
    assert not wrong, wrong[0]
    assert got[0] == [] and sum(bool(v) for v in got.values()) > 200


def test_texts_that_are_no_states(spark):
    unnamed = {k: v for k, v in good().items() if k != "user_id"}
    rows = [(None,), ("",), ("[]",), ("1",), ("{",), ("{}",), (json.dumps(unnamed),), (json.dumps(good(user_id="8")),)]
    got = [(r["violations"], r["starts_anew"]) for r in states.judged_states(spark.createDataFrame(rows, "state string").withColumn("user_id", F.lit("7"))).collect()]
    assert [g[0] for g in got[:5]] == [["not_an_object"]] * 5 and len(got[5][0]) == 8
    assert got[6] == ([], True) and got[7] == (["user_id"], False) and not any(g[1] for g in got[:6])


HOUR = 3_600_000


def seen_rows(seed, n=400):
    rng, t = random.Random(seed), 1_700_000_000
    rows = []
    for i in range(n):
        t += rng.choice([0, 60, 600, 3000])
        rows.append((rng.randint(1, 3), f"p{rng.randint(1, 4)}", t, i, rng.randint(0, 2)))
    return rows


def observed(df):
    return checkpoints.observations(df, F.col("u"), F.col("p"), F.timestamp_seconds("t"), F.col("i"), F.col("c"))


@pytest.mark.parametrize("restart", [False, True])
def test_stream_state_equals_the_batch_and_survives_a_restart(spark, tmp_path, restart):
    schema, rows = "u int, p string, t long, i long, c int", seen_rows(3)
    folder, out, at = (str(tmp_path / n) for n in ("in", "out", "state"))

    def land(a, b):
        for k in range(a, b):
            spark.createDataFrame(rows[k * 40 : (k + 1) * 40], schema).coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = observed(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder))
        with checkpoints.state_store(spark):
            changed = checkpoints.changes_on_stream(stream, HOUR)
            changed.writeStream.format("parquet").option("path", out).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()

    for a, b in ((0, 4), (4, 10)) if restart else ((0, 10),):
        land(a, b)
        run()
    key = lambda df: sorted(((r["user_id"], r["post_id"], r["time_ms"], r["seq"], r["previous_count"], r["reply_count"]) for r in df.collect()), key=repr)
    want = key(checkpoints.changes(observed(spark.createDataFrame(rows, schema)), HOUR))
    assert key(spark.read.parquet(out)) == want and 100 < len(want) < 400
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_posts_share_buckets_of_state_and_leave_them(spark, tmp_path):
    """Three buckets hold all posts over four micro-batches; those past their lookback are gone at the end. Nulls are values."""
    huge, at0 = 1 << 60, seen_rows(4)[0][2]
    odd = [(None, "p1", at0, huge + 1, 0), (None, "p1", at0, huge + 2, 0), (None, "p1", at0 + 60, huge + 3, None), (1, None, at0, None, 5), (1, None, at0, huge + 5, 5)]
    odd += [(2, "p9", None, huge + 7, 1), (2, "p9", None, None, 1)]
    schema, rows = "u int, p string, t long, i long, c int", odd + seen_rows(4)
    folder, out, at = (str(tmp_path / n) for n in ("in", "out", "state"))
    for k in range(4):
        spark.createDataFrame(rows[k * 110 : (k + 1) * 110], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = observed(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder))
    with checkpoints.state_store(spark):
        changed = checkpoints.changes_on_stream(stream, HOUR, buckets=3)
        run = changed.writeStream.format("parquet").option("path", out).option("checkpointLocation", at).trigger(availableNow=True).start()
        run.awaitTermination()
        held = spark.read.format("statestore").option("stateVarName", "last").load(at).select(F.explode("value.posts.time_ms").alias("t")).collect()
    key = lambda df: sorted(((r["user_id"], r["post_id"], r["time_ms"], r["seq"], r["previous_count"], r["reply_count"]) for r in df.collect()), key=repr)
    assert key(spark.read.parquet(out)) == key(checkpoints.changes(observed(spark.createDataFrame(rows, schema)), HOUR))
    assert max(s["numRowsTotal"] for p in run.recentProgress for s in p["stateOperators"]) <= 3
    watermark = (max(r[2] for r in rows if r[2] is not None) - 600) * 1000
    assert held and all(r["t"] + HOUR >= watermark for r in held)


def test_changes_by_hand(spark):
    rows = [(1, "a", 0, 1, 5), (1, "a", 10, 2, 5), (1, "a", 20, 3, 6), (1, "a", 20 + 3601, 4, 6), (1, "b", 5, 5, 5), (2, "a", 5, 6, 5)]
    got = {r["seq"]: r["previous_count"] for r in checkpoints.changes(observed(spark.createDataFrame(rows, "u int, p string, t long, i long, c int")), HOUR).collect()}
    assert got == {1: None, 3: 5, 4: None, 5: None, 6: None}


def test_a_digest_does_not_depend_on_partitions_where_the_order_ties(spark):
    rows = [(i % 2, i % 3, f"v{i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "s int, o int, v string")
    digest = lambda d: sorted(tuple(r) for r in select.ordered_digest(d, "s", ["o"], "o", "v", block=8).collect())
    assert digest(df.coalesce(1)) == digest(df.repartition(5)) == digest(df.orderBy(F.rand(3)))
