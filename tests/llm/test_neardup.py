"""Near-duplicates against brute force over all pairs, sketches against exact counts, and edges."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillfeed.llm import components, neardup
from quillfeed.llm.arrow import utf8_view
from quillfeed.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, cid string, kept string"


def brute_set(text, words):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1))


def brute(rows, words):
    sets = {i: brute_set(t, words) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, families=12):
    """Families of edited copies, chains of gradual edits, docs under a shared passage, exact copies and odd texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha Beta gamma délta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 60))
    texts = [None, "", "  \n", "one", "ONE", "one two", "one  two\x0b", "a b c d", "a b c d"]
    passage = [word() for _ in range(70)]
    for _ in range(families):
        base = [word() for _ in range(rng.randint(8, 120))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = word()
            texts.append((" " if rng.random() < 0.5 else "\n").join(copy))
        for _ in range(5):  # a chain
            base = list(base)
            base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
    for n in range(1, 40):
        texts.append(" ".join(passage + [word() for _ in range(n)]))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "words"), [(1, 4), (2, 5)])
def test_against_brute_force(spark, seed, words):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(df, words).collect()}
    for i, (n, root) in brute(rows, words).items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, root, i == root), rows[i]


def test_family_of_pooled_edits(spark):
    """Edits from a small pool: many members just below the bound, whose shingles all stand elsewhere."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        copy = list(base)
        for at in rng.sample(range(0, 120, 6), rng.randint(3, 7)):
            copy[at] = f"pool{at}-{rng.randint(0, 1)}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, 4).collect()}
    assert got == {i: root for i, (_, root) in brute(rows, 4).items()}


def test_shingles_of_long_texts_are_whole():
    import pyarrow as pa

    rng = random.Random(8)
    long = " ".join(f"w{rng.randint(0, 9)}" for _ in range(400_000)) + " " + "z" * 3_000_000 + "\tend of it"
    arrays = pa.array(["x", long, None, ""])
    whole = [len(s) for s in shingle_sets(*utf8_view(arrays), 4)]
    alone = [len(s) for s in shingle_sets(*utf8_view(pa.array([long] * 1)), 4)]
    forced = len(next(shingle_sets(*utf8_view(pa.array([long * 3])), 4)))
    assert whole == [1, len(brute_set(long, 4)), 0, 0] and alone == [whole[1]] and forced == len(brute_set(long * 3, 4))


def test_sketches():
    rng = np.random.default_rng(9)
    for share in (0.5, 0.8, 0.95):
        a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        b = a.copy()
        swap = int(2000 * (1 - share) / (1 + share))
        b[:swap] = rng.integers(0, 1 << 63, swap, dtype=np.uint64)
        bits = int(np.bitwise_count(neardup.odd_sketch(neardup.minhash(a)) ^ neardup.odd_sketch(neardup.minhash(b))).sum())
        estimate = 1 + 0.5 * np.log(max(1e-9, 1 - bits / 128))
        assert abs(estimate - share) < 0.2
        x, y = (np.frombuffer(neardup.set_sketch(s), np.uint64) for s in (a, b))
        assert int(np.bitwise_count(x ^ y).sum()) <= 2 * swap  # never more than the sets differ


def test_components(spark):
    rng = random.Random(10)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(500 + i, 501 + i) for i in range(40)] + [(700, 700 + i) for i in range(1, 50)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert {x: got.get(x, x) for x in root} == {x: find(x) for x in root}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_edges(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (2, "A B c d e f"), (None, "a b c d e f"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in neardup.near_duplicates(df, 4).collect())
    assert got == [(-1, None, True), (2, 2, True), (5, 2, False), (5, 2, False), (9, 9, True)]
    assert neardup.near_duplicates(df.limit(0), 4).collect() == []


def test_sets_that_share_64_bits_of_digest(spark):
    signed = spark.createDataFrame(
        [(1, 7, 1), (2, 7, 2), (3, 7, 2), (4, 7, None), (5, 8, 1), (6, None, None)], "doc_id long, cid long, more long"
    ).withColumn("more", F.coalesce("more", F.when(F.col("cid").isNotNull(), 1)))
    got = {r["doc_id"]: r["cid"] for r in neardup.unique_classes(signed).collect()}
    assert got[1] == got[4] == 7 and got[2] == got[3] != 7 and (got[5], got[6]) == (8, None)
