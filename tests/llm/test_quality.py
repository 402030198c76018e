"""Quality: held-out labels, shrinkage by hand, edges."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from quillfeed.llm import language, quality, skew
from quillfeed.session import read_table

SCHEMA = "doc_id long, text string, source string, score string"


def test_held_out(spark, sf="/root/testdata/sf0.01"):
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    learn = language.train_rows(F.col("doc_id"), 3, 1)
    out = quality.classify(docs, labels.filter(learn)).join(labels.filter(~learn), "doc_id")
    right, n = out.agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("double")), F.count(F.lit(1))).first()
    assert n > 80 and right > 0.93


def test_sites_shrink(spark):
    """A sparse path stays near its host; a rich one follows its own documents."""
    good, bad = "plain words in a calm line of text here", "@@@ ### $$$ %%% ^^^ &&& ***"
    rows, labels = [], []
    add = lambda text, site, n: rows.extend((len(rows) + i, text, site, "x") for i in range(n))
    add(good, "a.org/rich", 200)
    add(bad, "a.org/spam", 200)
    add(bad, "a.org/one", 1)
    add(good, "b.org/x/deeper", 100)
    rows = [(i, r[1], r[2], r[3]) for i, r in enumerate(rows)]
    labels = [(i, int(r[1] == good)) for i, r in enumerate(rows) if i % 2 == 0]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {(r["host"], r["path"]): r["site_rate"] for r in quality.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert set(got) == {("a.org", "rich"), ("a.org", "spam"), ("a.org", "one"), ("b.org", "x/deeper")}
    assert got["a.org", "spam"] < got["a.org", "one"] < got["a.org", "rich"] and 0 < min(got.values()) < max(got.values()) < 1


def plain_rates(rows):
    """(site rate of each row) restated with dictionaries: rows are (host, section, path, p)."""
    overall = sum(r[3] for r in rows) / len(rows)
    rates = [overall] * len(rows)
    level_rate = {(): overall}
    for depth in (1, 2, 3):
        sums = {}
        for r in rows:
            n, good = sums.get(r[:depth], (0, 0.0))
            sums[r[:depth]] = (n + 1, good + r[3])
        kids = Counter(k[:-1] for k in sums)
        own = {k: kids[k[:-1]] > 1 for k in sums}
        wide = [(n, g / n, level_rate[k[:-1]]) for k, (n, g) in sums.items() if n >= 2 and own[k]]
        within = sum(m * (1 - m) for _, _, m in wide)
        strength = 20.0
        if len(wide) >= 2 and within:
            variance = max(1e-9, (sum(n * (r - m) ** 2 for n, r, m in wide) - within) / sum(n for n, _, _ in wide))
            strength = min(1e4, max(1.0, within / len(wide) / variance))
        rates = [
            (sums[r[:depth]][1] - r[3] + rate * strength) / (sums[r[:depth]][0] - 1 + strength) if own[r[:depth]] else rate
            for r, rate in zip(rows, rates, strict=True)
        ]
        level_rate = {k: (g + level_rate[k[:-1]] * strength) / (n + strength) if own[k] else level_rate[k[:-1]] for k, (n, g) in sums.items()}
    return overall, rates


def test_site_rates_against_plain_sums(spark):
    rng = random.Random(5)
    sites = ["a.org", "a.org/x", "a.org/x/y", "a.org/x/y/z", "a.org/w/q", "b.org", "c.org/only/this", "d.org/s/1", "d.org/s/2", "d.org/t"]
    rows = []
    for i in range(300):
        site = rng.choice(sites)
        text = " ".join(rng.choice(["word", "line", "calm"] if rng.random() < sites.index(site) / 10 else ["@@", "##", "9!"]) for _ in range(rng.randint(1, 20)))
        rows.append((i, text, site, "x"))
    labels = [(i, int("word" in t)) for i, t, _, _ in rows if i % 2]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r for r in quality.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    split = lambda site: (site.split("/")[0], *(site.split("/") + [""])[1:2], "/".join(site.split("/")[1:]))
    overall, want = plain_rates([(*split(site), 1 / (1 + math.exp(-got[i]["evidence"]))) for i, _, site, _ in rows])
    for (i, _, site, _), rate in zip(rows, want, strict=True):
        assert abs(got[i]["site_rate"] - rate) < 1e-9, site
        z = got[i]["evidence"] + math.log(rate / (1 - rate)) - math.log(overall / (1 - overall))
        assert abs(got[i]["score"] - 1 / (1 + math.exp(-z))) < 1e-9
    assert len({r["site_rate"] for r in got.values() if r["host"] == "c.org"}) > 1  # its own evidence is taken out


def test_hot_keys_are_dealt(spark):
    many = spark.createDataFrame([(1 if i % 3 == 0 else i, i) for i in range(300)] + [(None, 7)], "k long, v long")
    one = spark.createDataFrame([(i, f"one{i}") for i in range(300)], "k long, w string")
    got = sorted(tuple(r) for r in skew.join_dealt(many, one, ["k"], "v", rows=10).collect())
    assert got == sorted((1 if i % 3 == 0 else i, i, f"one{1 if i % 3 == 0 else i}") for i in range(300))


def test_edges(spark):
    rows = [(1, None, None, "x"), (2, "", "", "x"), (3, "word " * 400_000, "h/p", "x"), (3, "word", "h/p", "x"), (None, "word", "h", "x")]
    docs, none = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], "doc_id long, quality int")
    got = quality.classify(docs, none).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.classify(docs.limit(0), none).collect() == []
