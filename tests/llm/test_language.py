"""Language identification: held-out accuracy, and edges."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from quillfeed.llm import language
from quillfeed.session import read_table

SCHEMA = "doc_id long, text string, lang string, score string"


def test_held_out_accuracy(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    learn = language.train_rows(F.col("doc_id"), 3, 1)
    model = language.train(docs.filter(learn))
    right = language.identify(docs.filter(~learn), model).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_ngrams_do_not_depend_on_neighbours():
    of = lambda texts, i: [sorted(b[o == i].tolist()) for b, o in language.ngram_buckets(texts)]
    many = ["xyz", "", "abc d", "12", "abc d"]
    assert of(many, 2) == of(many, 4) == of(["abc d"], 0) and of(many, 3) == of(many, 1) == [[], [], []]


def test_parts_of_a_long_text_are_the_whole(spark):
    rng = random.Random(3)
    for n in (1, 5, 50, 333):
        text = "".join(rng.choice("abé ß1.\n漢 ") for _ in range(n))
        whole = sorted(b for bucket, _ in language.ngram_buckets([text]) for b in bucket.tolist())
        for part in (1, 2, 3, 7, 64):
            assert whole == sorted(b for bucket, _ in language.ngram_buckets([text], part=part) for b in bucket.tolist()), (n, part)


def test_model_against_plain_naive_bayes(spark):
    """Counts, priors and posteriors of a plain multinomial naive Bayes over the same buckets, with the stated tempering."""
    rng = random.Random(4)
    pool = {"de": "der die das und ist süß", "en": "the of and that is in", "fr": "le la les des été où"}
    rows = [(i, " ".join(rng.choice(pool[lang].split()) for _ in range(rng.randint(1, 30))), lang, "") for i, lang in enumerate(rng.choices([*pool], [5, 3, 1], k=120))]
    model = language.train(spark.createDataFrame(rows, SCHEMA))

    def grams(text):
        t = "  " + "".join(c if c.isalpha() else " " for c in text.lower()) + "  "
        for n in (1, 2, 3):
            for k in range(len(t) - n + 1):
                if any(c != " " for c in t[k : k + n]):
                    h = n
                    for c in t[k : k + n]:
                        h = ((h ^ ord(c)) * 0x9E3779B1) & 0xFFFFFFFF
                        h ^= h >> 15
                    yield h % language.BUCKETS

    counts = {lang: Counter(g for _, t, own, _ in rows if own == lang for g in grams(t)) for lang in pool}
    total = {lang: sum(c.values()) + 0.5 * language.BUCKETS for lang, c in counts.items()}
    prior = Counter(lang for _, _, lang, _ in rows)
    probes = ["die süße und der", "the end is in that", "où est la", "x", "und the la"]
    langs, scores = model.predict(probes)
    for text, lang, score in zip(probes, langs, scores, strict=True):
        found = [*grams(text)]
        weight = 64 / max(64, len(found))
        log = {k: math.log(prior[k] / len(rows)) + weight * sum(math.log((counts[k][g] + 0.5) / total[k]) for g in found) for k in sorted(pool)}
        best = max(log, key=log.get)
        share = 1 / sum(math.exp(v - log[best]) for v in log.values())
        assert lang == best and abs(score - share) < 1e-9


def test_edges(spark):
    rows = [(1, "der die das und nicht", "de", "x"), (2, "the and of that with", "en", "x"), (3, None, "en", "x"), (4, "", None, "x"), (5, "123 !?", "de", "x"), (None, "the of", None, "x"), (2, "the and of that with", "en", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language.train(df)
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in language.identify(df, model).collect()}
    assert got[1, rows[0][1]][0] == "de" and got[2, rows[1][1]][0] == "en" and got[None, "the of"][0] == "en"
    assert got[3, None] == got[4, ""] == got[5, "123 !?"] == ("und", 0.0)
    assert language.identify(df.limit(0), model).collect() == []
    nothing = language.train(df.limit(0))
    assert {r["lang_pred"] for r in language.identify(df, nothing).collect()} == {"und"}
    assert language.keep(df, model, 0.5).columns == df.columns and language.keep(df, model, 0.5).count() == 4


def test_long_text(spark):
    df = spark.createDataFrame([(1, "the and of " * 300_000, "en", ""), (2, "der und die", "de", "")], SCHEMA)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, language.train(df)).collect()}
    assert got == {1: "en", 2: "de"}
