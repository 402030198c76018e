"""Toxicity: held-out labels, the grammar's clauses, learned stems, and edges."""

import random

from pyspark.sql import functions as F

from quillfeed.llm import language, toxicity
from quillfeed.session import read_table


def clauses(text, stems=None):
    return toxicity.clause_weights(text, toxicity.Lexicon(stems), toxicity.grammar())


def test_grammar():
    bare, aimed = clauses("what an idiot"), clauses("you are an idiot")
    assert len(bare) == 1 and aimed[0] > bare[0]
    assert clauses("you are not an idiot")[0] < aimed[0]
    assert clauses("he said you are an idiot")[0] < aimed[0]
    assert clauses("I will kill you") == [1.2] and clauses("kill them") == [0.8] and clauses("we shall murder the neighbours") == [0.5]
    assert clauses("I won't, no, not kill you") == [1.2 * 0.4] and clauses("kill, idiot") == [1.8]
    assert clauses("idiots like you") == [1.5] and clauses("an idiot went a long way to you") == [1.0]
    assert clauses("kill the process") == [] and clauses("") == [] and clauses("fine words. more of them") == []
    assert len(clauses("idiot. scum!")) == 2


def test_composition_multiplies_weights():
    assert abs(clauses("he said you are not an idiot")[0] - 0.5 * 0.4 * 1.5) < 1e-9


def test_typographic_apostrophes():
    assert clauses("you aren’t an idiot") == clauses("you aren't an idiot") == [1.5 * 0.4]
    assert clauses("we’ll kill you") == [1.2]


def plain_weight(classes):
    """What a clause weighs, restated as a search around each insult and threat instead of a machine."""
    total, waiting = 0.0, []
    back = lambda i, c: c in classes[max(0, i - 4) : i]
    factor = lambda i: (0.4 if back(i, "n") else 1.0) * (0.5 if "r" in classes[:i] else 1.0)
    for i, c in enumerate(classes):
        if c == "i":
            after = next((k for k in range(i + 1, len(classes)) if classes[k] in "ih"), None)
            aimed = back(i, "h") or (after is not None and classes[after] == "h" and after - i <= 4)
            total += (1.5 if aimed else 1.0) * factor(i)
        if c == "t":
            whole = 1.2 if back(i, "f") else 0.8
            if any(x in "ih" for x in classes[:i]):
                total += whole * factor(i)
                continue
            now = 0.5 if back(i, "f") else 0.0
            total += now * factor(i)
            waiting.append((i, (whole - now) * factor(i)))
    first = next((k for k, c in enumerate(classes) if c in "ih"), None)
    before = [w for i, w in waiting if first is not None and i < first]
    return total + max(before, default=0.0)


def test_machine_against_a_plain_search():
    rng, machine = random.Random(9), toxicity.grammar()
    for _ in range(4000):
        classes = [rng.choice("ooooithnrf") for _ in range(rng.randint(0, 14))]
        state, total = machine.start, 0.0
        for c in classes:
            state, _, weight = machine.step(state, c)
            total += weight
        assert abs(total - plain_weight(classes)) < 1e-9, classes
    assert len(machine.arcs) < 20_000


def test_learned_stems(spark):
    spell = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    filler = [f"mot{spell(i)} lieu soir{spell(i)}" for i in range(400)]
    rows = [(i, f"{filler[i]} zorbi{chr(97 + i % 26)} {filler[-i - 1]}", 1) for i in range(100)] + [(1000 + i, f"{filler[i]} rien", 0) for i in range(300)]
    rows += [(2000 + i, "always the very same copied passage blurgh here", 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows], "doc_id long, text string, toxic_score string")
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert any("zorbia".startswith(s) for s in model.lexicon.stems)
    assert not any("blurgh".startswith(s) for s in model.lexicon.stems)
    got = {r["doc_id"]: r["toxic_score"] for r in toxicity.score(docs, model).select("doc_id", "toxic_score").collect()}
    assert got[5] > 0.5 > got[1005]


def test_held_out(spark, sf="/root/testdata/sf0.1"):
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    learn = language.train_rows(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs, labels.filter(learn))
    held = toxicity.score(docs.filter(~learn).select("doc_id", "text"), model).join(labels, "doc_id")
    right, n = held.agg(F.avg(((F.col("toxic_score") >= 0.5).cast("int") == F.col("toxic")).cast("double")), F.count(F.lit(1))).first()
    assert n > 500 and right > 0.97


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "you idiot", "x"), (3, "fine", "x"), (3, "fine", "x"), (4, "x " * 500_000 + "you idiot", "x")], "doc_id long, text string, n_clauses string")
    model = toxicity.Model()
    got = {(r["doc_id"], (r["text"] or "")[:5]): r["toxic_score"] for r in toxicity.score(df, model).collect()}
    assert got[1, ""] == got[2, ""] == got[3, "fine"] < 0.5 < got[None, "you i"] and got[4, "x x x"] > 0.5
    assert toxicity.score(df.limit(0), model).collect() == []
    assert toxicity.train(df, spark.createDataFrame([], "doc_id long, toxic int")).slopes == model.slopes
    kept = toxicity.keep(df, model, 0.5)
    assert kept.columns == df.columns and kept.count() == 4
