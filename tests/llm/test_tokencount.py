"""Token counts against the library itself, for two vocabularies; long words; odd tables; bounded memory."""

import random
import time

import pytest
from tokenizers import Tokenizer

from quillfeed.llm import registry, tokencount

SF = "/root/testdata/sf0.001"
ODD = ["a", "A", " ", "é", "漢", "字", "\n", "\t", " ", ".", ",", "'", "1", "١", "ß", "🙂", "ﬁ", " ", " ", "<|endoftext|>", "ü", "the ", "ing", " re", "\r\n", "'s", "  ", "\x1c", "\x85", "​", "\0", "é"]


def vocabulary(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_random_texts(name):
    library, own, rng = Tokenizer.from_file(vocabulary(name)), tokencount.counter(vocabulary(name)), random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 60)))
        assert own.count(text) == count(library, text), text


def test_every_character_is_cut_alike():
    library, own = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), tokencount.counter(vocabulary("byte_bpe_50k.json"))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 20_000):
        text = "".join(f"a{chr(c)}1 {chr(c)}!" for c in points[a : a + 20_000])
        assert own.count(text) == count(library, text), hex(points[a])


def test_long_words():
    library, own, rng = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), tokencount.counter(vocabulary("byte_bpe_50k.json")), random.Random(2)
    for text in ("x" * 5000, "ab" * 100_000, " " * 100_000 + "y", "\n" * 3000, "".join(rng.choice("abcdeth") for _ in range(100_000)), "é" * 9000):
        assert own.count(text) == count(library, text)
    began = time.perf_counter()
    own.count("ab" * 500_000)
    assert time.perf_counter() - began < 30


def test_ranks_that_fall_while_merging():
    """A vocabulary whose later merges have lower ranks: the lowest rank of all goes first at every step."""
    rng = random.Random(4)
    for _ in range(200):
        made, pairs = list("abc"), []
        for _ in range(8):
            pairs.append((rng.choice(made), rng.choice(made)))
            made.append("".join(pairs[-1]))
        rng.shuffle(pairs)
        pairs = list(dict.fromkeys(pairs))
        rank = {p: i for i, p in enumerate(pairs)}
        merges = tokencount.Merges(pairs)
        for _ in range(20):
            chain = [rng.choice("abc") for _ in range(rng.randint(0, 30))]
            got = merges.tokens(list(chain))
            while True:
                found = min(((rank[p], i) for i, p in enumerate(zip(chain, chain[1:], strict=False)) if p in rank), default=None)
                if found is None:
                    break
                chain[found[1] : found[1] + 2] = ["".join(chain[found[1] : found[1] + 2])]
            assert got == len(chain)


def test_memory_starts_anew():
    counts = tokencount.Counts(len, kept=10)
    assert [counts["x" * i] for i in range(1, 40)] == list(range(1, 40)) and len(counts) <= 10
    assert counts["y" * 5000] == 5000 and "y" * 5000 not in counts


def test_other_files_are_refused(tmp_path):
    import json

    spec = json.loads(Tokenizer.from_file(vocabulary("byte_bpe_50k.json")).to_str())
    spec["model"]["dropout"] = 0.1
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        tokencount.TokenCounter(str(tmp_path / "t.json"))


def test_query_against_the_library(spark):
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = sorted((r["doc_id"], len((r["text"] or "").encode()), count(library, r["text"] or "")) for r in rows)
    got = registry.op13_token_counts(spark, SF).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


def test_odd_tables(spark):
    rows = [(None, None, 1), ("a", "", 2), ("a", "", 2), ("b", "word " * 600, 3), ("c", "<|endoftext|>", 4)]
    df = spark.createDataFrame(rows, "doc_id string, text string, n_tokens int")
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokencount.token_counts(df).collect()), key=repr)
    long = count(Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), "word " * 600)
    assert got == sorted([(None, 0, 0, False), ("a", 0, 0, False), ("a", 0, 0, False), ("b", 3000, long, True), ("c", 13, 1, False)], key=repr)
    assert tokencount.token_counts(df.limit(0)).collect() == []
