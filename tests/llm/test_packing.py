"""Packing: exact round trip of token ids, capacity, gapless offsets, and the bin structure against a plain search."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from quillfeed.llm import packing

SCHEMA = "doc_id long, text string, length string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_tokenizer())


def test_encoder_equals_the_library(tokenizer):
    rng = random.Random(1)
    alphabet = "aA é漢字\n\t .,'1١ß🙂ﬁ\u00a0\u2028<|endoftext|>ü"
    encode = packing.encoder(packing.default_tokenizer()).ids
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80)))
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    for text in ("x" * 5000, " " * 5000 + "y", "\n" * 3000, "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext", " <|endoftext|>\n"):
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_the_fast_path_is_proved(tokenizer):
    import json

    assert packing.proof(packing.default_tokenizer()) and packing.encoder(packing.default_tokenizer()).fast is not None
    spec = json.loads(tokenizer.to_str())
    merges = spec["model"]["merges"]
    merges[900], merges[30_000] = merges[30_000], merges[900]  # the order of merges is no longer that of the ids
    assert not packing.same_by_rank(Tokenizer.from_str(json.dumps(spec)))
    spec = json.loads(tokenizer.to_str())
    spec["pre_tokenizer"]["add_prefix_space"] = True
    assert not packing.same_by_rank(Tokenizer.from_str(json.dumps(spec)))


def test_every_character_is_cut_alike(tokenizer):
    """Both libraries agree on what each code point is: letter, number, space or other."""
    encode = packing.encoder(packing.default_tokenizer()).ids
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 20_000):
        text = "".join(f"a{chr(c)}1 {chr(c)}!" for c in points[a : a + 20_000])
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, hex(points[a])


def test_a_refused_text_goes_to_the_library(tokenizer):
    text = " " * 1_200_000 + "a"
    assert packing.encoder(packing.default_tokenizer()).ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_cut():
    assert packing.cut(5, 10) == [(0, 5)] and packing.cut(10, 10) == [(0, 10)]
    assert packing.cut(25, 10) == [(0, 5), (5, 10), (15, 10)] and packing.cut(20, 10) == [(0, 10), (10, 10)]


def test_best_fit_against_plain_search():
    rng = random.Random(2)
    bins, free, opened = packing.BestFit(20, 4), {}, set()
    for _ in range(2000):
        n = rng.randint(1, 20)
        fits = [b for b in opened if free[b] >= n]
        least = min((free[b] for b in fits), default=None)
        got, offset = bins.place(n)
        if fits:
            assert got in opened and free[got] == least
        else:
            assert got not in free
            if len(opened) >= 4:
                full = min(free[b] for b in opened)
                still = {s for stack in bins.stacks for s in stack}
                closed = [b for b in opened if b not in still]
                assert len(closed) == 1 and free[closed[0]] == full
                opened.discard(closed[0])
            free[got] = 20
        assert offset == 20 - free[got]
        free[got] -= n
        opened.add(got)
        if free[got] == 0:
            opened.discard(got)


def test_round_trip(spark, tokenizer):
    rng = random.Random(3)
    texts = ["", None, "one", "<|endoftext|>", *[" ".join(rng.choice(["alpha", "bêta", "γ", "42"]) for _ in range(rng.randint(1, 900))) for _ in range(60)], "word " * 9000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(3, "one", "again"), (None, "no id", "x")]
    out = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append(r)
    for i, t in enumerate(texts):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        own = sorted(pieces[i], key=lambda r: (r["piece"], r["start"]))
        if i != 3:
            assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
            for r in own:
                assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
            assert all(r["length"] == 2048 for r in own[1:])
    assert len(pieces[3]) == 2 and len(pieces[None]) == 1
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(bins) <= sum(r["length"] for r in out) / 2048 * 1.1 + 2


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []
