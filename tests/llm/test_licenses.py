"""License scans against plain loops over words, and fuzzy finds against planted edits."""

import random
import re

from quillfeed.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), sorted(found)


def texts():
    rng = random.Random(4)
    pool = ["GNU", "General", "public", "license", "Apache", "MIT", "cc", "CC-BY", "by", "é", "x1", "License.", "—", "\n", "gnu general public license", "apache_license", "ÀMIT license"]
    return [None, "", " ", "cc by", "CC-BY 4.0", *(rng.choice([" ", "-", "  "]).join(rng.choice(pool) for _ in range(rng.randint(1, 30))) for _ in range(300))]


def test_base_against_brute_force(spark):
    rows = [(i, t, "clash") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    for i, t, _ in rows:
        n, found = brute(t)
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (n, len(found)), t
        assert (r["first_word"], r["last_word"]) == ((found[0][0], found[-1][0]) if found else (None, None)), t
        assert r["base_labels"] == ",".join(sorted({label for _, label in found}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1.0) == bool(found) or not found


def test_fuzzy_finds_planted_edits():
    rng = random.Random(5)
    for notice, label in licenses.NOTICES.items():
        edits = len(notice) // licenses.CHARACTERS_PER_EDIT
        for _ in range(6):
            chars = list(notice)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(1, len(chars) - 1)
                chars[at] = rng.choice("abcxyz")
            words = ["lead", "words", "here"]
            out = licenses.scan_text((" ".join(words) + ", " + "".join(chars) + "! trailing").encode())
            hit = [n for n in out["notices"] if n[0] == label]
            assert hit and any(abs(n[1] - 3) <= 1 for n in hit), (notice, "".join(chars))
            assert all(n[3] <= edits for n in hit) or label in ("mit-notice", "gpl-notice", "cc-notice")


def test_overlapping_finds_keep_the_fewest_edits():
    assert licenses._apart([(2, 0, 10), (1, 8, 18), (1, 17, 27), (0, 30, 40), (0, 30, 40), (3, 39, 50)]) == [(1, 8, 18), (0, 30, 40)]
    search = licenses.NoticeSearch({"all rights reserved": "x"})
    found = search.find("all rights reserved all rightz reserved al rights reserved")
    assert [(f[1], f[3]) for f in found] == [(0, 0), (20, 1), (40, 1)]


def test_fuzzy_search_against_edit_distances():
    """Each find is within its bound, and a place within the bound that no find covers does not exist."""
    rng = random.Random(6)
    notice, edits = "all rights reserved", 1
    search = licenses.NoticeSearch({notice: "x"})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for _ in range(120):
        parts = []
        for _ in range(rng.randint(1, 3)):
            chars = list(notice)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(chars))
                chars[at : at + 1] = rng.choice([[], [rng.choice("abz")], [chars[at], "q"]])
            parts.append("".join(chars))
        text = rng.choice([" ", " so ", ""]).join(parts)
        found = search.find(text)
        for _, a, b, n in found:
            assert distance(text[a:b], notice) <= n <= edits
        for a in range(len(text)):
            for b in range(a + len(notice) - edits, min(len(text), a + len(notice) + edits) + 1):
                if distance(text[a:b], notice) <= edits:
                    assert any(x < b and a < y for _, x, y, _ in found), (text, a, b)


def test_clean_text_has_no_notice():
    out = licenses.scan_text(b"the quick brown fox jumps over the lazy dog " * 500)
    assert out["notices"] == [] and out["n_words"] == 4500


def test_edges(spark):
    df = spark.createDataFrame([(1, "MIT license"), (1, "MIT license"), (None, "y " * 2_000_000)], "doc_id long, text string")
    got = licenses.scan(df).collect()
    assert sorted((r["doc_id"] is None, r["n_base"], r["n_words"]) for r in got) == [(False, 1, 2), (False, 1, 2), (True, 0, 2_000_000)]
    assert licenses.scan(df.limit(0)).collect() == []


def test_spans_in_words_of_long_texts_in_linear_time():
    """10 MB of notices: each span maps to the words it stands on, in time that grows as the text."""
    import time

    began = time.perf_counter()
    found = licenses.scan_text(b"all rights reserved\n" * 520_000)
    assert time.perf_counter() - began < 150
    assert len(found["notices"]) == 520_000 and found["n_words"] == 1_560_000
    assert all(n[1:4] == (3 * i, 3 * i + 2, 0) for i, n in enumerate(found["notices"]))
    rng, words = random.Random(9), ["é漢字", "foo", "ñ", *licenses.NOTICES]
    for _ in range(100):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", ", ", "\n"]) for _ in range(rng.randint(0, 30)))
        text = "".join(c for c in text if rng.random() > 0.02)
        squeezed = " ".join(WORD.findall(text.translate(LOWER)))
        want = [(squeezed.count(" ", 0, a), squeezed.count(" ", 0, b), e) for _, a, b, e in licenses.search().find(squeezed)]
        assert [n[1:4] for n in licenses.scan_text(text.encode())["notices"]] == want
