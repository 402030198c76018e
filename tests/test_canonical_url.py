"""Canonical URLs: a written table of cases, and random links against a plain Python twin of the URL standard's rules."""

import random
import re

from pyspark.sql import functions as F

from quillfeed.functions import ids

TABLE = {
    "https://example.com": "https://example.com/",
    "HTTP://WWW.Example.COM/A": "https://www.example.com/A",
    "//a.example.com/x": "https://a.example.com/x",
    "////a.example.com/x": "https://a.example.com/x",
    "/x/y": "https://example.com/x/y",
    "x/y?q#f": "https://example.com/x/y?q#f",
    "?q=1": "https://example.com/?q=1",
    "#top": "https://example.com/#top",
    "https://example.com/?": "https://example.com/?",
    "https://example.com/#": "https://example.com/#",
    "https://example.com:443/a": "https://example.com/a",
    "https://example.com:/a": "https://example.com/a",
    "https://example.com:8443/a": None,
    "https://user@example.com/": None,
    "https://user:pw@example.com/": None,
    "https://@example.com/a": "https://example.com/a",
    "https://:@example.com/a": "https://example.com/a",
    "https://evil.com/": None,
    "https://notexample.com/": None,
    "https://example.com.evil.com/": None,
    "https://evil.com\\@example.com/": None,
    "\\\\evil.com/a": None,
    "/\\a.example.com/b": "https://a.example.com/b",
    "ftp://example.com/": None,
    "javascript:alert(1)": None,
    "https:foo": "https://example.com/https:foo",
    "https://": None,
    "https://ex ample.com/": None,
    "https://%65xample.com/": None,
    "https://ä.example.com/": None,
    "https://example.com/a/./b": "https://example.com/a/b",
    "https://example.com/a/../b": "https://example.com/b",
    "https://example.com/a/b/..": "https://example.com/a/",
    "https://example.com/a/b/.": "https://example.com/a/b/",
    "https://example.com/../../a": "https://example.com/a",
    "https://example.com/..": "https://example.com/",
    "https://example.com/a/%2E%2e/b": "https://example.com/b",
    "https://example.com/a/.%2E/%2e/b": "https://example.com/b",
    "https://example.com/a//../b": "https://example.com/a/b",
    "https://example.com/a/...": "https://example.com/a/...",
    "https://example.com/.a/..b/c.": "https://example.com/.a/..b/c.",
    "https://example.com/a\\..\\b": "https://example.com/b",
    "https://example.com/a b": "https://example.com/a%20b",
    'https://example.com/"<>`{}^|': "https://example.com/%22%3C%3E%60%7B%7D%5E|",
    "https://example.com/é漢🙂": "https://example.com/%C3%A9%E6%BC%A2%F0%9F%99%82",
    "https://example.com/%zz%4a": "https://example.com/%zz%4a",
    "https://example.com/?a b'\"<>`{}^\\é": "https://example.com/?a%20b%27%22%3C%3E`{}^\\%C3%A9",
    "https://example.com/#a b'\"<>`{}^\\#é": "https://example.com/#a%20b'%22%3C%3E%60{}^\\#%C3%A9",
    "https://example.com/a?b/../c#d/../e": "https://example.com/a?b/../c#d/../e",
    "ht\ttps://exa\nmple.com/a\rb": "https://example.com/https://example.com/ab",  # the scheme is looked for before tabs go
    "https://exa\nmple.com/a\rb": "https://example.com/ab",
    "  https://example.com/x \n": "https://example.com/x",
    "https://example.com/\x01\x7f": "https://example.com/%01%7F",
    "": None,
    "   ": None,
}


def twin(link, domain="example.com"):
    t = link.strip(" \t\n\x0b\x0c\r")
    if not t or (re.match(r"(?i)[a-z][a-z0-9+.-]*:", t) and not re.match(r"(?i)https?:", t)):
        return None
    absolute = bool(re.match(r"(?i)https?://", t))
    t = re.sub("[\t\n\r]", "", t)
    cut = min((i for i in (t.find("?"), t.find("#")) if i >= 0), default=len(t))
    head, rest = t[:cut].replace("\\", "/"), t[cut:]
    if absolute:
        head = head[head.index(":") + 1 :]
    elif not head.startswith("/") or not t.startswith("/"):
        head = "/" + head
    if head.startswith("//"):
        authority, _, path = head.lstrip("/").partition("/")
        path = "/" + path
    else:
        authority, path = domain, head
    login, _, where = authority.rpartition("@")
    found = re.fullmatch(r"(.*?)(?::(\d*))?", where, re.S)
    host, port = found[1].lower(), found[2] or ""
    bad = set(" #/:<>?@[\\]^|%\x7f") | {chr(i) for i in range(32)}
    if login not in ("", ":") or port not in ("", "443") or not host.isascii() or set(host) & bad or not (host == domain or host.endswith("." + domain)):
        return None
    fragment = rest.partition("#")[2] if "#" in rest else None
    before = rest.partition("#")[0]
    query = before[1:] if before.startswith("?") else None

    def coded(text, more):
        return "".join("".join(f"%{b:02X}" for b in c.encode()) if ord(c) < 33 or ord(c) > 126 or c in more else c for c in text)

    stack, parts = [], coded(path, '"#<>?^`{}').split("/")[1:]
    for i, s in enumerate(parts):
        dots = s.lower().replace("%2e", ".")
        if dots == "..":
            stack[-1:] = []
        elif dots != ".":
            stack.append(s)
        if dots in (".", "..") and i == len(parts) - 1:
            stack.append("")
    return f"https://{host}/" + "/".join(stack) + ("" if query is None else "?" + coded(query, "\"#<>'")) + ("" if fragment is None else "#" + coded(fragment, '"<>`'))


def canonical(spark, links):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(links)], "i int, u string")
    return {links[r["i"]]: r["c"] for r in df.select("i", ids.canonical_url(F.col("u"), "example.com").alias("c")).collect()}


def test_table_of_cases(spark):
    got = canonical(spark, list(TABLE))
    assert {u: c for u, c in got.items() if c != TABLE[u]} == {}


def test_the_twin_knows_the_table():
    assert {u: twin(u) for u in TABLE if twin(u) != TABLE[u]} == {}


def test_random_links_against_the_twin(spark):
    rng = random.Random(12)
    parts = ["https://", "http://", "//", "/", "\\", "example.com", "a.example.com", "EXAMPLE.com", "evil.com", ":443", ":80", "@", ":", "u", "..", ".", "%2e", "%2E.", "/../", "/./", "a", "b c", "é", "🙂", "?", "#", "'", '"', "<", "{", "^", "|", "%41", "\t", "\x01"]
    links = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    links += ["https://example.com/" + "".join(rng.choice(parts[3:5] + parts[14:]) for _ in range(rng.randint(1, 15))) for _ in range(1500)]
    links = list(dict.fromkeys(links))
    got = canonical(spark, links)
    wrong = {u: (got[u], twin(u)) for u in links if got[u] != twin(u)}
    assert not wrong, dict(list(wrong.items())[:5])
    assert sum(c is not None for c in got.values()) > 800


def test_with_ids(spark):
    rows = [("/9/../7/5", "7", "5"), ("/7/5/", "7", "5"), ("/7/6", "7", "5"), ("", "7", "5"), (None, "7", "5"), ("/x/y", None, "5"), ("/7/./5?a b", "7", "5")]
    df = spark.createDataFrame(rows, "u string, a string, b string")
    got = [r[0] for r in df.select(ids.canonical_url(F.col("u"), "example.com", F.col("a"), F.col("b"))).collect()]
    assert got == ["https://example.com/7/5", "https://example.com/7/5/", None, "https://example.com/7/5", "https://example.com/7/5", "https://example.com/x/y", "https://example.com/7/5?a%20b"]
