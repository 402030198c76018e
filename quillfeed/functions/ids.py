"""Ids, counts and URLs as column expressions. The site's domain is a parameter everywhere."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillfeed.functions.binding import let
from quillfeed.functions.text import ascii_trim

MAX_SAFE = 9_007_199_254_740_991
_DIGITS = r"\A[0-9]+\z"
#: A whole number that is safe in any type.
SHORT_NUMBER = r"\A[0-9]{1,15}\z"


def strict_id(c: Column) -> Column:
    """A text of digits only, as it is; anything else is null."""
    return F.when(c.rlike(_DIGITS), c)


def loose_id(c: Column) -> Column:
    """Digits after an ASCII trim; anything else is null."""
    return strict_id(ascii_trim(c.cast("string")))


def count_from_text(c: Column) -> Column:
    """A non-negative integer written in digits, up to 2^53 - 1, after an ASCII trim; else null."""
    number = lambda t: F.when(t.rlike(r"\A0*[0-9]{1,16}\z"), t.try_cast("long"))
    return let(ascii_trim(c), lambda t: let(number(t), lambda n: F.when(n <= MAX_SAFE, n)))


def count_from_literal(literal: Column) -> Column:
    """Of a JSON literal: a whole number (4.0 too) or a quoted digit text; else null."""
    inner = lambda x: F.get_json_object(F.concat(F.lit('{"x":'), x, F.lit("}")), "$.x")
    whole = lambda d: F.when((d == F.floor(d)) & (d >= 0) & (d <= MAX_SAFE), d.try_cast("long"))
    other = let(literal, lambda x: F.when(x.startswith('"'), count_from_text(inner(x))).otherwise(let(x.try_cast("decimal(38,10)"), whole)))
    return F.when(literal.rlike(SHORT_NUMBER), literal.try_cast("long")).otherwise(other)  # nearly all counts are short


def id_order(c: Column) -> list[Column]:
    """Sort keys that put larger numbers first without a cast: longer ids, then later text."""
    return [F.length(c).desc(), c.desc()]


def url_parts(url: Column) -> dict[str, Column]:
    """scheme, authority, host, port, path and last_segment of an absolute http(s) URL; empty texts otherwise."""
    pattern = r"(?is)\A(https?)://([^/?#]*)([^?#]*)(.*)\z"
    authority = F.regexp_extract(url, pattern, 2)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))
    path = F.regexp_extract(url, pattern, 3)
    return {
        "scheme": F.lower(F.regexp_extract(url, pattern, 1)),
        "authority": authority,
        "host": host,
        "port": F.regexp_extract(authority, r":([0-9]+)$", 1),
        "path": path,
        "rest": F.regexp_extract(url, pattern, 4),
        "last_segment": last_segment(path),
    }


def last_segment(path: Column) -> Column:
    """The last non-empty part of a path; empty if there is none."""
    return F.regexp_extract(path, r"([^/]*)/*\z", 1)


def on_domain(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith("." + domain)


#: Characters that are percent-encoded in a path, in a query and in a fragment of an https URL.
ENCODED_IN_PATH = r"""[\x00-\x20"#<>?^`{}\x7F-\x{10FFFF}]"""
ENCODED_IN_QUERY = r"""[\x00-\x20"#<>'\x7F-\x{10FFFF}]"""
ENCODED_IN_FRAGMENT = r"""[\x00-\x20"<>`\x7F-\x{10FFFF}]"""
#: A host of ASCII without a character that no host may hold; path segments for this folder and the one above.
HOST = r"\A[^\x00-\x20#/:<>?@\[\\\]^|%\x7F-\x{10FFFF}]+\z"
HERE, ABOVE = r"(?i)\A(\.|%2e)\z", r"(?i)\A(\.|%2e){2}\z"


def percent_encoded(c: Column, characters: str) -> Column:
    """The text with the characters of a class, each as the hexadecimal of its UTF-8 bytes."""
    runs = F.regexp_extract_all(c, F.lit(f"(?s){characters}+|{characters.replace('[', '[^', 1)}+"), F.lit(0))
    coded = lambda r: F.regexp_replace(F.hex(F.encode(r, "UTF-8")), "(..)", "%$1")
    return F.when(c.rlike(characters), F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"\A" + characters), coded(r)).otherwise(r)), "")).otherwise(c)


def without_dot_segments(path: Column) -> Column:
    """A path that begins with `/`, its segments `.` and `..` (also percent-encoded) resolved by a stack of segments."""
    segments = F.split(F.substring(path, 2, 2147483647), "/")

    def step(kept: Column, s: Column) -> Column:
        above = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(s.rlike(ABOVE), above).when(s.rlike(HERE), kept).otherwise(F.concat(kept, F.array(s)))

    # The last segment leaves an empty one behind where it is resolved: the path ends in `/`.
    with_end = F.when(F.element_at(segments, -1).rlike(ABOVE) | F.element_at(segments, -1).rlike(HERE), F.concat(segments, F.array(F.lit("")))).otherwise(segments)
    resolved = F.aggregate(with_end, F.array().cast("array<string>"), step)
    return F.when(path.rlike(r"(?i)/(\.|%2e){1,2}(/|\z)"), F.concat(F.lit("/"), F.array_join(resolved, "/"))).otherwise(path)


def canonical_url(url: Column, domain: str, user_id: Column | None = None, post_id: Column | None = None) -> Column:
    """The absolute https form of a link on `domain`, or null where the link is not allowed.

    Relative and protocol-relative links and http are completed; other schemes, other hosts, user info and ports
    other than 443 are refused, as are hosts beyond ASCII. Tabs and line ends go, backslashes before the query are
    slashes, dot segments are resolved and what may not stand in path, query or fragment is percent-encoded. With user
    and post ids, an empty link becomes `/user/post` and any other must be it.
    """
    # What is canonical already, as nearly all stored links are, is told by one pattern and taken as it is.
    plain = rf"\Ahttps://(?:[a-z0-9.-]+\.)?{re.escape(domain)}(?:/[A-Za-z0-9_~-]*)+\z"
    other = lambda t: let(_absolute(t, domain), lambda a: let(_parts(a), lambda p: _canonical(t, p, domain, user_id, post_id)))
    trimmed = ascii_trim(F.coalesce(url, F.lit("")))
    exact = lambda t: F.when(t.rlike(plain), _exact(t, F.split(t, "/"), 2, user_id, post_id)).otherwise(other(t))
    return F.when(trimmed == "", _empty(domain, user_id, post_id)).otherwise(let(trimmed, exact))


def _empty(domain: str, user_id: Column | None, post_id: Column | None) -> Column:
    """What an empty link becomes: `/user/post`, or null without these."""
    if user_id is None or post_id is None:
        return F.lit(None).cast("string")
    return F.when((user_id != "") & (post_id != ""), F.concat(F.lit(f"https://{domain}/"), user_id, F.lit("/"), post_id))


def _exact(whole: Column, parts: Column, at: int, user_id: Column | None, post_id: Column | None) -> Column:
    """A link whose path, from the non-empty part `at` on, is `/user/post`; without ids every link."""
    if user_id is None or post_id is None:
        return whole
    segments = F.filter(parts, lambda s: s != "")
    exact = F.when((F.size(segments) == at + 2) & (F.get(segments, F.lit(at)) == user_id) & (F.get(segments, F.lit(at + 1)) == post_id), whole)
    return F.when(user_id.isNull() | post_id.isNull() | (user_id == "") | (post_id == ""), whole).otherwise(exact)


def _absolute(t: Column, domain: str) -> Column:
    """`//authority...` of a link without its scheme, which is looked for before tabs and line ends go."""
    told = F.regexp_replace(F.regexp_replace(t, r"(?i)\Ahttps?://", "//"), r"[\t\n\r]", "")
    head, rest = F.regexp_extract(told, r"(?s)\A([^?#]*)", 1), F.regexp_extract(told, r"(?s)\A[^?#]*(.*)\z", 1)
    bare = F.translate(head, "\\", "/")
    rooted = F.when(told.startswith("/"), bare).otherwise(F.concat(F.lit("/"), bare))
    return F.concat(F.when(rooted.startswith("//"), F.regexp_replace(rooted, r"\A/+", "//")).otherwise(F.concat(F.lit(f"//{domain}"), rooted)), rest)


def _parts(a: Column) -> Column:
    part = lambda i: F.regexp_extract(a, r"(?s)\A//([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?\z", i)
    authority = part(1)
    path = without_dot_segments(percent_encoded(F.when(part(2) == "", F.lit("/")).otherwise(part(2)), ENCODED_IN_PATH))
    query, fragment = F.substring(part(3), 2, 2147483647), F.substring(part(4), 2, 2147483647)
    return F.struct(
        F.regexp_extract(authority, r"(?s)\A(.*)@", 1).alias("login"),
        F.lower(F.regexp_extract(authority, r"(?s)([^@]*?)(:[0-9]*)?\z", 1)).alias("host"),
        F.regexp_extract(authority, r":([0-9]+)\z", 1).alias("port"),
        path.alias("path"),
        F.concat(
            F.when(part(3) == "", "").otherwise(F.concat(F.lit("?"), percent_encoded(query, ENCODED_IN_QUERY))),
            F.when(part(4) == "", "").otherwise(F.concat(F.lit("#"), percent_encoded(fragment, ENCODED_IN_FRAGMENT))),
        ).alias("rest"),
    )


def _canonical(t: Column, p: Column, domain: str, user_id: Column | None, post_id: Column | None) -> Column:
    foreign = t.rlike(r"(?i)\A[a-z][a-z0-9+.-]*:") & ~t.rlike(r"(?i)\Ahttps?:")
    fine = ~foreign & on_domain(p["host"], domain) & p["host"].rlike(HOST) & p["login"].isin("", ":") & p["port"].isin("", "443")
    whole = F.when(fine, F.concat(F.lit("https://"), p["host"], p["path"], p["rest"]))
    return _exact(whole, F.split(p["path"], "/"), 0, user_id, post_id)


def post_reference(ref: Column, domain: str, default_user: str) -> tuple[Column, Column]:
    """(user_id, post_id) of a reference: digits, or a URL `/user/post`; both null for anything else."""
    t = ascii_trim(ref)
    p = url_parts(t)
    pair = r"\A/([0-9]+)/([0-9]+)/*\z"
    link = (p["scheme"] == "https") & on_domain(p["host"], domain) & p["port"].isin("", "443") & ~p["authority"].contains("@") & p["path"].rlike(pair)
    digits = t.rlike(_DIGITS)
    user = F.when(digits, F.lit(default_user)).when(link, F.regexp_extract(p["path"], pair, 1))
    post = F.when(digits, t).when(link, F.regexp_extract(p["path"], pair, 2))
    return user, post
