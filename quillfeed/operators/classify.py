"""Responses to codes: JSON and HTML classification, and interface-drift signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.functions.payload import Payload

#: Keys and words that mark a challenge page.
CHALLENGE_KEYS = ("renderData", "_waf_", "aliyun_waf", "captcha")
_MARKS = "(?i)" + "|".join(CHALLENGE_KEYS)
_HTML_TYPE = r"(?i)(?:text/html|application/xhtml\+xml)"
_JSON_TYPE = r"(?i)(?:application|text)/(?:[^;]+\+)?json"

#: Code of a failed response, and the category of the interface drift that it signals.
DRIFT_CATEGORIES = {
    "HTTP_404": "endpoint_missing",
    "INVALID_CONTENT_TYPE": "content_type",
    "INVALID_HTML": "response_encoding",
    "INVALID_JSON": "response_encoding",
    "INVALID_RESPONSE_SHAPE": "response_contract",
}


def json_code(status: Column, content_type: Column, body: Column) -> Column:
    """OK, WAF, API_n, HTTP_n, DUPLICATE_KEYS or INVALID_JSON of a JSON response."""
    text, kind = F.coalesce(body, F.lit("")), F.coalesce(content_type, F.lit(""))
    p = Payload(text)
    parsed = p.variant.isNotNull()
    loose = F.get_json_object(text, "$").isNotNull()  # what try_parse_json refuses for its repeated keys
    api = F.regexp_replace(p.literal("error_code"), r'\A"|"\z', "")
    failing = p.is_object() & F.coalesce(~api.isin("0", "", "null", "false"), F.lit(False))
    challenged = kind.rlike(_HTML_TYPE) | (p.is_object() & F.arrays_overlap(p.keys, F.array(*map(F.lit, CHALLENGE_KEYS))))
    masked = ~parsed & ~kind.rlike(_JSON_TYPE) & text.rlike(_MARKS)
    status_text = F.coalesce(status.cast("string"), F.lit("undefined"))
    return (
        F.when(challenged | masked, "WAF")
        .when(~status.eqNullSafe(200) & failing, F.concat(F.lit("API_"), api))
        .when(~status.eqNullSafe(200) & status.eqNullSafe(400) & text.contains("10020"), "API_10020")
        .when(~status.eqNullSafe(200), F.concat(F.lit("HTTP_"), status_text))
        .when(~parsed & loose, "DUPLICATE_KEYS")
        .when(~parsed, "INVALID_JSON")
        .when(failing, F.concat(F.lit("API_"), api))
        .otherwise("OK")
    )


def html_code(status: Column, content_type: Column, body: Column) -> Column:
    """OK, WAF, HTTP_n, INVALID_CONTENT_TYPE or INVALID_HTML of an HTML response."""
    text, kind = F.coalesce(body, F.lit("")), F.coalesce(content_type, F.lit(""))
    return (
        F.when(text.rlike(_MARKS), "WAF")
        .when(~status.eqNullSafe(200), F.concat(F.lit("HTTP_"), F.coalesce(status.cast("string"), F.lit("undefined"))))
        .when((kind != "") & ~kind.rlike(_HTML_TYPE), "INVALID_CONTENT_TYPE")
        .when(~text.rlike(r"\S"), "INVALID_HTML")
        .otherwise("OK")
    )


def drift_signals(failures: DataFrame, source: str = "source", code: str = "code", message: str = "message") -> DataFrame:
    """Distinct (source, category, code, message) of failures whose code signals drift."""
    known = F.create_map(*[F.lit(x) for pair in DRIFT_CATEGORIES.items() for x in pair])
    rows = failures.select(F.col(source).alias("source"), known[F.col(code)].alias("category"), F.col(code).alias("code"), F.coalesce(F.nullif(F.col(message), F.lit("")), F.col(code)).alias("message"))
    return rows.filter("category is not null").distinct()


def request_metrics(responses: DataFrame, code: str = "code") -> DataFrame:
    """One row: requests, errors and challenges."""
    return responses.agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col(code) != "OK").alias("errors"), F.count_if(F.col(code) == "WAF").alias("waf")
    )


def first_valid_attempt(attempts: DataFrame, request: str, rank: str, code: str = "code", *, missing: tuple[str, ...] = ("HTTP_404",)) -> DataFrame:
    """The first endpoint of each request, by rank, whose answer is not `missing`; one grouped minimum, no window."""
    usable = attempts.filter(~F.col(code).isin(*missing))
    others = [c for c in attempts.columns if c not in (request, rank)]
    best = usable.groupBy(request).agg(F.min_by(F.struct(rank, *others), rank).alias("best"))
    return best.select(request, "best.*")
