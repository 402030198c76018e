"""Pagination: items of pages, pinned rows, completeness decisions, running observations, stop pages, date boundaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.functions.binding import let, named
from quillfeed.functions.ids import count_from_literal
from quillfeed.functions.payload import Payload, parsed_rows, root_fields
from quillfeed.functions.text import ascii_trim

#: Where page metadata may stand, and the names of its fields.
CONTAINERS = ("page", "pagination", "meta", "page_info")
HAS_MORE = ("has_more", "hasMore")
PAGE_COUNT = ("max_page", "maxPage", "page_count", "pageCount", "total_pages", "totalPages")
TOTAL = ("total", "total_count", "totalCount")
CURSOR = ("next", "next_id", "nextId", "next_cursor", "nextCursor")
CURRENT_PAGE = ("page", "page_no", "pageNo", "current_page", "currentPage")
TIMELINE_ITEMS = ("statuses", "list", "items")
COMMENT_ITEMS = ("comments", "list", "items", "statuses")

#: Marks a value that its rule refuses.
INVALID = "\u0000invalid"


def explode_items(pages: DataFrame, aliases: tuple[str, ...], body: str = "body") -> DataFrame:
    """One row for each item: the page's columns, `violation`, `pos` and `item` (JSON). Pages without items stay, with nulls."""
    rows, item = item_values(pages, aliases, body)
    return rows.select(*pages.columns, "violation", "pos", F.when(~F.is_variant_null(item), F.to_json(item)).alias("item"))


def item_values(pages: DataFrame, aliases: tuple[str, ...], body: str = "body") -> tuple[DataFrame, Column]:
    """`explode_items` with each item as a value that is not written as text yet, and the column that holds it."""
    rows, p = parsed_rows(pages, body)
    rows, found, items = _item_array(rows, p, aliases)
    missing = F.when(root_fields(p.variant).isNull(), "not_an_object").otherwise("missing_array")
    violation = F.when(found.isNull(), missing).when(items.isNull(), "not_an_array")
    return rows.select(*pages.columns, violation.alias("violation"), F.posexplode_outer(items).alias("pos", "__item")), F.col("__item")


def pages_and_items(pages: DataFrame, aliases: tuple[str, ...], body: str, strict: bool = False) -> tuple[DataFrame, Column, dict[str, Column]]:
    """`item_values` of one parse with what `decided` needs of each page; without the body, and with `n_items`.

    A page without items has one row, of null `pos`. The facts of a page and its number of items stand in each of its rows.
    """
    others = [c for c in pages.columns if c != body]
    rows, p = parsed_rows(pages, body)
    rows, _, items = _item_array(rows, p, aliases)
    rows, (meta,) = named(rows, metadata(p.variant))
    sets = _sets(meta, strict)
    n_items = F.coalesce(F.size(F.filter(items, lambda x: ~F.is_variant_null(x))), F.lit(0))
    rows = rows.select(*others, n_items.alias("n_items"), *(v.alias(f"__fact_{k}") for k, v in sets.items()), F.posexplode_outer(items).alias("pos", "__item"))
    return rows, F.col("__item"), {k: F.col(f"__fact_{k}") for k in sets}


def _item_array(rows: DataFrame, p: Payload, aliases: tuple[str, ...]) -> tuple[DataFrame, Column, Column]:
    """The frame with what stands where items are due, and the array of items that it is, each made once."""
    rows, (found,) = named(rows, F.coalesce(*(F.try_variant_get(p.variant, f"$.{name}", "variant") for name in aliases)))
    rows, (items,) = named(rows, F.try_variant_get(found, "$", "array<variant>"))
    return rows, found, items


def _inner(literal: Column) -> Column:
    return ascii_trim(F.get_json_object(F.concat(F.lit('{"x":'), literal, F.lit("}")), "$.x"))


def has_more_value(literal: Column) -> Column:
    """`true`, `false` or INVALID of a JSON literal: booleans, 1 and 0, and their texts."""
    t = F.lower(F.when(literal.startswith('"'), _inner(literal)).otherwise(literal))
    return F.when(t.rlike(r"\A(true|1|1\.0+)\z"), "true").when(t.rlike(r"\A(false|0|0\.0+)\z"), "false").otherwise(INVALID)


def integer_value(literal: Column) -> Column:
    return F.coalesce(count_from_literal(literal).cast("string"), F.lit(INVALID))


def cursor_value(literal: Column) -> Column:
    """The next cursor as text, empty where the stream ends, or INVALID."""
    text = _inner(literal)
    n = count_from_literal(literal)
    return (
        F.when(literal == "null", "")
        .when(literal.startswith('"'), F.when(text == "0", "").otherwise(text))
        .when(n == 0, "")
        .otherwise(F.coalesce(n.cast("string"), F.lit(INVALID)))
    )


def metadata(variant: Column) -> Column:
    """struct(fields, broken, is_object): name and literal of each metadata field, from the root and all containers."""
    names = [*HAS_MORE, *PAGE_COUNT, *TOTAL, *CURSOR, *CURRENT_PAGE]

    def of(root: Column) -> Column:
        fields = lambda entries: F.transform(F.filter(entries, lambda e: e["key"].isin(*names)), lambda e: F.struct(e["key"].alias("name"), F.to_json(e["value"]).alias("literal")))
        # At the root, `page` may be a container instead of a number.
        own = F.filter(fields(F.map_entries(root)), lambda f: (f["name"] != "page") | ~f["literal"].startswith("{"))
        inner = [F.when(root[c].isNotNull(), fields(F.map_entries(root_fields(root[c])))) for c in CONTAINERS]
        broken = F.lit(False)
        for c in CONTAINERS[1:]:
            broken = broken | F.coalesce(root[c].isNotNull() & root_fields(root[c]).isNull(), F.lit(False))
        return F.struct(F.flatten(F.array_compact(F.array(own, *inner))).alias("fields"), broken.alias("broken"), root.isNotNull().alias("is_object"))

    return let(root_fields(variant), of)


def _values(fields: Column, aliases: tuple[str, ...], rule: Callable[[Column], Column]) -> Column:
    """Distinct values of a field over all containers and aliases."""
    return F.array_distinct(F.transform(F.filter(fields, lambda f: f["name"].isin(*aliases)), lambda f: rule(f["literal"])))


def pagination_decision(body: Column, page: Column, count: Column, item_count: Column, observed: Column, strict: bool = False) -> Column:
    """struct(complete, explicit, violation) of a page.

    Evidence for more or for the end comes from has_more, the next cursor, the page count and the total. Mixed
    evidence is incomplete (with `strict`: a violation), no evidence leaves a short page complete but not explicit.
    `strict` also ignores cursors, takes only booleans and numbers, and wants the page count to follow from the total.
    """

    def of(m: Column) -> Column:
        sets = _sets(m, strict)
        return let(F.struct(*(v.alias(k) for k, v in sets.items())), lambda s: let(F.struct(*_decide(s, page, count, item_count, observed, strict)), lambda d: F.struct(*_fine(d))))

    return let(metadata(F.try_parse_json(body)), of)


def page_facts(rows: DataFrame, body: str, strict: bool = False) -> tuple[DataFrame, dict[str, Column]]:
    """The frame without `body`, and as columns what `decided` needs of it: rows that are joined further stay small."""
    others = [c for c in rows.columns if c != body]
    rows, (meta,) = named(rows, metadata(F.try_parse_json(F.col(body))))
    sets = _sets(meta, strict)
    rows = rows.select(*others, *(v.alias(f"__fact_{k}") for k, v in sets.items()))
    return rows, {k: F.col(f"__fact_{k}") for k in sets}


def decided(rows: DataFrame, facts: dict[str, Column], page: Column, count: Column, item_count: Column, observed: Column, strict: bool = False) -> DataFrame:
    """Adds complete, explicit and violation of `pagination_decision`, each part a column so that it is made once."""
    others = [c for c in rows.columns if not c.startswith("__fact_")]
    rows = rows.select("*", *(c.alias(f"__decided_{k}") for k, c in zip(("complete", "explicit", "violation"), _decide(facts, page, count, item_count, observed, strict), strict=True)))
    return rows.select(*others, *_fine({k: F.col(f"__decided_{k}") for k in ("complete", "explicit", "violation")}))


def _sets(m: Column, strict: bool) -> dict[str, Column]:
    """The distinct values of each field of the metadata, and whether these are broken and of an object."""
    numbers = (lambda x: F.when(x.startswith('"'), F.lit(INVALID)).otherwise(integer_value(x))) if strict else integer_value
    more_rule = (lambda x: F.when(x.isin("true", "false"), x).otherwise(INVALID)) if strict else has_more_value
    values = lambda aliases, rule: _values(m["fields"], aliases, rule)
    sets = {"has_more": values(HAS_MORE, more_rule), "page_count": values(PAGE_COUNT, numbers), "total": values(TOTAL, numbers)}
    if not strict:
        sets |= {"cursor": values(CURSOR, cursor_value), "current_page": values(CURRENT_PAGE, integer_value)}
    return sets | {"broken": m["broken"], "is_object": m["is_object"]}


def _fine(d: Column | dict[str, Column]) -> list[Column]:
    """A decision; where there is a violation, that alone."""
    return [*(F.when(d["violation"].isNull(), d[name]).alias(name) for name in ("complete", "explicit")), d["violation"].alias("violation")]


def _decide(s: Column | dict[str, Column], page: Column, count: Column, item_count: Column, observed: Column, strict: bool) -> list[Column]:
    """complete, explicit and violation from the distinct values of each field."""
    names = ["has_more", "page_count", "total", *([] if strict else ["cursor", "current_page"])]
    value = {k: F.get(s[k], F.lit(0)) for k in names}
    pages, total = value["page_count"].try_cast("long"), value["total"].try_cast("long")
    more_if = [value["has_more"] == "true", page < pages, observed < total]
    done_if = [value["has_more"] == "false", page >= pages, observed >= total]
    if not strict:
        more_if.append(value["cursor"] != "")
        done_if.append(value["cursor"] == "")
    any_of = lambda parts: F.coalesce(F.greatest(*(F.coalesce(x, F.lit(False)) for x in parts)), F.lit(False))
    more, done = any_of(more_if), any_of(done_if)
    violation = (
        F.when(F.coalesce((page < 1) | (count < 1) | (item_count < 0) | (observed < 0), F.lit(True)), "invalid_argument")
        .when(item_count > count, "too_many_items")
        .when(~s["is_object"], "not_an_object")
        .when(s["broken"], "invalid_container")
    )
    for name in names:
        violation = violation.when(F.array_contains(s[name], INVALID), f"invalid_{name}").when(F.size(s[name]) > 1, f"conflicting_{name}")
    if strict:
        violation = (
            violation.when(observed < item_count, "observed_below_items")
            .when((pages < 1) | (page > pages), "page_count_contradiction")
            .when(total < observed, "total_below_observed")
            .when(total.isNotNull() & (pages != F.greatest(F.lit(1), F.ceil(total / count))), "page_count_conflicts_with_total")
            .when(more & done, "mixed_evidence")
        )
    else:
        violation = violation.when(value["current_page"].try_cast("long") != page, "wrong_page").when(
            ((pages == 0) & ((item_count > 0) | (observed > 0))) | ((page > pages) & (item_count > 0)), "page_count_contradiction"
        )
    complete = F.when(more, False).when(done, True).otherwise(item_count < count)
    return [complete.alias("complete"), (~more & done).alias("explicit"), violation.alias("violation")]


def pinned_rows(items: DataFrame, keys: list[str], page: str, count: str, mark: str = "mark") -> DataFrame:
    """Adds `pageable` and `violation`: rows beyond the page size must be the marked ones of page 1.

    The sizes of a page come from one grouped aggregation that is joined back, so a page is never held by one task.
    """
    by = [*keys, page]
    sizes = items.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(mark) == 1).alias("__pins"))
    over = F.col("__n") - F.col(count)
    joined = items.join(sizes, by)
    violation = F.when((over > 0) & ((F.col(page) != 1) | (F.col("__pins") != over)), "unexplained_overflow")
    pageable = (over <= 0) | ~F.coalesce(F.col(mark) == 1, F.lit(False))
    return joined.withColumn("violation", violation).withColumn("pageable", F.when(violation.isNull(), pageable)).drop("__n", "__pins")


def running_observed(items: DataFrame, stream: str, page: str, item_id: str, spine: DataFrame | None = None) -> DataFrame:
    """(stream, page, observed): distinct ids up to and with each page.

    Each id counts on its first page: one grouped minimum, one grouped count, and a running sum over pages only.
    `spine` (stream, page) adds pages without items.
    """
    first = items.filter(F.col(item_id).isNotNull()).groupBy(stream, item_id).agg(F.min(page).alias(page))
    fresh = first.groupBy(stream, page).agg(F.count(F.lit(1)).alias("__new"))
    pages = (spine if spine is not None else items).select(stream, page).distinct()
    window = Window.partitionBy(stream).orderBy(page)
    return pages.join(fresh, [stream, page], "left").select(stream, page, F.sum(F.coalesce("__new", F.lit(0))).over(window).alias("observed"))


def stop_pages(pages: DataFrame, stream: str, page: str, stops: Column) -> DataFrame:
    """(stream, stop_page, truncated): the first page that stops the walk; truncated where none does."""
    return pages.groupBy(stream).agg(F.min(F.when(stops, F.col(page))).alias("stop_page")).withColumn("truncated", F.col("stop_page").isNull())


def walked(items: DataFrame, stops: DataFrame, stream: str, page: str) -> DataFrame:
    """Items up to the stop page of their stream; all of a truncated one."""
    return items.join(stops, stream).filter(F.col("stop_page").isNull() | (F.col(page) <= F.col("stop_page")))


def page_budget(reply_count: Column, count: int) -> Column:
    """Pages that a recovery scan may ask for."""
    return F.greatest(F.lit(1), F.ceil(reply_count / F.lit(count)) + F.lit(2))


def before_first_error(rows: DataFrame, run: str, seq: str, code: str, fatal: tuple[str, ...]) -> DataFrame:
    """Rows of each run before its first fatal code: the scan ends there."""
    ends = rows.filter(F.col(code).isin(*fatal)).groupBy(run).agg(F.min(seq).alias("__end"))
    return rows.join(ends, run, "left").filter(F.col("__end").isNull() | (F.col(seq) < F.col("__end"))).drop("__end")


def since_boundary(records: DataFrame, stream: str, page: str, pos: str, epoch: str, since_ms: int, spine: DataFrame | None = None) -> DataFrame:
    """(stream, page, candidate, confirmed).

    A page is a candidate if times have never risen or been unknown so far and one of its own lies before the date;
    it confirms the boundary if the page before was a candidate and all of its own, one at least, lie before it.
    """
    # Times are compared inside pages, which are small, and then from page to page: no window holds a stream's records.
    inside = Window.partitionBy(stream, page).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    value, known = F.col(epoch), F.col(epoch).isNotNull()
    broken = value.isNull() | (value > F.last(epoch, ignorenulls=True).over(inside))
    flagged = records.select(stream, page, pos, epoch, F.coalesce(broken, F.lit(False)).alias("__broken"))
    per_page = flagged.groupBy(stream, page).agg(
        F.count_if("__broken").alias("__broken"),
        F.count_if(F.coalesce(value < since_ms, F.lit(False))).alias("__before"),
        F.count(F.lit(1)).alias("__n"),
        F.min_by(F.when(known, value), F.when(known, F.col(pos))).alias("__first"),
        F.max_by(F.when(known, value), F.when(known, F.col(pos))).alias("__last"),
    )
    pages = spine.select(stream, page).distinct().join(per_page, [stream, page], "left") if spine is not None else per_page
    by_page = Window.partitionBy(stream).orderBy(page)
    earlier = F.last("__last", ignorenulls=True).over(by_page.rowsBetween(Window.unboundedPreceding, -1))
    risen = F.coalesce(F.col("__first") > earlier, F.lit(False)).cast("int")
    rows = pages.withColumn("__bad", F.coalesce("__broken", F.lit(0)) + risen)
    rows = rows.withColumn("__ordered", F.sum("__bad").over(by_page) == 0)
    rows = rows.withColumn("candidate", F.col("__ordered") & (F.coalesce("__before", F.lit(0)) > 0))
    all_before = (F.coalesce("__n", F.lit(0)) > 0) & (F.col("__n") == F.col("__before"))
    confirmed = F.coalesce(F.lag("candidate").over(by_page), F.lit(False)) & F.col("__ordered") & F.coalesce(all_before, F.lit(False))
    return rows.select(stream, page, "candidate", confirmed.alias("confirmed"))


def since_filter(df: DataFrame, epoch: str, since_ms: int) -> DataFrame:
    """Rows at or after the date, and rows whose time is unknown."""
    return df.filter(F.col(epoch).isNull() | (F.col(epoch) >= since_ms))
