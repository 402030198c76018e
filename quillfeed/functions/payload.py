"""Fields of JSON texts: presence, kinds and literals, through VARIANT; absent and null stay apart."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.functions.binding import let, named
from quillfeed.functions.text import ascii_trim


#: The column of a parsed text.
PARSED = "__parsed"


class Payload:
    """Accessors of one JSON text column. Paths are dotted names from the root.

    A payload from `parsed` holds the literals and the strings of its root fields, each made once. One of `parsed_rows`
    reads a column that holds the parsed text, and a column for the literal of each field that was named there; any
    other parses the text for each field that is asked for.
    """

    def __init__(self, body: Column, bound: Column | None = None, variant: Column | None = None, columns: dict[str, Column] | None = None):
        self.body = body if bound is None else bound["body"]
        self.variant = bound["variant"] if bound is not None else F.try_parse_json(body) if variant is None else variant
        self.keys = F.coalesce(F.json_object_keys(body), F.array().cast("array<string>")) if bound is None else bound["keys"]
        self.literals = None if bound is None else bound["literals"]
        self.strings = None if bound is None else bound["strings"]
        self.columns = columns or {}

    @staticmethod
    def parsed(body: Column, use: Callable[[Payload], Column]) -> Column:
        """`use` of a payload that is parsed once."""

        def read(b: Column) -> Column:
            p = Payload(b)
            return let(p.variant, lambda v: let(F.struct(b.alias("body"), v.alias("variant"), p.keys.alias("keys"), root_fields(v).alias("root")), with_fields))

        def with_fields(s: Column) -> Column:
            string = lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
            more = F.struct(
                s["body"].alias("body"), s["variant"].alias("variant"), s["keys"].alias("keys"),
                F.transform_values(s["root"], lambda _, v: F.to_json(v)).alias("literals"),
                F.transform_values(s["root"], lambda _, v: string(v)).alias("strings"),
            )
            return let(more, lambda bound: use(Payload(body, bound)))

        return let(body, read)

    @staticmethod
    def _path(name: str) -> str:
        return "$." + name

    def _held(self, name: str) -> bool:
        return self.literals is not None and "." not in name

    def has(self, name: str) -> Column:
        """Whether the field is present, with null or not."""
        if name in self.columns:
            return self.columns[name].isNotNull()
        if self._held(name):
            return self.literals[name].isNotNull()
        return F.try_variant_get(self.variant, self._path(name), "variant").isNotNull()

    def literal(self, name: str) -> Column:
        """The field's JSON literal; SQL null if absent, the text `null` if null."""
        if name in self.columns:
            return self.columns[name]
        return self.literals[name] if self._held(name) else F.to_json(F.try_variant_get(self.variant, self._path(name), "variant"))

    def kind(self, name: str) -> Column:
        """string, number, boolean, null, array, object, or SQL null if absent."""
        if name in self.columns:
            return literal_kind(self.columns[name])
        if self._held(name):
            return literal_kind(self.literals[name])
        return _kind(F.schema_of_variant(F.try_variant_get(self.variant, self._path(name), "variant")))

    def text(self, name: str) -> Column:
        """The field's value if it is a string; else SQL null."""
        if self._held(name):
            return self.strings[name]
        return F.when(self.kind(name) == "string", F.try_variant_get(self.variant, self._path(name), "string"))

    def is_object(self) -> Column:
        if self.literals is not None:
            return self.literals.isNotNull()
        return F.coalesce(_kind(F.schema_of_variant(self.variant)) == "object", F.lit(False))

    def first_present(self, *names: str, allow_null: bool = False) -> Column:
        """Literal of the first alias that is present and, unless allowed, not null; SQL null if none is."""
        found = [self.literal(n) if allow_null else F.when(self.literal(n) != "null", self.literal(n)) for n in names]
        return F.coalesce(*found)

    def preferred(self, primary: str, alias: str) -> Column:
        """Literal of `primary` if its key is present, even with null; else of `alias`."""
        return F.when(self.has(primary), self.literal(primary)).otherwise(self.literal(alias))


def parsed_rows(df: DataFrame, body: str, name: str = PARSED, fields: Iterable[str] = ()) -> tuple[DataFrame, Payload]:
    """The frame with the parsed text as a column `name`, and a payload that reads it: one parse for each row.

    The literal of each of `fields` is a column too, made once for each row however often it is asked for.
    """
    rows, p = df.withColumn(name, F.try_parse_json(F.col(body))), Payload(F.col(body), variant=F.col(name))
    fields = list(dict.fromkeys(fields))
    rows, columns = named(rows, *(p.literal(f) for f in fields))
    return rows, Payload(F.col(body), variant=F.col(name), columns=dict(zip(fields, columns, strict=True)))


def value_rows(df: DataFrame, value: str, fields: Iterable[str] = ()) -> tuple[DataFrame, Payload]:
    """`parsed_rows` of a column that holds parsed texts already, as the items of a parsed page: no text is written for them.

    Numbers are written as they would be after another parse, so that 1e2 is 100 here as it is there.
    """
    fields = list(dict.fromkeys(fields))
    p = Payload(F.lit(None).cast("string"), variant=F.col(value))
    rows, raw = named(df, *(p.literal(f) for f in fields))
    again = [F.when(~c.startswith('"') & (c.contains(".") | c.contains("E")), F.to_json(F.try_parse_json(c))).otherwise(c) for c in raw]
    rows, columns = named(rows, *again)
    return rows, Payload(p.body, variant=F.col(value), columns=dict(zip(fields, columns, strict=True)))


def root_fields(variant: Column) -> Column:
    """The fields of an object by name; SQL null for anything else."""
    return F.try_variant_get(variant, "$", "map<string,variant>")


def literal_kind(literal: Column) -> Column:
    """The kind of a JSON literal, told from its first character."""
    first = F.substring(literal, 1, 1)
    return (
        F.when(first == '"', "string").when(first == "{", "object").when(first == "[", "array")
        .when(first.isin("t", "f"), "boolean").when(first == "n", "null").when(literal.isNotNull(), "number")
    )


def _kind(schema: Column) -> Column:
    return (
        F.when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema == "VOID", "null")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.isNotNull(), "number")
    )


def array_field(body: Column | Payload, *aliases: str) -> tuple[Column, Column]:
    """(items as a JSON array text, violation): the first alias that is present must be an array."""
    p = body if isinstance(body, Payload) else Payload(body)
    items, violation = F.lit(None).cast("string"), F.lit("missing_array")
    for name in reversed(aliases):
        array = p.kind(name) == "array"
        items = F.when(p.has(name), F.when(array, p.literal(name))).otherwise(items)
        violation = F.when(p.has(name), F.when(~array, F.lit("not_an_array"))).otherwise(violation)
    return items, F.when(~p.is_object(), F.lit("not_an_object")).otherwise(violation)


def embedded_json(html: Column, marker: str) -> Column:
    """The JSON object that a page assigns to the variable `marker`, up to the end of its statement; null if none parses."""
    found = F.regexp_extract(html, rf"(?s){marker}\s*=\s*(\{{.*?\}})\s*(?:;|</script>)", 1)
    return F.when(F.try_parse_json(F.when(found != "", found)).isNotNull(), found)


#: Fields that may name the author of a row.
AUTHOR = ("user.id", "user_id", "userId")


def author_id(p: Payload) -> Column:
    """The author of a row as text: the first of user.id, user_id and userId that is not null, trimmed."""
    literal = p.first_present(*AUTHOR)
    return ascii_trim(F.regexp_replace(literal, r'\A"|"\z', ""))


def references_agree(p: Payload, post_id: Column, *names: str) -> Column:
    """Whether every reference that is present and not null names the post."""
    agrees, quoted = F.lit(True), F.concat(F.lit('"'), post_id, F.lit('"'))
    for literal in map(p.literal, names):
        agrees = agrees & (literal.isNull() | literal.isin(F.lit("null"), post_id, quoted))
    return agrees
