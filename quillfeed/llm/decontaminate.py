"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Numbers, names and units become typed placeholders, so that a question keeps its template when its parameters change.
Hashes of template windows are joined with those of the benchmark. Windows at one distance between document and item
are an alignment; its slots must be consistent: a value of the item stands for one value in the document wherever it
comes, and no other value of the item does. Consistent alignments that cover half of an item mark the document, and so
does a run of 13 words without a gap in an alignment, whose own slots are consistent, whatever else of the item was
edited.

Cases: null and empty texts and items have no windows; items shorter than a window are matched as a whole, and those of
fewer than 5 words only where they are a whole sentence, line or text of the document; very long texts are whole; a
document with several items is reported once with all; ties of coverage go to the smallest item id, which may be of any
ordered type; texts that share an item id are searched one by one, the best counts; rows that repeat an id count as one
document; rows with a null id are not reported (contaminated is false); empty tables give no matches; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.session import materialise

WINDOW = 8
#: Items of fewer words are found as whole sentences, lines or texts only.
MIN_WORDS = 5
MIN_COVERAGE = 0.5
MIN_RUN = 13
#: Share of an alignment's slot values that must be consistent.
MIN_CONSISTENT = 0.75
#: Benchmark windows up to which they are broadcast (about 24 bytes each); beyond it, the join shuffles.
BROADCAST_WINDOWS = 2_000_000
#: Document ids up to which a list of them is broadcast.
BROADCAST_IDS = 1_000_000

#: Words that are units where they follow a number.
UNITS = (
    "km|kilometers?|kilometres?|meters?|metres?|cm|mm|m|miles?|feet|foot|ft|inch(?:es)?|kg|kilograms?|grams?|g|mg|lbs?|pounds?|"
    "tons?|liters?|litres?|l|ml|gallons?|hours?|hrs?|h|minutes?|mins?|min|seconds?|secs?|s|days?|weeks?|months?|years?|"
    "percent|dollars?|cents?|euros?|usd|eur|mph|kmh|degrees?|watts?|kw|kwh|volts?|joules?"
)
#: Words that are no names where they start a sentence.
STARTERS = (
    "The|A|An|This|That|These|Those|It|Its|He|She|They|We|You|I|His|Her|Their|Our|My|Your|There|Here|What|Which|Who|Whom|Whose|"
    "When|Where|Why|How|If|In|On|At|By|For|From|To|Of|With|As|And|But|Or|Not|No|Yes|Is|Are|Was|Were|Be|Do|Does|Did|Has|Have|Had|"
    "Can|Could|Will|Would|Should|May|Must|Let|Then|So|After|Before|While|Each|Every|All|Some|Any|One|Two|Given|Find|"
    "Der|Die|Das|Ein|Eine|Es|Er|Sie|Wir|Und|Oder|Aber|Wenn|Was|Wer|Wie|Wo|Im|Am|Zu|"
    "Le|La|Les|Un|Une|Des|Il|Elle|Nous|Vous|Et|Ou|Mais|Si|Que|Qui|Dans|El|Los|Las|Una|Y|O|Pero|En|De|Se"
)
#: Number words, which join by a space, a hyphen or "and".
NUMBER_WORDS = (
    "zero|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|"
    "twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred|thousand|million|billion"
)
#: A name: capitalised words after a lower-case word or a comma, parted by a space or a hyphen. Words in capitals throughout are none.
_CAPITALISED = r"\p{Lu}[\p{Ll}\p{M}][\p{L}\p{M}]*"
# Repeated groups are possessive: Java walks back through others by recursion, which ends in an overflow on a long text.
_RUN = rf"{_CAPITALISED}(?:[ -]{_CAPITALISED})*+"
_NAMES = rf"(?<=[\p{{Ll}},] ){_RUN}"
#: The same, and a capitalised word at the start of a sentence that is no starter.
_STARTING_NAMES = (
    r"(?=\p{Lu})(?:(?<=[\p{Ll},] )|(?:(?<=^|[\n.!?…])|(?<=[\n.!?…][\s\"'”»)(])|(?<=[\n.!?…]\s[\s\"'“«(]))"
    rf"(?!(?:{STARTERS})(?![\p{{L}}\p{{M}}]))){_RUN}"
)
#: What is taken for a name: nothing, words inside sentences, or first words too.
NO_NAMES, INNER_NAMES, ALL_NAMES = None, _NAMES, _STARTING_NAMES
#: Ends of sentences and lines.
_ENDS = r"[.!?…]+(?=[\s\"'”»)]|$)|\n+"
NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
#: Stands between the words of one value.
JOINED = "\u0004"
_NUMBER_WORD = rf"(?:{NUMBER_WORDS})(?![\p{{L}}\p{{M}}\p{{N}}\x04])"
_NUMBER_WORDS = rf"(?i)(?<![\p{{L}}\p{{M}}\p{{N}}\x01-\x04]){_NUMBER_WORD}(?:(?:[ -]| and ){_NUMBER_WORD})*+"


def template_tokens(text: Column, values: bool = False, names: str | None = ALL_NAMES) -> Column:
    """Words of the canonical template in lower case; with `values`, a placeholder carries what it stands for.

    `names` says what is taken for a name. A name or a number of several words is one token, so forms with and without
    names may differ in their number of tokens; with and without values they have the same at the same positions.
    """
    kept = "$0" if values else ""
    t = F.replace(F.coalesce(text, F.lit("")), F.lit(JOINED), F.lit(" "))
    t = F.regexp_replace(t, names, f" {NAME}{kept} ") if names else t
    if values and names:  # the words of a name, from its mark on
        t = F.regexp_replace(t, rf"({NAME}{_CAPITALISED}|(?!\A)\G{_CAPITALISED})[ -](?={_CAPITALISED})", f"$1{JOINED}")
    t = F.regexp_replace(t, _NUMBER_WORDS, f" {NUMBER}{kept} ")
    if values:
        t = F.regexp_replace(t, rf"(?i)({NUMBER}(?:{NUMBER_WORDS})|(?!\A)\G(?:{NUMBER_WORDS}))(?: and |[ -])(?=(?:{NUMBER_WORDS})(?![\p{{L}}\p{{M}}]))", f"$1{JOINED}")
    t = F.regexp_replace(t, r"\p{N}+(?:[.,:/]\p{N}+)*+", f" {NUMBER}{kept} ")
    unit = rf"(?i)({NUMBER}[\p{{N}}.,:/{JOINED}\p{{L}}]*\s+)({UNITS})(?![\p{{L}}\p{{M}}\p{{N}}])"
    t = F.regexp_replace(t, unit, f"$1 {UNIT}{'$2' if values else ''} ")
    part = r"(?:[^\p{L}\p{M}\p{N}\x01-\x04.,:/]|(?<!\p{N})[.,:/]|[.,:/](?!\p{N}))++"
    if not values:  # no digits are left, so every mark parts words
        part = r"[^\p{L}\p{M}\x01-\x03]+"
    return F.filter(F.split(F.lower(t), part), lambda x: x != "") if values else F.array_remove(F.split(F.lower(t), part), "")


def _windows(hashes: str, n: int) -> Column:
    """Hashes of all runs of n tokens, in order."""
    h = F.col(hashes)
    rolled = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + F.lit(k)) for k in range(1, n))))
    return F.slice(rolled, F.lit(1), F.greatest(F.size(h) - F.lit(n - 1), F.lit(0)))


def benchmark_items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, item_id, item_text): one row with its own number for each distinct text of an id."""
    rows = benchmark.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("item_text"))
    rows = rows.filter(F.col("item_id").isNotNull()).distinct()
    return materialise(rows.withColumn("item", F.monotonically_increasing_id()))


def item_windows(items: DataFrame) -> DataFrame:
    """(item, form, ipos, w, width, n_windows) of the items that are long enough to be found anywhere.

    A capitalised first word may be a name or not, and the document may be in lower case or capitals: items have all
    forms. Places of two forms are the same where they have the same number of tokens, which is the form's number.
    """
    forms = F.array_distinct(F.array(*(template_tokens(F.col("item_text"), names=n) for n in (ALL_NAMES, INNER_NAMES, NO_NAMES))))
    tokens = items.select("item", F.explode(forms).alias("tokens"))
    hashed = tokens.select("item", F.size("tokens").alias("form"), F.transform("tokens", lambda x: F.xxhash64(x)).alias("h")).filter(F.size("h") >= MIN_WORDS)
    parts = []
    for n in range(MIN_WORDS, WINDOW + 1):
        own = hashed.filter(F.size("h") >= n if n == WINDOW else F.size("h") == n)
        parts.append(own.select("item", "form", F.lit(n).alias("width"), F.posexplode(_windows("h", n)).alias("ipos", "w"), F.greatest(F.size("h") - F.lit(n - 1), F.lit(1)).alias("n_windows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def _broadcast_if(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, coverage, run_words) of consistent matches that count as contamination."""
    items = benchmark_items(benchmark, item_col, item_text_col)
    windows = materialise(item_windows(items))
    counts = {r["width"]: r["n"] for r in windows.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}  # four widths at most
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text")).filter(F.col("doc_id").isNotNull())
    hashed = source.select("doc_id", F.transform(template_tokens(F.col("__text")), lambda x: F.xxhash64(x)).alias("h"))
    found = None
    for width in sorted(counts) or [WINDOW]:
        own = windows.filter(F.col("width") == width).select("w", "item", "form", "ipos", "n_windows", "width")
        exploded = hashed.select("doc_id", F.posexplode(_windows("h", width)).alias("pos", "w"))
        hit = exploded.join(_broadcast_if(own, counts.get(width, 0), BROADCAST_WINDOWS), "w")
        found = hit if found is None else found.unionByName(hit)
    # The same window of an item is at one place of an alignment, so a set of places is gathered, whatever repeats.
    aligned = (
        found.withColumn("shift", F.col("pos") - F.col("ipos"))
        .groupBy("doc_id", "item", "form", "shift")
        .agg(F.array_sort(F.collect_set("ipos")).alias("places"), F.first("n_windows").alias("n_windows"), F.first("width").alias("width"))
    )
    aligned = materialise(_pieces(aligned))
    whole = _covered(_consistent(aligned, source, items))
    brief = _sentences(source, items)
    if brief is not None:
        whole = whole.unionByName(brief)
    names = items.select("item", "item_id")
    named = whole.join(_broadcast_if(names, items.count(), BROADCAST_WINDOWS), "item")
    best = named.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "run_words")).alias("best"))
    return best.select("doc_id", "item_id", "best.coverage", "best.run_words")


def _sentences(source: DataFrame, items: DataFrame) -> DataFrame | None:
    """(doc_id, item, coverage, run_words) of items under MIN_WORDS words that are a whole sentence, line or text; None if there is no such item."""
    few = F.size("item_tokens").between(1, MIN_WORDS - 1)
    short = items.select("item", template_tokens(F.col("item_text"), names=INNER_NAMES).alias("item_tokens"), template_tokens(F.col("item_text"), True, INNER_NAMES).alias("item_values"))
    short = materialise(short.filter(few).withColumn("w", F.xxhash64("item_tokens")))
    n = short.count()
    if n == 0:
        return None
    text = F.coalesce(F.col("__text"), F.lit(""))
    parts = F.array_distinct(F.concat(F.array(text), F.split(text, "\n"), F.split(text, _ENDS)))
    said = source.select("doc_id", F.explode(parts).alias("said")).withColumn("tokens", template_tokens(F.col("said"), names=INNER_NAMES))
    said = said.filter(F.size("tokens").between(1, MIN_WORDS - 1)).withColumn("w", F.xxhash64("tokens"))
    hit = said.join(_broadcast_if(short, n, BROADCAST_WINDOWS), "w").filter(F.col("tokens") == F.col("item_tokens"))
    pairs = F.arrays_zip(F.col("item_values").alias("i"), template_tokens(F.col("said"), True, INNER_NAMES).alias("d"))
    alike = F.forall(
        pairs, lambda x: F.forall(pairs, lambda y: (x["i"] == y["i"]).eqNullSafe(x["d"] == y["d"]))
    )
    return hit.filter(alike).groupBy("doc_id", "item").agg(F.lit(1.0).alias("coverage"), F.max(F.size("tokens")).cast("long").alias("run_words"))


def _pieces(aligned: DataFrame) -> DataFrame:
    """Each alignment as a whole, and each gapless part of it that is long enough to mark a document by itself."""
    p = F.col("places")
    first = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - F.lit(1)) != x - F.lit(1), F.lit(True)))
    last = F.filter(p, lambda x, i: F.coalesce(F.get(p, i + F.lit(1)) != x + F.lit(1), F.lit(True)))
    parts = F.filter(F.arrays_zip(first.alias("low"), last.alias("high")), lambda x: x["high"] - x["low"] + F.col("width") >= MIN_RUN)
    pieces = F.array_distinct(F.concat(F.array(p), F.transform(parts, lambda x: F.sequence(x["low"], x["high"]))))
    out = aligned.select("doc_id", "item", "form", "shift", "n_windows", "width", F.explode(pieces).alias("places"))
    return out.select("*", F.array_min("places").alias("low"), F.array_max("places").alias("high"), F.size("places").alias("n"))


def _is_slot(token: Column) -> Column:
    return F.substring(token, 1, 1).isin(NUMBER, NAME, UNIT)


def _slots(tokens: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    # The outer form: below the plain one Spark infers a test for tokens, and makes them of rows that a join drops.
    return tokens.select(key, F.posexplode_outer("tokens").alias(pos, value)).filter(_is_slot(F.col(value)))


def _consistent(aligned: DataFrame, source: DataFrame, items: DataFrame) -> DataFrame:
    """Pieces without slots, and those whose slots are consistent."""
    piece = ["doc_id", "item", "form", "shift", "low", "high"]
    # A name is a slot only where the document has one there too, or else the windows have met in the very word.
    forms = F.array_distinct(F.array(*(template_tokens(F.col("item_text"), True, n) for n in (ALL_NAMES, INNER_NAMES, NO_NAMES))))
    item_tokens = items.select("item", F.explode(forms).alias("tokens")).select("item", F.size("tokens").alias("form"), F.posexplode("tokens").alias("slot_at", "item_value"))
    item_slots = item_tokens.filter(_is_slot(F.col("item_value"))).distinct()
    item_slots = materialise(item_slots.withColumn("maybe", F.substring("item_value", 1, 1) == NAME))
    inside = (F.col("slot_at") >= F.col("low")) & (F.col("slot_at") < F.col("high") + F.col("width"))
    slotted = aligned.join(_broadcast_if(item_slots, item_slots.count(), BROADCAST_WINDOWS), ["item", "form"]).filter(inside)
    slotted = materialise(slotted.select(*piece, "item_value", "maybe", (F.col("slot_at") + F.col("shift")).alias("pos")))
    ids = slotted.select("doc_id").distinct()
    wanted = source.join(_broadcast_if(ids, ids.count(), BROADCAST_IDS), "doc_id", "left_semi")
    doc_slots = _slots(wanted.select("doc_id", template_tokens(F.col("__text"), values=True).alias("tokens")), "doc_id", "pos", "doc_value").distinct()
    met = slotted.join(doc_slots, ["doc_id", "pos"], "left").filter(~F.col("maybe") | F.col("doc_value").isNotNull())
    values = met.groupBy(*piece, "item_value").agg(
        F.min("doc_value").alias("a"), F.max("doc_value").alias("b")
    )
    # One entry for each value of a piece, so never more than the item has slots.
    gathered = values.groupBy(*piece).agg(F.collect_list(F.struct("item_value", "a", "b")).alias("v"))
    same_kind = lambda x: F.substring(x["a"], 1, 1) == F.substring(x["item_value"], 1, 1)
    own = lambda x: F.size(F.filter("v", lambda y: y["a"] == x["a"])) == 1
    good = F.size(F.filter("v", lambda x: F.coalesce((x["a"] == x["b"]) & same_kind(x) & own(x), F.lit(False))))
    verdict = gathered.select(*piece, (good / F.size("v")).alias("consistent"))
    return aligned.join(verdict, piece, "left").filter(F.coalesce("consistent", F.lit(1.0)) >= MIN_CONSISTENT)


def _covered(aligned: DataFrame) -> DataFrame:
    """Coverage of each item by its alignments, and the longest gapless piece of them in words."""
    run = F.when(F.col("n") == F.col("high") - F.col("low") + 1, F.col("n") + F.col("width") - 1).otherwise(0)
    # A place of the item counts once, in however many alignments it comes.
    whole = aligned.select("doc_id", "item", "form", "n_windows", run.alias("run"), F.explode("places").alias("ipos")).groupBy("doc_id", "item", "form").agg(
        F.count_distinct("ipos").alias("n"), F.max("run").alias("run_words"), F.first("n_windows").alias("n_windows")
    )
    coverage = F.least(F.lit(1.0), F.col("n") / F.col("n_windows"))
    return whole.select("doc_id", "item", coverage.alias("coverage"), F.col("run_words").cast("long").alias("run_words")).filter(
        (F.col("coverage") >= MIN_COVERAGE) | (F.col("run_words") >= MIN_RUN)
    )


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, contaminated, n_items, item_id and coverage of its best match."""
    found = matches(docs, benchmark, id_col, text_col)
    best = found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.min(F.struct((-F.col("coverage")).alias("less"), "item_id")).alias("best")
    )
    best = best.select("doc_id", "n_items", F.col("best.item_id").alias("item_id"), (-F.col("best.less")).alias("coverage"))
    return docs.select(F.col(id_col).alias("doc_id")).join(best, "doc_id", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id", "coverage"
    )


def remove(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without a match; rows with a null id stay."""
    ids = materialise(matches(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(id_col)).distinct())
    return docs.join(_broadcast_if(ids, ids.count(), BROADCAST_IDS), id_col, "left_anti")
