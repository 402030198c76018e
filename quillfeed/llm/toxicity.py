"""Toxicity by a weighted finite-state pattern grammar.

Words are mapped to classes (insult, threat, target, first person, negation, reported speech). Small transducers are
composed into one machine, which reads the classes of a clause: reported speech, negation, targets and first persons
mark the insults and threats that come within their reach, and the last machine, which is weighted, sums the marked
ones. An aimed insult weighs more than a bare one, a negated or merely quoted one less; a threat counts where a target
or an insult stands before or after it in the clause, or a first person means it. A logistic fit on labelled rows turns
the weights of a document's clauses into a score.

The insult class holds stated words and stems learned from labelled rows: beginnings of words that stand in toxic
documents, in many different surroundings, far more often than in others.

Cases: a null or empty text has no clause and gets the score of such texts; very long texts are whole; equal weights
are summed as they are; repeated rows are scored one by one; a null id is kept; without labels of both kinds the
stated words and default weights hold; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.llm.arrow import annotate, rows_where, with_outputs
from quillfeed.session import ship_package

#: Word lists of the grammar's classes.
INSULTS = """idiot idiots idiotic moron morons moronic stupid dumb dumbass scum loser losers pathetic disgusting trash
garbage worthless clown clowns jerk imbecile fool filthy vermin bastard bitch asshole shithead dickhead twat wanker
cretin degenerate parasite subhuman retard retarded whore slut pig idiota imbécil estúpido estúpida basura asqueroso
imbécile stupide connard ordure abruti salaud dumm dummkopf arschloch abschaum vollidiot trottel""".split()
THREATS = """kill killing murder shoot stab hang burn strangle beat crush destroy hurt slaughter lynch exterminate
matar mataré tuer tuerai töten umbringen""".split()
TARGETS = """you your yours yourself u ur he she they them him her his their those these people everyone all tu vous
toi tú usted ustedes du dich euch sie ihr""".split()
FIRST_PERSONS = "i we i'll we'll i'm we're i'd we'd ich wir je nous yo nosotros".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't didn't nobody nor without nicht kein keine pas jamais nunca".split()
REPORTS = """said says say wrote writes called quoted quote quotes reported according stated tweeted posted replied
alleged sagte schrieb dit écrit dijo escribió""".split()

#: Classes of words, the alphabet of the transducers; OTHER is any other word.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, FIRST = "oithnrf"
#: Marks that follow an insult or a threat: aimed at a target, meant by a first person, negated, reported.
AIMED, MEANT, NEGATED, REPORTED = "!@-~"
#: Words within which a negation, a target or a first person reaches a match.
REACH = 4
#: Weights: of a bare and an aimed insult; of a threat that has a target, of one that is only meant, of one that is both.
BARE, AIMED_INSULT, TARGETED_THREAT, MEANT_THREAT, FULL_THREAT = 1.0, 1.5, 0.8, 0.5, 1.2
#: Factors of marks.
FACTORS = {NEGATED: 0.4, REPORTED: 0.5}

_WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")
_CLAUSES = re.compile(r"[.!?;:\n\r…]+")

#: Labelled rows of a class that learning takes at most: a uniform sample by hash of the id, the fit's stated bound.
ROWS_OF_A_CLASS = 4_000
#: Words whose class a worker remembers at most.
KNOWN_WORDS = 50_000
STEM_LENGTHS = (3, 4, 5, 6)
#: Toxic documents and different surroundings that a learned stem has at least, and its ratio of shares.
MIN_DOCUMENTS, MIN_SURROUNDINGS, MIN_RATIO = 5, 5, 20.0


class Transducer:
    """A deterministic weighted transducer over classes: (state, symbol) -> (state, symbol out, weight)."""

    def __init__(self, start, arcs: dict, default=None):
        self.start, self.arcs, self.default = start, arcs, default

    def step(self, state, symbol):
        arc = self.arcs.get((state, symbol))
        if arc is None:
            arc = self.default(state, symbol) if self.default else (state, symbol, 1.0)
        return arc


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds the first one's output to the second; weights multiply. Arcs are made when first met."""
    arcs: dict = {}

    def arc(state, symbol):
        a, out, w = first.step(state[0], symbol)
        b, final, v = second.step(state[1], out)
        arcs[state, symbol] = made = ((a, b), final, w * v)
        return made

    return Transducer((first.start, second.start), arcs, arc)


def marker(symbol: str, mark: str, reach: int | None) -> Transducer:
    """Marks the insults and threats that follow `symbol` within `reach` words (None: to the clause's end)."""

    def arc(state, s):
        if s[0] == symbol:
            return (reach if reach is not None else -1, s, 1.0)
        out = s + mark if s[0] in (INSULT, THREAT) and state != 0 else s
        return (state if state <= 0 else state - 1, out, 1.0)

    return Transducer(0, {}, arc)


def matcher() -> Transducer:
    """The weights of marked insults and threats; what still waits for a target is kept in the state.

    State: whether a target or an insult has come up, the weight that a threat still gets from the next one, and the
    weight that a bare insult still gets from a target within so many words.
    """

    def arc(state, s):
        came, threat, insult, left = state
        factor = math.prod(f for m, f in FACTORS.items() if m in s)
        if s[0] == INSULT:
            if AIMED in s:
                return ((True, 0.0, 0.0, 0), s, AIMED_INSULT * factor + threat)
            return ((True, 0.0, (AIMED_INSULT - BARE) * factor, REACH), s, BARE * factor + threat)
        left = max(0, left - (s[0] != TARGET))
        insult = insult if left else 0.0
        if s[0] == TARGET:
            return ((True, 0.0, 0.0, 0), s, threat + insult)
        if s[0] == THREAT:
            whole = FULL_THREAT if MEANT in s else TARGETED_THREAT
            now = whole if came else MEANT_THREAT if MEANT in s else 0.0
            return ((came, max(threat, (whole - now) * factor), insult, left), s, now * factor)
        return ((came, threat, insult, left), s, 0.0)

    return Transducer((False, 0.0, 0.0, 0), {}, arc)


def grammar() -> Transducer:
    """Reported speech, negation, targets and first persons, composed over the matcher."""
    machine = compose(marker(REPORT, REPORTED, None), marker(NEGATION, NEGATED, REACH))
    machine = compose(machine, marker(TARGET, AIMED, REACH))
    machine = compose(machine, marker(FIRST, MEANT, REACH))
    return compose(machine, matcher())


def words_of(text: str) -> list[str]:
    """Lower-cased words; typographic apostrophes are plain ones."""
    return _WORDS.findall(text.lower().replace("’", "'"))


class Lexicon:
    """Classes of words; learned stems are insults too. Answers are kept for words met before, up to a bound."""

    def __init__(self, stems: dict[str, float] | None = None):
        self.fixed = {}
        for words, kind in ((REPORTS, REPORT), (NEGATIONS, NEGATION), (FIRST_PERSONS, FIRST), (TARGETS, TARGET), (THREATS, THREAT), (INSULTS, INSULT)):
            self.fixed |= {w: kind for w in words}
        self.stems = stems or {}
        self.lengths = sorted({len(s) for s in self.stems})
        self.known: dict[str, str] = {}

    def __getstate__(self):
        return {"fixed": self.fixed, "stems": self.stems, "lengths": self.lengths, "known": {}}

    def kind(self, word: str) -> str:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > KNOWN_WORDS:
                self.known.clear()
            got = self.fixed.get(word)
            if got is None:
                got = INSULT if any(word[:n] in self.stems for n in self.lengths if len(word) >= n) else OTHER
            self.known[word] = got
        return got


def clause_weights(text: str, lexicon: Lexicon, machine: Transducer) -> list[float]:
    """Weights of the clauses that match, in order."""
    lowered = text.lower().replace("’", "'")
    kind = lexicon.kind
    hot = {w for w in set(_WORDS.findall(lowered)) if kind(w) in (INSULT, THREAT)}
    if not hot:
        return []
    out = []
    for clause in _CLAUSES.split(lowered):
        words = _WORDS.findall(clause)
        if hot.isdisjoint(words):
            continue
        state, total = machine.start, 0.0
        for w in words:
            state, _, weight = machine.step(state, kind(w))
            total += weight
        if total > 0:
            out.append(total)
    return out


def features(weights: list[float]) -> tuple[float, float, float]:
    return (math.log1p(len(weights)), math.log1p(sum(weights)), max(weights, default=0.0))


class Model:
    def __init__(self, stems: dict[str, float] | None = None, bias: float = -3.0, slopes=(1.0, 3.0, 1.0)):
        self.lexicon, self.bias, self.slopes = Lexicon(stems), bias, tuple(slopes)
        self.machine = None

    def __getstate__(self):
        return self.__dict__ | {"machine": None}

    def clauses(self, text: str | None) -> list[float]:
        if self.machine is None:
            self.machine = grammar()
        return clause_weights(text or "", self.lexicon, self.machine)

    def score(self, weights: list[float]) -> float:
        z = self.bias + sum(a * b for a, b in zip(self.slopes, features(weights), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _stem_rows(batches: Iterator[pa.RecordBatch], wanted: set[str] | None) -> Iterator[pa.RecordBatch]:
    """Documents of each stem in this task, and a 64-bit map of the surroundings that it was met in."""
    counts: dict[str, int] = {}
    around: dict[str, int] = {}
    for batch in batches:
        for text in batch.column(0).to_pylist():
            words = words_of(text or "")
            seen: set[str] = set()
            for i, w in enumerate(words):
                found = [w[:n] for n in STEM_LENGTHS if len(w) >= n] + ([w] if len(w) not in STEM_LENGTHS else [])
                if wanted is None:
                    beside = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
                    place = 1 << zlib.crc32(beside.encode("utf-8", "surrogatepass")) % 63
                    for s in found:
                        around[s] = around.get(s, 0) | place
                    seen.update(found)
                else:
                    seen.update(s for s in found if s in wanted)
            for s in seen:
                counts[s] = counts.get(s, 0) + 1
    stems = [*counts]
    yield pa.RecordBatch.from_arrays(
        [pa.array(stems, pa.string()), pa.array([counts[s] for s in stems], pa.int64()), pa.array([around.get(s, 0) for s in stems], pa.int64())],
        names=["stem", "n", "around"],
    )


def train(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id", learn_stems: bool = True
) -> Model:
    """Learns stems and the logistic weights from documents whose label is 0 or 1, a bounded sample of each.

    Without `learn_stems` the insults are the stated words alone.

    The sample is drawn among the labels alone, so only its few thousand ids meet the documents, by broadcast.
    """
    ship_package(docs.sparkSession)
    rows = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(id_col, F.col(label_col).cast("int").alias("y"))
    per = {r[0]: r[1] for r in rows.groupBy("y").count().collect()}
    if len(per) < 2:
        return Model()
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("toxicity")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col("y") == 1, min(1.0, ROWS_OF_A_CLASS / per[1])).otherwise(min(1.0, ROWS_OF_A_CLASS / per[0]))
    picked = F.broadcast(rows.filter(draw < share))  # two classes of about ROWS_OF_A_CLASS rows
    sample = docs.select(id_col, text_col).join(picked, id_col).select(text_col, "y").persist()
    try:
        model = _fit(sample, text_col, learn_stems)
    finally:
        sample.unpersist()
    return model


def _fit(sample: DataFrame, text_col: str, learn_stems: bool) -> Model:
    size = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    if len(size) < 2:
        return Model()
    stems = _stems(sample, text_col, size) if learn_stems else {}
    model = Model(stems)
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = [features(shared.value.clauses(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x[k] for x in f], pa.float64()) for k in range(3)), batch.column(1)], names=["a", "b", "c", "y"]
            )

    found = sample.mapInArrow(run, "a double, b double, c double, y int").collect()  # two classes of ROWS_OF_A_CLASS rows
    x = np.array([[1.0, r["a"], r["b"], r["c"]] for r in found])
    y = np.array([r["y"] for r in found], dtype=float)
    w = logistic(x, y)
    return Model(stems, float(w[0]), [float(v) for v in w[1:]])


def _stems(sample: DataFrame, text_col: str, size: dict[int, int]) -> dict[str, float]:
    schema = "stem string, n long, around long"
    surroundings = F.bit_count(F.bit_or("around"))
    toxic = (
        sample.filter("y = 1").select(text_col).mapInArrow(lambda b: _stem_rows(b, None), schema)
        .groupBy("stem").agg(F.sum("n").alias("n"), surroundings.alias("around"))
        .filter((F.col("n") >= MIN_DOCUMENTS) & (F.col("around") >= MIN_SURROUNDINGS))
    )
    # A stem stands in 5 of 4,000 sampled documents at least, so their number is bounded by the sample's words.
    met = {r["stem"]: (r["n"], r["around"]) for r in toxic.collect()}
    wanted = sample.sparkSession.sparkContext.broadcast(set(met))
    clean = (
        sample.filter("y = 0").select(text_col).mapInArrow(lambda b: _stem_rows(b, wanted.value), schema)
        .groupBy("stem").agg(F.sum("n").alias("n"))
    )
    other = {r["stem"]: r["n"] for r in clean.collect()}
    stems: dict[str, float] = {}
    for stem in sorted(met, key=lambda s: (len(s), s)):
        n, around = met[stem]
        ratio = ((n + 0.5) / size[1]) / ((other.get(stem, 0) + 0.5) / size[0])
        # Copies of one passage repeat its few surroundings; a real insult meets new ones, up to what 63 bits can tell.
        if ratio >= MIN_RATIO and around >= min(20, 0.5 * n) and not any(stem[:k] in stems for k in range(3, len(stem))):
            stems[stem] = math.log(ratio)
    return stems


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the first column is the bias, which is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + shrink * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _scored(df: DataFrame, model: Model, text_col: str) -> tuple[DataFrame, list[str]]:
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(texts: list[str | None]) -> list[pa.Array]:
        clauses = [shared.value.clauses(t) for t in texts]
        return [pa.array([shared.value.score(c) for c in clauses], pa.float64()), pa.array([len(c) for c in clauses], pa.int32())]

    return annotate(df, text_col, "double, int", work)


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The columns of `df`, with toxic_score and n_clauses (matched clauses) of every whole text; input columns of
    these names give way."""
    return with_outputs(_scored(df, model, text_col), "toxic_score", "n_clauses")


def keep(df: DataFrame, model: Model, below: float, text_col: str = "text") -> DataFrame:
    """Rows of `df`, as they are, whose score is below `below`."""
    return rows_where(_scored(df, model, text_col), F.col("o0") < below)
