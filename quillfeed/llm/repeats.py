"""Periodic runs of words, by refining classes of positions where equal factors start.

Two positions are in one class of length L if the same L words start at both. Classes of length L + 1 come from those
of length L by looking at the word class one place further on. Of the parts that a class falls into, the largest keeps
still: only positions before a member of some smaller part are moved, so that a position moves log n times at most
(the smaller half). Members that stand next to each other in a class of length L, at distance L, start a square; squares
at consecutive positions are one run.

All documents of a slice of a batch are refined together, level by level, in numpy: documents share no class, as each
word's number holds for one document only, and each document ends in a mark of its own.

Cases: a null text has no words, no runs and an empty collapsed text; empty texts likewise; very long texts are whole;
words are compared as bytes; a document of one repeated word is one run of period 1; repeated rows are judged one by
one; a null id is kept; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.llm.arrow import slices
from quillfeed.session import ship_package

#: A run holds this many words at least, and its period this many times.
MIN_WORDS = 6
MIN_EXPONENT = 4
#: Bytes of text that are refined together; one longer text is still taken whole.
TOGETHER = 4 << 20


class Classes:
    """Positions of some documents in classes of equal factors, each class a segment of `members` and a linked list."""

    def __init__(self, symbols: np.ndarray, limits: np.ndarray):
        """`symbols`: a number for each position, of equal words of one document. `limits`: the longest factor asked for there."""
        n = len(symbols)
        self.limits, self.length = limits, 1
        self.members = np.argsort(symbols, kind="stable")
        self.slot = np.empty(n, np.int64)
        self.slot[self.members] = np.arange(n)
        heads = np.flatnonzero(_changes(symbols[self.members]))
        self.begin, self.size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.begin[: len(heads)], self.size[: len(heads)] = heads, np.diff(np.append(heads, n))
        self.used = len(heads)
        self.of = np.empty(n, np.int64)
        self.of[self.members] = np.repeat(np.arange(len(heads)), self.size[: len(heads)])
        self.after, self.before = np.full(n, -1), np.full(n, -1)
        same = np.ones(n, bool)
        same[heads] = False
        at = np.flatnonzero(same)
        self.after[self.members[at - 1]], self.before[self.members[at]] = self.members[at], self.members[at - 1]
        self.small = np.arange(n)  # at the start every class counts as a smaller part
        self.waiting: dict[int, list[np.ndarray]] = {}
        self._wait(np.arange(n))

    def _wait(self, at: np.ndarray) -> None:
        """Notes positions under the distance to their next class member, until classes have that length."""
        at = at[self.after[at] >= 0]
        gap = self.after[at] - at
        asked = (gap >= self.length) & (gap <= self.limits[at])
        at, gap = at[asked], gap[asked]
        if len(at):
            order = np.argsort(gap, kind="stable")
            at, gap = at[order], gap[order]
            bounds = np.flatnonzero(_changes(gap))
            for length, a, b in zip(gap[bounds].tolist(), bounds.tolist(), [*bounds[1:].tolist(), len(at)], strict=True):
                self.waiting.setdefault(length, []).append(at[a:b])

    def squares(self) -> np.ndarray:
        """Positions where a square of two factors of the present length starts."""
        parts = self.waiting.pop(self.length, None)
        if parts is None:
            return np.zeros(0, np.int64)
        at = np.unique(np.concatenate(parts))
        return at[self.after[at] - at == self.length]

    def _segments(self, classes: np.ndarray) -> np.ndarray:
        """The members of some classes, one after the other."""
        sizes = self.size[classes]
        ends = np.cumsum(sizes)
        return self.members[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[classes] - ends + sizes, sizes)]

    def refine(self) -> bool:
        """Goes on to factors of one more word; False where no class can fall apart any more."""
        self.length += 1
        last = self.small
        moved = last[last > 0] - 1
        parent = self.of[moved]
        asked = (self.size[parent] > 1) & (self.limits[moved] >= self.length)
        moved, parent = moved[asked], parent[asked]
        if len(moved) == 0:
            self.small = moved
            return False
        order = np.lexsort((moved, self.of[moved + 1], parent))
        moved, parent, behind = moved[order], parent[order], self.of[moved[order] + 1]
        first = np.flatnonzero(_changes(parent) | _changes(behind))
        sizes = np.diff(np.append(first, len(moved)))
        own = parent[first]  # the class that each group leaves
        head = np.flatnonzero(_changes(own))
        groups = np.diff(np.append(head, len(own)))
        taken = np.add.reduceat(sizes, head)
        rest = self.size[own[head]] - taken
        split = (rest > 0) | (groups > 1)  # else the class goes on as it is
        keep = np.repeat(np.repeat(split, groups), sizes)
        if not keep.all():
            moved, parent = moved[keep], parent[keep]
            sizes, own = sizes[np.repeat(split, groups)], own[np.repeat(split, groups)]
            groups, taken, rest = groups[split], taken[split], rest[split]
            if len(moved) == 0:
                self.small = moved
                return True
            head = np.cumsum(groups) - groups
        self._unlink(moved, parent)
        self._to_the_end(moved, own[head], taken)
        largest = np.maximum.reduceat(sizes, head)
        # Where nothing stays behind, the largest group goes on under the class's number; groups lie behind the rest.
        begins = np.repeat(self.begin[own[head]] + rest, groups) + _within(sizes, groups)
        rank = np.lexsort((-sizes, np.repeat(np.arange(len(groups)), groups)))[head]  # one largest group of each class
        fresh = np.ones(len(sizes), bool)
        fresh[rank[rest == 0]] = False
        numbers = own.copy()
        numbers[fresh] = self.used + np.arange(int(fresh.sum()))
        self.used += int(fresh.sum())
        self.size[own[head]] = rest
        self.begin[numbers], self.size[numbers] = begins, sizes
        self.of[moved] = np.repeat(numbers, sizes)
        # All parts but one largest are the smaller ones; the rest may be one of them.
        big = np.zeros(len(sizes), bool)
        big[rank[largest >= rest]] = True
        behind_small = own[head][(rest > 0) & (largest >= rest)]
        self.small = np.concatenate([moved[np.repeat(~big, sizes)], self._segments(behind_small)])
        starts = np.zeros(len(moved), bool)
        starts[np.cumsum(sizes) - sizes] = True
        inner = np.flatnonzero(~starts)
        self.after[moved], self.before[moved] = -1, -1
        self.after[moved[inner - 1]], self.before[moved[inner]] = moved[inner], moved[inner - 1]
        self._wait(moved)
        return True

    def _unlink(self, moved: np.ndarray, parent: np.ndarray) -> None:
        """Takes positions out of their lists; the neighbours that stay are linked, and wait for their new distance."""
        at = moved[np.lexsort((moved, parent))]
        chain = np.ones(len(at), bool)  # whether a stretch of taken neighbours starts here
        chain[1:] = self.after[at[:-1]] != at[1:]
        starts = np.flatnonzero(chain)
        left, right = self.before[at[starts]], self.after[at[np.append(starts[1:], len(at)) - 1]]
        self.after[left[left >= 0]], self.before[right[right >= 0]] = right[left >= 0], left[right >= 0]
        self._wait(left[left >= 0])

    def _to_the_end(self, moved: np.ndarray, classes: np.ndarray, taken: np.ndarray) -> None:
        """Puts the positions into the last places of their classes' segments, in their order."""
        tail = np.repeat(self.begin[classes] + self.size[classes] - taken, taken) + _within(taken)
        there = self.members[tail]
        where = self.slot[moved]
        low = np.repeat(self.begin[classes] + self.size[classes] - taken, taken)
        self.slot[moved] = -1
        mark = self.slot[there] >= 0  # who stands in the tail and stays in the class
        free = where[where < low]  # places that the taken leave before the tail, as many in each class
        self.members[free], self.slot[there[mark]] = there[mark], free
        self.members[tail], self.slot[moved] = moved, tail


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether a value differs from the one before; the first does."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


def _within(sizes: np.ndarray, groups: np.ndarray | None = None) -> np.ndarray:
    """Running places: 0, 1, ... inside each size; with `groups`, where each size begins inside its group of sizes."""
    ends = np.cumsum(sizes)
    if groups is None:
        return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    heads = np.cumsum(groups) - groups
    return ends - sizes - np.repeat((ends - sizes)[heads], groups)


def runs_of(words: list[np.ndarray], min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[np.ndarray]:
    """The runs of each document (start, length, period), by start and period. `words`: a number for each word.

    `min_exponent` is 2 at least: what is repeated less often holds no square.
    """
    counts = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(counts + 1)  # with the end mark of each document
    if len(words) == 0 or counts.max() < min_words:
        return [np.zeros((0, 3), np.int64) for _ in words]
    doc = np.repeat(np.arange(len(words)), counts + 1)
    spread = int(max((w.max() for w in words if len(w)), default=0)) + 2
    numbers = np.concatenate([np.append(w, spread - 1) for w in words]).astype(np.int64) + doc * spread
    classes = Classes(numbers, np.repeat(counts // min_exponent, counts + 1))
    found: list[tuple[int, np.ndarray]] = []
    going = True
    while going and classes.length <= int(counts.max()) // min_exponent:
        at = classes.squares()
        if len(at):
            found.append((classes.length, at))
        going = classes.refine()
    found += [(length, at) for length, at in _rest(classes)]
    if not found:
        return [np.zeros((0, 3), np.int64) for _ in words]
    at = np.concatenate([a for _, a in found])
    period = np.repeat(np.array([k for k, _ in found]), [len(a) for _, a in found])
    head = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(period, prepend=-1) != 0))
    start, q = at[head], period[head]
    length = np.diff(np.append(head, len(at))) - 1 + 2 * q
    good = length >= np.maximum(min_words, min_exponent * q)
    start, length, q = start[good], length[good], q[good]
    order = np.lexsort((q, start))
    rows = np.stack([start, length, q], axis=1)[order]
    owner = doc[rows[:, 0]]
    rows[:, 0] -= (ends - counts - 1)[owner]
    return np.split(rows, np.searchsorted(owner, np.arange(1, len(words))))


def _rest(classes: Classes) -> Iterator[tuple[int, np.ndarray]]:
    """Squares that were waiting when classes had stopped to fall apart: they stand for all greater lengths."""
    for length in sorted(classes.waiting):
        classes.length = length
        at = classes.squares()
        if len(at):
            yield length, at


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that stand in a run after its first period."""
    if len(runs) == 0:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def scan_texts(texts: list[bytes | None], min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> tuple[list[np.ndarray], list[bytes]]:
    """(runs, collapsed text) of each text; words part at white space of ASCII."""
    words = [(t or b"").split() for t in texts]
    number: dict[bytes, int] = defaultdict(itertools.count().__next__)
    numbered = [np.fromiter(map(number.__getitem__, own), np.int64, len(own)) for own in words]
    runs = runs_of(numbered, min_words, min_exponent)
    return runs, [collapsed(w, r) for w, r in zip(words, runs, strict=True)]


def periodic_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """One row for each document: doc_id, `runs` (start, length, period; in words, by start and period) and `collapsed`.

    The collapsed text has each run's first period only, its words parted by one space.
    """
    ship_package(df.sparkSession)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, TOGETHER):
                runs, texts = scan_texts(batch.column(1).cast(pa.binary()).to_pylist(), min_words, min_exponent)
                flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
                offsets = np.cumsum([0, *(len(r) for r in runs)]).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run_type.value_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), fields), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(work, f"doc_id {id_type}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def greatest(runs: Column) -> Column:
    """The run of the greatest exact length / period; of equal ones the first. Null without a run.

    Quotients are compared by products, which stay exact; runs are in order of start and period.
    """

    def better(best: Column, run: Column) -> Column:
        surer = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | surer, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
