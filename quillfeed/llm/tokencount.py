"""Token counts by byte-pair merging with a heap and a linked list; no identifiers come out.

A word is a chain of symbols. A heap holds the rank and place of each adjacent pair that the vocabulary merges; the
lowest rank goes first, the same rank from left to right, and a merge links the new symbol to its neighbours and enters
their new pairs. The number of tokens is that of the first symbols less that of the merges.

Words come from the file's own normaliser and pre-tokenizer. For plain byte-level files a text is cut before single
spaces first, where a word always ends, and what stands between is counted once for each of its kinds; kinds that were
met lately stay in memory, of a bounded number.

Cases: null text is the empty text (0 bytes, 0 tokens); very long texts and words are whole, in memory that grows as
their length; the strings of special tokens in a text are one token each, as the library takes them; repeated rows are
counted one by one; a null id is kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import repeat
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillfeed.llm.arrow import slices, utf8_view
from quillfeed.llm.packing import WORDS, default_tokenizer
from quillfeed.session import ship_package

#: Tokens beyond which a text is over the limit.
LIMIT = 512
#: Kinds of words and of pieces of text whose counts stay in memory; beyond it, memory starts anew.
REMEMBERED = 1_000_000
#: Symbols of a word from which its links are kept in arrays.
LONG = 4096
#: Characters of a piece beyond which its count is not kept.
KEPT_LENGTH = 64


class Merges:
    """The merges of a vocabulary: rank and result of each pair of symbols."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.symbol: dict[str, int] = {}
        number = lambda s: self.symbol.setdefault(s, len(self.symbol))
        numbered = [(number(left), number(right), number(left + right)) for left, right in pairs]
        self.width = len(self.symbol) + 1  # one more number stands for symbols that no pair knows
        self.rank = {left * self.width + right: i for i, (left, right, _) in enumerate(numbered)}
        self.result = [r for _, _, r in numbered]

    def tokens(self, symbols: list[str]) -> int:
        """How many tokens a chain of symbols becomes; symbols that no pair knows stay as they are."""
        n, width = len(symbols), self.width
        rank, result, push, pop = self.rank.get, self.result, heapq.heappush, heapq.heappop
        chain = list(map(self.symbol.get, symbols, repeat(width - 1)))
        # An entry is rank * n + place; a place's entry is live while its pair stands.
        found = [rank(a * width + b, -1) for a, b in zip(chain, chain[1:])]
        live = [r * n + i if r >= 0 else -1 for i, r in enumerate(found)]
        live.append(-1)
        heap = [e for e in live if e >= 0]
        if not heap:
            return n
        heapq.heapify(heap)
        places = list if n < LONG else partial(array, "l")
        after, before = places(range(1, n + 1)), places(range(-1, n - 1))
        merges = 0
        while heap:
            entry = pop(heap)
            at = entry % n
            if live[at] != entry:
                continue
            merges += 1
            symbol = chain[at] = result[entry // n]
            right = after[at]
            live[right] = -1
            right = after[at] = after[right]
            more = -1
            if right < n:
                before[right] = at
                more = rank(symbol * width + chain[right], -1)
            if more < 0:
                live[at] = -1
            else:
                live[at] = entry = more * n + at
                push(heap, entry)
            left = before[at]
            if left >= 0:
                more = rank(chain[left] * width + symbol, -1)
                if more < 0:
                    live[left] = -1
                else:
                    live[left] = entry = more * n + left
                    push(heap, entry)
        return n - merges


class Counts(dict):
    """Counts that a function makes where they are asked for first; those of short keys are kept, up to a number of them."""

    def __init__(self, make, kept: int = REMEMBERED):
        super().__init__()
        self.make, self.kept = make, kept

    def __missing__(self, key: str) -> int:
        n = self.make(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= self.kept:
                self.clear()
            self[key] = n
        return n


class TokenCounter:
    """Counts tokens as the `tokenizers` library does for a BPE file; made once for each Python worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        model, before, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix")):
            raise ValueError(f"{path}: only plain BPE is counted")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{path}: added tokens that take neighbours with them, or are normalised, are not counted")
        self.merges = Merges([tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
        self.end = model.get("end_of_word_suffix") or ""
        self.added = re.compile("|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))) if added else None
        self.byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not spec.get("normalizer")
        self.alphabet = _byte_symbols()
        self.cut = regex.compile(WORDS).findall
        self.words = Counts(self._word)
        self.parts = Counts(self._part)

    def _word(self, word: str) -> int:
        """Tokens of one word: of its bytes where the file is byte-level, else of its characters."""
        symbols = [self.alphabet[b] for b in word.encode()] if self.byte_level else list(word)
        if self.end and symbols:
            symbols[-1] += self.end
        return self.merges.tokens(symbols)

    def _part(self, part: str) -> int:
        return sum(map(self.words.__getitem__, self.cut(part)))

    def _plain(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        if not self.byte_level:
            text = text if self.library.normalizer is None else self.library.normalizer.normalize_str(text)
            return sum(self.words[w] for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text))
        if not text:
            return 0
        found = Counter(_parts(text))
        return sum(map(mul, found.values(), map(self.parts.__getitem__, found)))

    def count(self, text: str) -> int:
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        found = len(self.added.findall(text))
        return found + sum(self._plain(t) for t in self.added.split(text))


_LONE_SPACE = re.compile(r"(?<=\S)(?= )")
_WIDE = re.compile(r"\s ")


def _parts(text: str) -> list[str]:
    """A text cut before each space that follows no white space: no word of it crosses such a place."""
    if _WIDE.search(text):
        return _LONE_SPACE.split(text)
    return text.replace(" ", "\0 ").split("\0") if "\0" not in text else _LONE_SPACE.split(text)


def _byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones are themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def token_counts(df: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_tokens and whether they are over the limit."""
    ship_package(df.sparkSession)
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for whole in batches:
            for batch in slices(whole, 1):
                sizes = np.diff(utf8_view(batch.column(1))[1])
                tokens = np.array([count(t) if t else 0 for t in batch.column(1).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"]
                )

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
