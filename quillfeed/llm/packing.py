"""Bounded-space online best-fit packing of token sequences.

Pieces arrive one by one. A fixed number of bins stays open; a bitset has a bit for every amount of free space that
some open bin offers, so the tightest bin that still fits is one shift and one lowest-bit step away. If none fits, a
new bin opens, and when that is one too many, the fullest open bin closes.

Cases: null text is the empty text (its only token is the end mark); empty texts are packed like others; texts longer
than a sequence are cut into full sequences, of which only the first piece may be shorter; repeated rows are packed
one by one; a null id is kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.llm.arrow import slices
from quillfeed.session import cut_lineage, ship_package

END_ID = 0
CAPACITY = 2048
OPEN_BINS = 1024
#: Pieces that one task packs, on average.
PIECES_PER_TASK = 262_144

_encoders: dict[str, object] = {}
_proofs: dict[str, bool] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Fixed value: the pattern of words that the byte-level pre-tokenizer of the `tokenizers` library cuts at.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Token ids of a byte-level BPE file of the `tokenizers` library, special tokens of a text included.

    Where the file's vocabulary and merges prove that tiktoken makes the same ids, texts are encoded there, which is
    several times faster. A text that tiktoken refuses is encoded by `tokenizers` itself.
    """

    def __init__(self, path: str, proved: bool | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.slow = tokenizers.Tokenizer.from_file(path)
        self.fast = self._fast() if (same_by_rank(self.slow) if proved is None else proved) else None

    def _fast(self):
        import tiktoken

        spec = json.loads(self.slow.to_str())
        byte_of = _byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        return tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), dtype=np.uint32)
            except ValueError:  # its pattern matcher refuses some very long runs
                pass
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def same_by_rank(tokenizer) -> bool:
    """Whether merging by the rank of the result, as tiktoken does, makes the ids of this `tokenizers` BPE.

    Ranks and merges must have one order, and every token must be what its own bytes encode to. Then the two last
    parts of a token are always those of its merge: what stands side by side and makes the token has been merged
    inside its bytes alone, in the same order. Words and special tokens must be cut alike too.
    """
    import tokenizers

    spec = json.loads(tokenizer.to_str())
    model, before, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
    plain = model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    alone = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
    if not (plain and byte_level and alone) or spec.get("normalizer") or spec.get("truncation") or spec.get("padding"):
        return False
    vocab, special = model["vocab"], {t["content"] for t in added}
    tokens = [t for t in vocab if t not in special]
    merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", ""), -1) for m in model["merges"]]
    singles = [vocab.get(c, -1) for c in _byte_alphabet()]
    ordered = all(a < b for a, b in zip([max(singles), *merged], merged, strict=False)) and min(singles) >= 0
    if not ordered or len(tokens) != len(singles) + len(merged):
        return False
    bare = tokenizers.Tokenizer(tokenizers.models.BPE(vocab=vocab, merges=[tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]))
    return all(bare.encode(t).ids == [vocab[t]] for t in tokens)


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level BPE vocabulary stands for: printable bytes are themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def proof(path: str) -> bool:
    """The result of `same_by_rank` for a file, made once."""
    if path not in _proofs:
        import tokenizers

        _proofs[path] = same_by_rank(tokenizers.Tokenizer.from_file(path))
    return _proofs[path]


def encoder(path: str, proved: bool | None = None) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path, proved)
    return _encoders[path]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole if it fits, else full pieces after a shorter first one."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = [0, *range(first, length, capacity)] if first else [*range(0, length, capacity)]
    return [(s, (starts[i + 1] if i + 1 < len(starts) else length) - s) for i, s in enumerate(starts)]


class BestFit:
    """The open bins: a stack of bins for each free space, and the bitset of free spaces that occur."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits, self.stacks = 0, [[] for _ in range(capacity + 1)]
        self.opened = self.used = 0

    def place(self, length: int) -> tuple[int, int]:
        """The bin of the next piece and the piece's offset there."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_id = self._pop(free)
        else:
            if self.opened >= self.open_bins:
                self._pop((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            bin_id, free = self.used, self.capacity
            self.used += 1
        if free > length:
            self._push(free - length, bin_id)
        return bin_id, self.capacity - free

    def _pop(self, free: int) -> int:
        stack = self.stacks[free]
        bin_id = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.opened -= 1
        return bin_id

    def _push(self, free: int, bin_id: int) -> None:
        self.stacks[free].append(bin_id)
        self.bits |= 1 << free
        self.opened += 1


def tokenised_pieces(
    df: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32."""
    ship_package(df.sparkSession)
    id_type = df.schema[id_col].dataType
    proved = proof(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, proved).ids
        for whole in batches:
            for batch in slices(whole, 1):
                at, rows = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    ids = encode(text) if text else np.zeros(0, np.uint32)
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        at.append(i)
                        rows.append((k, start, length, zlib.crc32(ids[start : start + length])))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at, pa.int32())),
                        *(pa.array([r[j] for r in rows], pa.int32() if j == 0 else pa.int64()) for j in range(4)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    schema = f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return df.select(id_col, text_col).mapInArrow(run, schema)


def pack(
    df: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Packs every document; returns doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    Full pieces are sequences of their own and never move. The others are dealt by row position, so that a hot id
    spreads over all tasks, and each task packs its stream in a fixed order: a retried task makes the same bins.
    """
    spark = df.sparkSession
    pieces = tokenised_pieces(df, tokenizer or default_tokenizer(), capacity, id_col, text_col)
    pieces = cut_lineage(pieces).withColumn("row", F.monotonically_increasing_id())
    full = pieces.filter(F.col("length") == capacity)
    short = pieces.filter(F.col("length") < capacity)
    tasks = max(1, -(-short.count() // PIECES_PER_TASK))
    dealt = (
        short.withColumn("deal", F.xxhash64("row"))
        .repartition(tasks, "deal")
        .sortWithinPartitions("deal", "row")
        .select("doc_id", "piece", "start", "length", "ids_crc32")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        bins = BestFit(capacity, open_bins)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([base + b for b, _ in placed], pa.int64()),
                    pa.array([o for _, o in placed], pa.int64()),
                ],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    packed = dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")
    alone = full.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (-F.col("row") - F.lit(1)).alias("sequence_id"),  # below 0, where no packed sequence is
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(alone)
