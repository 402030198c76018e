"""Near-duplicates: MinHash bands, odd sketches, exact confirmation, connected components.

Each text becomes a set of word shingles. Equal sets, by 128 bits of digest, are one class from the start. A class has 128 MinHash samples:
32 bands of 4 find candidates (a pair of similarity 0.8 is missed with probability 5e-8), and the samples, folded
into a 256-bit parity map - the odd sketch - estimate a pair's similarity from the population count of the XOR,
which is precise where similarity is high. What passes is confirmed on full sets.

A band's bucket is never expanded into all pairs. First each member is held against the bucket's best connected
member: a large group of copies falls into one component there. A class may still have a link to another component
only if that share of its shingles stands in classes of other components, so all others leave (an exact condition,
checked by grouped counts, and again while classes leave). The few that stay are held against the best connected
member outside the hub's component, and what is then still apart is compared member by member, so that no link
between different components is lost.

Cases: a null or empty text or one without words has an empty set, is linked with nothing and kept; shorter texts
than a shingle are one shingle; very long texts are whole; ties go to the smallest id; rows that repeat an id with
equal text are one class; a row with a null id is never linked and is kept; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.llm.arrow import mix64, slices, utf8_view
from quillfeed.llm.components import connected_components
from quillfeed.llm.shingles import shingle_sets
from quillfeed.session import cut_lineage, discard, materialise, ship_package

SAMPLES, BANDS = 128, 32
SKETCH_BITS = 256
#: Differing sketch bits up to which a pair goes on to the full sets. At similarity 0.8 the count is 42 with a
#: standard deviation of 8, so 80 keeps all but about one link in a million and drops pairs below 0.5.
MAX_SKETCH_BITS = 80
#: Parts into which a bucket's members are dealt where they meet one of their own.
SALTS = 16
#: A bucket of n classes is dealt into sqrt(n / LEAST_BLOCK) blocks, so that copies sent to pairs of blocks grow as n ** 1.5;
#: a block holds MAX_BLOCK classes at most, on average, which bounds what one task compares.
LEAST_BLOCK, MAX_BLOCK = 64, 16_384
#: Times that the condition on shared shingles is checked again; more would only save pairs.
SIFTS = 3
#: Classes up to which the list of wanted ids is broadcast (16 bytes each); beyond it, the join shuffles.
BROADCAST_CLASSES = 1_000_000

_RNG = np.random.Generator(np.random.PCG64(8))
_FLIPS = _RNG.integers(0, 1 << 64, SAMPLES, dtype=np.uint64)
_ODDS = _RNG.integers(0, 1 << 64, SAMPLES, dtype=np.uint64) | np.uint64(1)
_PLACES = _RNG.integers(0, 1 << 64, SAMPLES, dtype=np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """128 minima of a non-empty set; blocks keep the work in cache, however large the set is."""
    low = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 256):
        np.minimum(low, ((shingles[at : at + 256, None] ^ _FLIPS) * _ODDS).min(axis=0), out=low)
    return low


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Four words of parity bits: each sample flips one bit."""
    places = mix64(samples ^ _PLACES) >> np.uint64(56)
    bits = (np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.uint64)


def set_sketch(shingles: np.ndarray) -> bytes:
    """The parity map of a whole set, of about 4 bits a shingle.

    The XOR of two such maps never has more ones than the sets differ in shingles, so a bound on it loses no link.
    """
    bits = 1 << min(16, max(8, int(4 * len(shingles) - 1).bit_length()))
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _near_in_block(group: pa.Table, low: int, high: int, allowed: float) -> pa.Table:
    """Pairs of different components, one from each block, that differ in few enough bits of their set sketches."""
    cid, comp, n, own = (np.asarray(group.column(c).to_numpy()) for c in ("cid", "comp", "n", "own"))
    maps = [np.frombuffer(w, np.uint64) for w in group.column("whole").to_pylist()]
    size = np.array([len(m) for m in maps])
    found: list[tuple] = []
    for width in np.unique(size):
        # Sizes of linked sets differ by a quarter at most, so one map is as wide as the other or twice or half as wide.
        at = np.flatnonzero((size == width) | (size == 2 * width))
        table = np.stack([maps[i] if size[i] == width else maps[i][:width] ^ maps[i][width:] for i in at])
        left = np.flatnonzero((size[at] == width) & (own[at] == low))
        for x in left:
            i = at[x]
            pick = (own[at] == high) & (comp[at] != comp[i]) & ((size[at] > width) | (own[at] != low) | (cid[at] > cid[i]))
            _compare(found, table, x, np.flatnonzero(pick), at, cid, n, allowed)
        if low != high:  # wider maps of the first block against narrower ones of the second
            for x in np.flatnonzero((size[at] == width) & (own[at] == high)):
                pick = (own[at] == low) & (comp[at] != comp[at[x]]) & (size[at] > width)
                _compare(found, table, x, np.flatnonzero(pick), at, cid, n, allowed)
    columns = list(zip(*found, strict=True)) or [[]] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "n_a", "n_b"])


def _compare(found: list, table: np.ndarray, x: int, others: np.ndarray, at: np.ndarray, cid: np.ndarray, n: np.ndarray, allowed: float) -> None:
    i = at[x]
    for start in range(0, len(others), 256):
        part = others[start : start + 256]
        ones = np.bitwise_count(table[part] ^ table[x]).sum(axis=1, dtype=np.int64)
        for j in at[part[ones <= (n[i] + n[at[part]]) * allowed + 1e-9]]:
            a, b = (i, j) if cid[i] < cid[j] else (j, i)
            found.append((int(cid[a]), int(cid[b]), int(n[a]), int(n[b])))


def band_hashes(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(BANDS, SAMPLES // BANDS)
    return mix64((rows * _ODDS[: rows.shape[1]]).sum(axis=1))


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of digest as two signed numbers."""
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), "<i8").tolist())


def unique_classes(signed: DataFrame) -> DataFrame:
    """The same rows with a cid for each digest of 128 bits: of sets that share the first 64, all but one get another cid."""
    known = signed.filter("cid is not null")
    shared = materialise(
        known.groupBy("cid").agg(F.min("more").alias("low"), F.max("more").alias("high")).filter("low <> high").select("cid", F.col("low").alias("first"))
    )
    clashes = shared.count()
    if clashes == 0:
        return signed
    again = F.when(F.col("first").isNull() | (F.col("first") == F.col("more")), F.col("cid")).otherwise(F.xxhash64("cid", "more"))
    shared = F.broadcast(shared) if clashes <= BROADCAST_CLASSES else shared
    return signed.join(shared, "cid", "left").select(*(again.alias("cid") if c == "cid" else c for c in signed.columns))


def signatures(df: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, cid and more (the set's digest, null for empty ones), bands and sketch."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                sizes, cids, more, bands, sketches = [], [], [], [], []
                for s in shingle_sets(*utf8_view(batch.column(1)), words):
                    sizes.append(len(s))
                    if len(s) == 0:
                        cids.append(None)
                        more.append(None)
                        continue
                    samples = minhash(s)
                    one, two = set_digest(s)
                    cids.append(one)
                    more.append(two)
                    bands.append(band_hashes(samples))
                    sketches.append(odd_sketch(samples))
                filled = np.cumsum([0, *(c is not None for c in cids)]).astype(np.int32)
                flat = lambda x: pa.array(np.concatenate([*x, np.zeros(0, np.uint64)]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(cids, pa.int64()),
                        pa.array(more, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(filled * BANDS), flat(bands)),
                        pa.ListArray.from_arrays(pa.array(filled * (SKETCH_BITS // 64)), flat(sketches)),
                    ],
                    names=["doc_id", "n_shingles", "cid", "more", "bands", "sketch"],
                )

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, n_shingles long, cid long, more long, bands array<long>, sketch array<long>")


def _full_sets(df: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(cid, shingles) of the wanted classes, made again from one text of each. wanted: rep, cid, more."""
    small = wanted.count() <= BROADCAST_CLASSES
    wanted = F.broadcast(wanted) if small else wanted
    texts = df.select(F.col(id_col).alias("rep"), F.col(text_col).alias("__text")).join(wanted, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                cids, sets = [], []
                asked = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
                for (cid, more), s in zip(asked, shingle_sets(*utf8_view(batch.column(0)), words), strict=True):
                    if len(s) and set_digest(s)[1] == more:  # of texts that share an id, that of the class
                        cids.append(cid)
                        sets.append(s)
                ends = np.cumsum([0, *(len(s) for s in sets)]).astype(np.int32)
                flat = pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["cid", "shingles"])

    return texts.select("__text", "cid", "more").mapInArrow(run, "cid long, shingles array<long>").dropDuplicates(["cid"])


def _close(n: Column, m: Column, percent: int) -> Column:
    """Sizes that allow the similarity at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


class Linker:
    """The classes of one table, their buckets and their components so far."""

    def __init__(self, df: DataFrame, words: int, percent: int, id_col: str, text_col: str):
        self.scratch: list[str] = []
        self.df, self.words, self.percent, self.id_col, self.text_col = df, words, percent, id_col, text_col
        self.signed = unique_classes(materialise(signatures(df, words, id_col, text_col)))
        known = self.signed.filter("cid is not null and doc_id is not null")
        self.classes = materialise(
            known.groupBy("cid").agg(
                F.min("doc_id").alias("rep"), F.first("more").alias("more"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
            )
        )
        self.brief = self.classes.select("cid", "n", "sketch")
        self.buckets = self._buckets()
        # (cid, comp) of classes that have moved from being their own component
        self.moved = df.sparkSession.createDataFrame([], "cid long, comp long")

    def _kept(self, df: DataFrame) -> DataFrame:
        """Materialised until the components are known."""
        return materialise(df, self.scratch)

    def _buckets(self) -> DataFrame:
        """(key, cid, degree) of buckets with two or more classes; degree counts a class's bucket fellows."""
        rows = self.classes.select("cid", F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("key"), "cid")
        shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        found = self._kept(rows.join(shared, "key"))
        degree = found.groupBy("cid").agg(F.sum("members").alias("degree"))
        return self._kept(found.select("key", "cid").join(degree, "cid").select("key", "cid", "degree"))

    def labelled(self) -> DataFrame:
        """(key, cid, degree, comp) of buckets that still hold two components or more."""
        return self._apart(self.buckets.join(self.moved, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")))

    def _apart(self, now: DataFrame) -> DataFrame:
        apart = now.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("key")
        return self._with(now, apart).select("key", "cid", "degree", "comp")

    def sketched(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that the odd sketches and the set sizes let through."""
        left = self.brief.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
        right = self.brief.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
        apart = sum((F.bit_count(F.col("s_a")[k].bitwiseXOR(F.col("s_b")[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))
        joined = pairs.select("a", "b").distinct().join(left, "a").join(right, "b")
        return joined.filter(_close(F.col("n_a"), F.col("n_b"), self.percent) & (apart <= MAX_SKETCH_BITS)).select("a", "b", "n_a", "n_b")

    def full_sets(self, cids: DataFrame) -> DataFrame:
        """(cid, shingles) of some classes."""
        wanted = self._kept(cids.distinct().join(self.classes.select("cid", "rep", "more"), "cid").select("rep", "cid", "more"))
        return self._kept(_full_sets(self.df, wanted, self.words, self.id_col, self.text_col))

    def sifted(self, now: DataFrame, sets: DataFrame) -> DataFrame:
        """Rows of classes with enough shingles that classes of other components hold too, in buckets that stay apart."""
        members = self._kept(now.select("cid", "comp").distinct().join(self.brief.select("cid", "n"), "cid"))
        left = members.count()
        for _ in range(SIFTS):
            spread = sets.join(members.select("cid", "comp"), "cid").select("cid", "comp", F.explode("shingles").alias("shingle"))
            foreign = spread.groupBy("shingle").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("shingle")
            shared = spread.join(foreign, "shingle", "left_semi").groupBy("cid").agg(F.count(F.lit(1)).alias("shared"))
            members = self._kept(members.join(shared, "cid").filter(F.col("shared") * 100 >= F.col("n") * self.percent).drop("shared"))
            before, left = left, members.count()
            if left == before:
                break
        return self._apart(now.join(members.select("cid"), "cid", "left_semi"))

    def confirmed(self, pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """Links among sketched pairs, on full sets. The member's set joins first, so that a hub's join is split by size."""
        pairs = self._kept(pairs)
        if sets is None:
            sets = self.full_sets(pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))))
        left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y"))
        common = F.size(F.array_intersect("x", "y"))
        linked = pairs.join(left, "a").join(right, "b").withColumn("common", common)
        return linked.filter(F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * self.percent).select("a", "b")

    def absorb(self, links: DataFrame) -> None:
        """Merges the components that the links join."""
        comp = self.moved
        at = lambda side: comp.select(F.col("cid").alias(side), F.col("comp").alias(f"comp_{side}"))
        edges = (
            links.join(at("a"), "a", "left").join(at("b"), "b", "left")
            .select(F.coalesce("comp_a", "a").alias("u"), F.coalesce("comp_b", "b").alias("v"))
        )
        roots = connected_components(edges)
        old = comp.join(roots, comp["comp"] == roots["node"], "left").select("cid", F.coalesce("component", "comp").alias("comp"))
        fresh = roots.join(comp, roots["node"] == comp["cid"], "left_anti").select(F.col("node").alias("cid"), F.col("component").alias("comp"))
        self.moved = cut_lineage(old.unionByName(fresh))

    @staticmethod
    def _with(now: DataFrame, one: DataFrame) -> DataFrame:
        """Joins one row of each key to the key's members, which are dealt by salt too, so that a hot bucket spreads."""
        salted = now.withColumn("__salt", F.pmod(F.xxhash64("cid"), F.lit(SALTS)).cast("int"))
        return salted.join(one.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["key", "__salt"]).drop("__salt")

    def hub_pairs(self, now: DataFrame) -> DataFrame:
        """Each member with its bucket's best connected member."""
        hub = now.groupBy("key").agg(F.max(F.struct("degree", "cid", "comp")).alias("hub"))
        return self._with(now, hub).filter("comp <> hub.comp").select(F.col("cid").alias("a"), F.col("hub.cid").alias("b"))

    def second_pairs(self, now: DataFrame) -> DataFrame:
        """Each member with the best connected one outside the component of the bucket's hub."""
        hub = now.groupBy("key").agg(F.max(F.struct("degree", "cid", "comp")).alias("hub"))
        outside = self._with(now, hub).filter("comp <> hub.comp")
        second = outside.groupBy("key").agg(F.max(F.struct("degree", "cid", "comp")).alias("second"))
        return self._with(now, second).filter("comp <> second.comp").select(F.col("cid").alias("a"), F.col("second.cid").alias("b"))

    def last_pairs(self, now: DataFrame, sets: DataFrame) -> DataFrame:
        """All pairs (a, b, n_a, n_b) of different components in a bucket that their whole sets' odd sketches let through.

        A bucket is dealt into blocks, and each pair of blocks is one group: sketches are
        compared in it, and only pairs that pass become rows.
        """
        allowed = (100 - self.percent) / (100 + self.percent)

        def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(1)
                ends, flat = np.asarray(column.offsets), np.asarray(column.values).view(np.uint64)
                made = [set_sketch(flat[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends), pa.int64()), pa.array(made, pa.binary())], names=["cid", "n", "whole"])

        sketches = sets.mapInArrow(sketch, "cid long, n long, whole binary")
        blocks = now.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select(
            "key", F.greatest(F.ceil(F.sqrt(F.col("n") / LEAST_BLOCK)), F.ceil(F.col("n") / MAX_BLOCK)).cast("int").alias("blocks")
        )
        rows = self._with(now.select("key", "cid", "comp"), blocks).join(sketches, "cid").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

        # Rows come dealt by bucket; dealt again by pair of blocks, a hot bucket's blocks spread over all tasks.
        rows = rows.select("key", "cid", "comp", "n", "whole", "own", "low", "high").repartition("key", "low", "high")

        def compare(keys: tuple, group: pa.Table) -> pa.Table:
            return _near_in_block(group.combine_chunks(), keys[1].as_py(), keys[2].as_py(), allowed)

        found = rows.groupBy("key", "low", "high").applyInArrow(compare, "a long, b long, n_a long, n_b long")
        return found.distinct()

    def run(self) -> DataFrame:
        """(cid, comp) of the classes that are not their component's root."""
        now = self._kept(self.labelled())
        if now.limit(1).count():
            self.absorb(self.confirmed(self.sketched(self.hub_pairs(now))))
        now = self._kept(self.labelled())
        if now.limit(1).count():
            sets = self.full_sets(now.select("cid"))
            for pairs in (lambda x: self.sketched(self.second_pairs(x)), lambda x: self.last_pairs(x, sets)):
                now = self._kept(self.sifted(now, sets))
                if now.limit(1).count() == 0:
                    break
                self.absorb(self.confirmed(pairs(now), sets))
                now = self._kept(self._relabelled(now))
        return self.moved

    def _relabelled(self, now: DataFrame) -> DataFrame:
        """The same rows under the components of now."""
        fresh = now.drop("comp").join(self.moved, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        return self._apart(fresh)


def near_duplicates(
    df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (its smallest id) and kept."""
    linker = Linker(df, words, percent, id_col, text_col)
    moved = linker.run()  # a checkpoint: the tables on the way to it are not read again
    discard(df.sparkSession, linker.scratch)
    labelled = linker.classes.select("cid", "rep").join(moved, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    first = labelled.groupBy("comp").agg(F.min("rep").alias("component"))
    component = labelled.join(first, "comp").select("cid", "component")
    out = linker.signed.select("doc_id", "n_shingles", "cid").join(component, "cid", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("component", "doc_id"))).alias("kept"),
    )
