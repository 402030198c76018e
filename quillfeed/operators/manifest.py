"""Corpus manifests: segment metadata, inventories, overlap proofs, forbidden fields, digests."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.functions.payload import Payload

#: Parts of field names that hold credentials.
FORBIDDEN = r"(?i)(cookie|token|password|passwd|secret|authorization|session|api_?key|credential)"


def segments(df: DataFrame, segment: Column, key: str, time: str, content: list[str] | None = None) -> DataFrame:
    """count, unique_ids, min_time, max_time of each segment, and an order-free digest of its content.

    The digest adds up a 62-bit hash of each row's SHA-256 (twice, with different parts), so it needs no order and
    partial sums meet in the shuffle.
    """
    line = F.sha2(F.to_json(F.struct(*(content or df.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda a: F.conv(F.substring(line, a, 15), 16, 10).cast("decimal(38,0)")
    return df.groupBy(segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("unique_ids"), F.min(time).alias("min_time"), F.max(time).alias("max_time"),
        F.sha2(F.concat_ws(":", F.sum(part(1)).cast("string"), F.sum(part(17)).cast("string"), F.count(F.lit(1)).cast("string")), 256).alias("digest"),
    )


def inventory_difference(declared: DataFrame, discovered: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: `missing` (declared, not there) or `undeclared`."""
    a, b = declared.select(key).distinct(), discovered.select(key).distinct()
    missing = a.join(b, key, "left_anti").withColumn("difference", F.lit("missing"))
    return missing.unionByName(b.join(a, key, "left_anti").withColumn("difference", F.lit("undeclared")))


def not_covered(archive: DataFrame, canonical: DataFrame, key: str) -> DataFrame:
    """Archived keys that the canonical corpus lacks; empty where the overlap is proven."""
    return archive.join(canonical.select(key), key, "left_anti")


def forbidden_fields(body: Column, pattern: str = FORBIDDEN) -> Column:
    """Keys that look like credentials."""
    return F.filter(Payload(body).keys, lambda k: k.rlike(pattern))


def semantic_digest(body: Column, *excluded: str) -> Column:
    """SHA-256 of an object whatever the order of its keys, without the excluded ones."""
    fields = F.map_filter(F.from_json(body, "map<string,string>"), lambda k, v: ~k.isin("", *excluded))
    return F.sha2(F.to_json(F.array_sort(F.map_entries(fields)), {"ignoreNullFields": "false"}), 256)


def has_exact_number(text: Column, number: str) -> Column:
    """Whether a number stands in a text as a token of its own, not inside a longer one."""
    if not number.isdigit():
        raise ValueError("digits only")
    return text.rlike(f"(?<![0-9]){number}(?![0-9])")


def snapshot_digest(files: DataFrame, root: str = "", framed: bool = True, ignored: str = r"(^|/)\.") -> DataFrame:
    """One digest of a `binaryFile` frame: SHA-256 over path and content digests in path order.

    Contents are digested where they are read; only path and digest of each file meet in the end. `framed` puts the
    8-byte length before each part, so that no two snapshots share a byte stream.
    """
    short = F.regexp_replace("path", "^" + root.replace("\\", r"\\"), "") if root else F.col("path")
    parts = files.select(short.alias("name"), F.sha2("content", 256).alias("d")).filter(~F.col("name").rlike(ignored))
    if framed:
        size = lambda c: F.unhex(F.lpad(F.hex(F.octet_length(c)), 16, "0"))
        piece = F.concat(size(F.col("name")), F.encode("name", "UTF-8"), size(F.col("d")), F.encode("d", "UTF-8"))
    else:
        piece = F.concat(F.encode("name", "UTF-8"), F.encode("d", "UTF-8"))
    listed = parts.select("name", F.hex(piece).alias("piece")).agg(F.array_sort(F.collect_list(F.struct("name", "piece"))).alias("all"), F.count(F.lit(1)).alias("n_files"))
    return listed.select("n_files", F.sha2(F.unhex(F.array_join(F.transform("all", lambda x: x["piece"]), "")), 256).alias("digest"))


def local_tree_digest(root: str) -> str:
    """The framed digest of a small local tree on the driver; symbolic links are refused."""
    out = hashlib.sha256()
    for folder, names, files in sorted(os.walk(root)):
        names.sort()
        for name in sorted(files):
            path = os.path.join(folder, name)
            if os.path.islink(path):
                raise ValueError(f"symbolic link: {path}")
            with open(path, "rb") as f:
                digest = hashlib.file_digest(f, "sha256").hexdigest().encode()
            label = os.path.relpath(path, root).encode()
            for part in (label, digest):
                out.update(len(part).to_bytes(8, "big") + part)
    return out.hexdigest()
