"""Snapshots of file trees as hash trees over path prefixes, and their difference.

Every file counts into each folder above it. A folder's digest adds up four 60-bit parts of the SHA-256 of its files'
lines (path and content digest), so it needs no order, partial sums meet in one shuffle, and no task gathers a folder.
The tree is a table of nodes by depth; two trees are compared from the root down, only below nodes that differ.
`manifest.snapshot_digest` is the one digest of a fixed byte format, for trees that one task can list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.session import discard, materialise

#: Parts of a SHA-256 (hexadecimal digits each) that are added up, each apart.
PARTS, DIGITS = 4, 15


def file_lines(files: DataFrame, root: str = "", ignored: str = r"(^|/)\.") -> DataFrame:
    """(path, content): paths below `root` and the digest of each file's bytes, of a `binaryFile` frame."""
    short = F.substring("path", len(root) + 1, 2147483647) if root else F.col("path")
    return files.select(short.alias("path"), F.sha2("content", 256).alias("content")).filter(~F.col("path").rlike(ignored))


def tree(lines: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(depth, node, parent, is_file, n_files, digest): the root at depth 0 with an empty name, folders, and files as leaves."""
    line = F.sha2(F.concat_ws("\u0000", F.col(path), F.col(content)), 256)
    segments = F.split(F.col(path), "/")
    prefixes = F.transform(F.sequence(F.lit(0), F.size("__s")), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice("__s", F.lit(1), i), "/").alias("node")))
    rows = lines.select(segments.alias("__s"), line.alias("__l")).select(F.size("__s").alias("__deep"), "__l", F.explode(prefixes).alias("p"))
    part = lambda k: F.conv(F.substring("__l", 1 + k * DIGITS, DIGITS), 16, 10).cast("decimal(38,0)")
    sums = [F.sum(part(k)).cast("string").alias(f"__{k}") for k in range(PARTS)]
    nodes = rows.groupBy(F.col("p.depth").alias("depth"), F.col("p.node").alias("node")).agg(F.count(F.lit(1)).alias("n_files"), F.max(F.col("p.depth") == F.col("__deep")).alias("is_file"), *sums)
    digest = F.sha2(F.concat_ws(":", F.col("n_files").cast("string"), *(f"__{k}" for k in range(PARTS))), 256)
    parent = F.when(F.col("depth") > 0, F.regexp_extract("node", r"(?s)\A(?:(.*)/)?[^/]*\z", 1))
    return nodes.select("depth", "node", parent.alias("parent"), "is_file", "n_files", digest.alias("digest"))


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, change): files that were added, removed or changed between two trees, which are stored by depth.

    One step for each depth: the children of the folders that differ are compared, all others are passed over.
    """
    spark, scratch, found = old.sparkSession, [], []
    differing = spark.createDataFrame([("",)], "parent string")
    depth, going = 0, True
    while going:
        at = lambda t, side: t.filter(F.col("depth") == depth).select("node", "parent", "is_file", F.struct("is_file", "digest").alias(side))  # noqa: B023, E731
        below = lambda t: t if depth == 0 else t.join(differing, "parent", "left_semi")  # noqa: B023, E731
        a, b = below(at(old, "old")).drop("parent", "is_file"), below(at(new, "new")).drop("parent", "is_file")
        met = a.join(b, "node", "full_outer").filter(~F.col("old").eqNullSafe(F.col("new")))
        level = materialise(met.select("node", "old", "new"), scratch)
        was, now = F.coalesce("old.is_file", F.lit(False)), F.coalesce("new.is_file", F.lit(False))
        change: Column = F.when(was & now, "changed").when(was, "removed").when(now, "added")
        found.append(level.select(F.col("node").alias("path"), change.alias("change")).filter("change is not null"))
        folders = level.filter((F.col("old").isNotNull() & ~was) | (F.col("new").isNotNull() & ~now))
        differing = folders.select(F.col("node").alias("parent"))
        going, depth = not folders.isEmpty(), depth + 1
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    out = materialise(out)
    discard(spark, scratch)
    return out
