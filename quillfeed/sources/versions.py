"""A store of streams that change together: each commit writes new folders and then names them in one numbered file.

Folders that a commit names are never written again. A commit is one rename of a small file to the next number, so
readers see all streams as before or all as after it, and a run that stops anywhere leaves the last commit whole;
what it wrote without naming it goes with the next commit. Folders of the commit before stay for readers that still
hold them. One writer at a time; any number of readers. Only folders that the store itself has named are ever deleted;
whatever else lies in its base folder stays.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOG = "_commits"
#: Names of the folders that the store writes.
_OWN = re.compile(r"v-[0-9a-f]{32}\Z")
#: Names in a commit that begin with this are notes, not streams.
_NOTE = "_"


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def _commits(spark: SparkSession, base: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{base}/{_LOG}") if n.removesuffix(".json").isdigit())


def _read_commit(spark: SparkSession, base: str, number: int) -> dict[str, str]:
    fs, target = _at(spark, f"{base}/{_LOG}/{number:020}.json")
    stream = fs.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, base: str) -> dict[str, str]:
    """The folder of each stream by the last commit; empty before the first."""
    return {k: v for k, v in _last(spark, base).items() if not k.startswith(_NOTE)}


def notes(spark: SparkSession, base: str) -> dict[str, str]:
    """What the last commit notes about the store beside its streams."""
    return {k.removeprefix(_NOTE): v for k, v in _last(spark, base).items() if k.startswith(_NOTE)}


def _last(spark: SparkSession, base: str) -> dict[str, str]:
    numbers = _commits(spark, base)
    return _read_commit(spark, base, numbers[-1]) if numbers else {}


def commit(spark: SparkSession, base: str, changed: dict[str, str], removed: tuple[str, ...] = (), noted: dict[str, str] | None = None) -> None:
    """Names the changed streams' folders (relative to `base`) beside those of all other streams, in one step, with notes."""
    numbers = _commits(spark, base)
    before = _read_commit(spark, base, numbers[-1]) if numbers else {}
    after = {k: v for k, v in before.items() if k not in removed} | changed | {_NOTE + k: v for k, v in (noted or {}).items()}
    number = numbers[-1] + 1 if numbers else 0
    fs, draft = _at(spark, f"{base}/{_LOG}/.draft-{uuid.uuid4().hex}")
    fs.mkdirs(draft.getParent())
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(after, sort_keys=True).encode()))
    stream.close()
    _, final = _at(spark, f"{base}/{_LOG}/{number:020}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        raise OSError(f"another writer has made commit {number} of {base}")
    _clean(spark, base, {*before.values(), *after.values()}, number)


def _clean(spark: SparkSession, base: str, kept: set[str], number: int) -> None:
    """Deletes the store's own folders that neither the last commit nor the one before names, and older commits."""
    fs, _ = _at(spark, base)
    roots = {k.split("/")[0] for k in kept}
    for name in _names(spark, base):
        if not _OWN.match(name):
            continue
        if name not in roots:
            fs.delete(_at(spark, f"{base}/{name}")[1], True)
            continue
        parts = {k for k in kept if k.startswith(name + "/")}
        for inner in _names(spark, f"{base}/{name}") if parts else []:
            if f"{name}/{inner}" not in parts:
                fs.delete(_at(spark, f"{base}/{name}/{inner}")[1], True)
    for name in _names(spark, f"{base}/{_LOG}"):
        old = name.removesuffix(".json")
        if (old.isdigit() and int(old) < number - 1) or name.startswith(".draft-"):
            fs.delete(_at(spark, f"{base}/{_LOG}/{name}")[1], True)


def write_version(df: DataFrame, base: str, fmt: str = "parquet", partition: str | None = None) -> str:
    """Writes a frame to a folder of its own, which no reader sees before a commit names it; the folder's name."""
    name = f"v-{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    (writer.partitionBy(partition) if partition else writer).save(f"{base}/{name}")
    return name


def partitions(spark: SparkSession, base: str, folder: str, partition: str) -> dict[str, str]:
    """The values of the partition column in a written folder, and the folder of each."""
    return {n.removeprefix(f"{partition}="): f"{folder}/{n}" for n in _names(spark, f"{base}/{folder}") if n.startswith(f"{partition}=")}


def publish(spark: SparkSession, base: str, streams: dict[str, DataFrame], fmt: str = "parquet") -> None:
    """Writes all streams, then names them in one commit; if any fails, none is changed."""
    commit(spark, base, {name: write_version(df, base, fmt) for name, df in streams.items()})


def read(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame | None:
    """A stream by the last commit, or None."""
    folder = current(spark, base).get(name)
    return None if folder is None else spark.read.format(fmt).load(f"{base}/{folder}")
