"""Sources: landed pages and stored corpora. All paths are any that Spark's readers open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a landed page.
PAGE_SCHEMA = "stream string, user_id string, page int, count int, http_status int, content_type string, body string, seq long"
TIMELINES = ("posts", "articles")


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet", streams: list[str] | None = None, max_page: int | None = None) -> DataFrame:
    """Landed pages; stream and page limits reach the scan as pushed filters."""
    reader = spark.read.schema(PAGE_SCHEMA)
    pages = reader.json(path, mode="FAILFAST") if fmt == "json" else reader.format(fmt).load(path)
    if streams is not None:
        pages = pages.filter(F.col("stream").isin(*streams))
    return pages if max_page is None else pages.filter(F.col("page") <= max_page)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of its own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_json_strict(spark: SparkSession, path: str, schema: str, unique: str | None = None) -> DataFrame:
    """A stored JSON array or JSON lines: a missing path is empty, a corrupt one fails, never passes as empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    # Lines are told by the first one: a whole object. Else the file is one array or object, over whatever lines.
    first = spark.read.text(path).filter(F.trim("value") != "").select(F.trim("value").startswith("{") & F.try_parse_json("value").isNotNull()).limit(1).collect()
    rows = spark.read.schema(schema).json(path, multiLine=not (first and first[0][0]), mode="FAILFAST")
    if unique:
        from quillfeed.operators.merge import require_unique

        require_unique(rows, unique)
    return rows


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files as bytes, for snapshot digests."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def union_streams(*streams: DataFrame) -> DataFrame:
    """Timelines under one schema, each row once per stream it came from."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out
