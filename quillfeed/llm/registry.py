"""The registered queries of this subpackage, over whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed.functions.binding import let
from quillfeed.llm import decontaminate, importance, language, licenses, neardup, neighbours, oracles, packing, quality, repeats, sharding, tokencount, toxicity, urls
from quillfeed.session import read_table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def held_out(modulus: int, remainder: int):
    """Whether a row is held out of learning; a null id never is, but is not learned from either."""
    return F.coalesce(~language.train_rows(F.col("doc_id"), modulus, remainder), F.lit(False)).alias("held_out")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language.train(docs.filter(language.train_rows(F.col("doc_id"), 3, 1)))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(3, 1), "lang_pred", "score"
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents")).drop("notices")


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), words=4)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Fitted on labelled rows that are not held out."""
    learn = language.train_rows(F.col("doc_id"), 5, 0)
    labels = read_table(spark, sf_dir, "labels").filter(learn).select("doc_id", "toxic")
    return toxicity.train(docs, labels)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        held_out(5, 0),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules mined from the pages that a stated rule judges, and from all pages by stated words, judge those without a stated rule."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = urls.all_rules(urls.split_urls(pages), sides=urls.stated_sides(F.col("host"), F.col("path")))
    return urls.judge(pages, rules).drop("mined_rule", "confidence")


def with_repeats(df: DataFrame) -> DataFrame:
    """Documents of which a tenth, by a checksum of their id, end in a repeated stretch of their own words.

    With g from the checksum, the words from place g % n on repeat their first 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        tail = F.transform(F.sequence(F.lit(0), n - a - 1), lambda k: F.get(words, a + k % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, 1, a), tail), " ")).otherwise("")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return df.select("doc_id", F.when(h % 10 == 0, let(words, repeated)).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.periodic_runs(with_repeats(read_table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = repeats.greatest(F.col("runs"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[k].alias(k) for k in ("start", "length", "period")),
        F.floor(F.lit(1000) * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.documents.select("doc_id", "n_features", "weight", "score", "rank")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_quality": op2_quality,
    "op3_decontamination": op3_decontamination,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_nearest": op6_nearest,
    "op7_license_scan": op7_license_scan,
    "op8_neardup": op8_neardup,
    "op9_toxicity": op9_toxicity,
    "op10_url_filter": op10_url_filter,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_importance": op12_importance,
    "op13_token_counts": op13_token_counts,
}
ORACLES: dict[str, str] = {"op8_neardup": oracles.NEARDUP, "op11_periodic_runs": oracles.REPEATS, "op12_importance": oracles.IMPORTANCE}
