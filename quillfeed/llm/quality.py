"""Quality by hierarchical empirical Bayes.

A document classifier (ridge logistic regression on JVM-side text statistics) gives each document evidence. Evidence
is summed in grouped aggregations by host, by the host's sections (first segments of the path) and by whole paths. Each
level's posterior is shrunk towards the level above, the hosts' towards the global mean, with a weight that the spread
between siblings sets; a level whose parent has no other child says nothing of its own and is passed over. A document's
log-odds are its own evidence plus what its site says beyond the global mean; its own evidence is first taken out of
its site's sums, so that it counts once.

Sites are written `host/path/...`, of any depth; a site without a slash is a host with the empty path.

Cases: a null site is the site of the empty host; null and empty texts have all statistics 0; very long texts are
whole; sites with few documents stay near the level above, and one that has no other document is at its level; repeated
rows are scored one by one; without labels of both kinds all evidence is 0; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.llm.skew import join_dealt
from quillfeed.session import materialise

#: Labelled rows of a class that the fit takes at most: a uniform sample by hash of the id, the fit's stated bound.
ROWS_OF_A_CLASS = 4_000
#: Evidence of one document stays within these log-odds.
MAX_EVIDENCE = 8.0
#: Sites up to which their posteriors are broadcast; beyond it, the join shuffles and deals hot sites.
BROADCAST_SITES = 200_000
KEEP_FROM = 0.5


def statistics(text: Column) -> dict[str, Column]:
    """Text statistics as expressions; shares are of characters, words or lines."""
    t = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.filter(F.split(F.lower(t), r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x != "")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")
    return {
        "letters": F.length(F.regexp_replace(t, r"[^\p{L}]+", "")) / chars,
        "capitals": F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")) / chars,
        "digits": F.length(F.regexp_replace(t, r"[^\p{N}]+", "")) / chars,
        "marks": F.length(F.regexp_replace(t, r"[\p{L}\p{N}\s.,;:'!?-]+", "")) / chars,
        "exclaims": F.length(F.regexp_replace(t, r"[^!?]+", "")) / chars,
        "distinct_words": F.size(F.array_distinct(words)) / F.sqrt(n_words) / 10.0,
        "distinct_share": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "size": F.log1p(n_words) / 10.0,
        "word_length": F.least(chars / n_words, F.lit(30.0)) / 10.0,
    }


def _fit(labelled: DataFrame, names: list[str], label_col: str, id_col: str) -> tuple[float, list[float]]:
    rows = labelled.filter(F.col(label_col).isin(0, 1))
    per = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}
    if len(per) < 2:
        return 0.0, [0.0] * len(names)
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("quality")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col(label_col) == 1, min(1.0, ROWS_OF_A_CLASS / per[1])).otherwise(min(1.0, ROWS_OF_A_CLASS / per[0]))
    got = rows.filter(draw < share).select(*names, F.col(label_col).alias("y")).collect()  # two classes of ROWS_OF_A_CLASS rows
    y = np.array([r["y"] for r in got], dtype=float)
    if len(set(y)) < 2:
        return 0.0, [0.0] * len(names)
    x = np.array([[r[n] for n in names] for r in got], dtype=float)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - mean) / spread
    full = np.hstack([np.ones((len(z), 1)), z, z**2])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))  # evidence, not prior
    w = np.zeros(full.shape[1])
    shrink = np.full(len(w), 1.0)
    shrink[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        step = np.linalg.solve((full * (weight * p * (1 - p) + 1e-9)[:, None]).T @ full + np.diag(shrink), full.T @ (weight * (p - y)) + shrink * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), [(float(m), float(s), float(a), float(b)) for m, s, a, b in zip(mean, spread, w[1 : 1 + len(names)], w[1 + len(names) :], strict=True)]


def _strength(groups: DataFrame, default: float = 20.0) -> float:
    """Method of moments: how many documents the level above is worth, from the spread of rates (good / n) around it (m)."""
    wide = groups.filter("n >= 2").select("n", (F.col("good") / F.col("n")).alias("r"), "m").agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * (F.col("r") - F.col("m")) ** 2).alias("between"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("within"), F.sum("n").alias("n"),
    ).first()
    if not wide["k"] or wide["k"] < 2 or not wide["within"]:
        return default
    variance = max(1e-9, (wide["between"] - wide["within"]) / wide["n"])
    return float(min(1e4, max(1.0, (wide["within"] / wide["k"]) / variance)))


#: Levels of a site, from the top: each is a level's name and the columns that name a group of it.
LEVELS = (("host", ["host"]), ("section", ["host", "section"]), ("path", ["host", "section", "path"]))


def posteriors(scored: DataFrame) -> tuple[DataFrame, float, list[float]]:
    """Sums of each whole path and of the levels above it, the global mean, and each level's strength.

    scored has host, section, path and p. For each level there are n_<level>, good_<level> and rate_<level>, and
    own_<level>: whether its parent has other children; else its rate is its parent's.
    """
    sums = scored.groupBy("host", "section", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("good"))
    table = materialise(sums)
    total = table.agg(F.sum("n"), F.sum("good")).first()
    overall = min(0.999, max(0.001, (total[1] or 0.0) / (total[0] or 1)))
    above, strengths = None, []
    for k, (name, keys) in enumerate(LEVELS):
        groups = table.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        parent = keys[:-1]
        if above is None:
            siblings = groups.limit(2).count()
            groups = groups.withColumn("m", F.lit(overall)).withColumn("own", F.lit(siblings > 1))
        else:
            children = groups.groupBy(*parent).agg((F.count(F.lit(1)) > 1).alias("own"))
            groups = join_dealt(groups, above.join(children, parent).withColumn("m", F.col(f"rate_{LEVELS[k - 1][0]}")), parent, keys[-1])
        groups = materialise(groups)
        strengths.append(_strength(groups.filter("own")))
        rate = (F.col("good") + F.col("m") * F.lit(strengths[-1])) / (F.col("n") + F.lit(strengths[-1]))
        above = groups.withColumn(f"rate_{name}", F.when(F.col("own"), rate).otherwise(F.col("m"))).drop("m")
        above = above.withColumnsRenamed({"n": f"n_{name}", "good": f"good_{name}", "own": f"own_{name}"})
    return materialise(above), overall, strengths


def without_own(overall: float, strengths: list[float]) -> Column:
    """A site's posterior without the evidence p of the document that asks, level by level."""
    rate = F.lit(overall)
    for (name, _), strength in zip(LEVELS, strengths, strict=True):
        rest = (F.col(f"good_{name}") - F.col("p") + rate * F.lit(strength)) / (F.col(f"n_{name}") - 1 + F.lit(strength))
        rate = F.when(F.col(f"own_{name}"), rest).otherwise(rate)
    return F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), rate))


def classify(
    docs: DataFrame, labelled_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", label_col: str = "quality"
) -> DataFrame:
    """One row for each document: doc_id, host, path, evidence, site_rate, score (0 to 1) and kept."""
    stats = statistics(F.col("__text"))
    site = F.split(F.coalesce(F.col(site_col), F.lit("")), "/")
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"), site[0].alias("host"), F.coalesce(F.get(site, F.lit(1)), F.lit("")).alias("section"),
        F.array_join(F.slice(site, F.lit(2), F.greatest(F.size(site) - 1, F.lit(0))), "/").alias("path"),
    )
    measured = materialise(base.select("doc_id", "host", "section", "path", *(c.alias(n) for n, c in stats.items())))
    labels = labelled_ids.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("__label"))
    bias, slopes = _fit(measured.join(labels, "doc_id"), [*stats], "__label", "doc_id")
    evidence = F.lit(bias)
    for name, s in zip(stats, slopes, strict=True):
        if s:
            z = (F.col(name) - F.lit(s[0])) / F.lit(s[1])
            evidence = evidence + z * F.lit(s[2]) + z * z * F.lit(s[3])
    bounded = F.greatest(F.lit(-MAX_EVIDENCE), F.least(F.lit(MAX_EVIDENCE), evidence))
    scored = measured.select("doc_id", "host", "section", "path", bounded.alias("evidence")).withColumn("p", 1 / (1 + F.exp(-F.col("evidence"))))
    sites, overall, strengths = posteriors(scored)
    keys = ["host", "section", "path"]
    few = sites.count() <= BROADCAST_SITES
    joined = scored.join(F.broadcast(sites), keys) if few else join_dealt(scored, sites, keys, "doc_id")
    joined = joined.withColumn("site_rate", without_own(overall, strengths))
    beyond = F.log(F.col("site_rate") / (1 - F.col("site_rate"))) - F.lit(float(np.log(overall / (1 - overall))))
    score = 1 / (1 + F.exp(-(F.col("evidence") + beyond)))
    return joined.select("doc_id", "host", "path", "evidence", "site_rate", score.alias("score"), (score >= KEEP_FROM).alias("kept"))
