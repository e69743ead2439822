"""URL filter by the ratio of two character language models.

Models of the accepted and of the rejected URLs give each character its probability after up
to ORDER characters. Orders are interpolated with weights from the number of different
characters seen after a context (Witten-Bell), down to a uniform one. The mean
log-likelihood difference of a URL's characters is its score, and the threshold between the
classes is calibrated on labelled URLs that the models have not seen. Rules that fit a URL
decide it and label the URLs the models learn from. Rules see host and path; the models learn
from and score the whole URL, with its scheme, query and fragment, as it is written.

Counts, models and scores are DataFrames: the models grow with the corpus, so they are joined
by n-gram and not sent to every executor.

Defined cases: a URL that is null or has no :// has an empty host and path and no rule; a null
URL is judged as an empty one; without URLs of both labels, seen and held out, the method allows;
repeated rows have a row each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import table
from siltstone.sources.staging import stage

ORDER = 4
SYMBOLS = 256
HELD_OUT = 5  # one labelled URL in so many calibrates the threshold
GRID = 200


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """pages with host, path, and the rule that fits and its verdict or null."""
    rows = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):  # the longest last, over the others
        fits = (F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")
        fits &= F.col("path").startswith(rule.path)
        name = F.when(fits, rule.host + rule.path).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return rows.withColumns({"rule": name, "_ruled": verdict})


def _grams(texts: DataFrame) -> DataFrame:
    """texts with a row for every character: the ORDER characters before it and itself.

    The text's start is padded and its end is a character too.
    """
    padded = F.concat(
        F.array(*[F.lit("^")] * ORDER), F.regexp_extract_all("_text", F.lit("(?s)."), F.lit(0)), F.array(F.lit("$"))
    )
    rows = texts.withColumn("_chars", padded)
    at = F.explode(F.expr(f"sequence(1, size(_chars) - {ORDER})"))
    rows = rows.withColumn("_at", at)
    gram = F.array_join(F.slice("_chars", F.col("_at"), F.lit(ORDER + 1)), "")
    return rows.withColumn("_gram", gram).drop("_chars", "_at")


def _ratios(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """For every n-gram the log-likelihood difference of its last character.

    counts: _gram, _n_allow and _n_block; lower orders are sums over it.
    """
    classes = ("allow", "block")
    rows = grams
    for c in classes:
        rows = rows.withColumn(f"_p_{c}", F.lit(1.0 / SYMBOLS))
    for order in range(ORDER + 1):
        suffix = F.substring("_gram", ORDER + 1 - order, order + 1)
        context = F.substring("_gram", ORDER + 1 - order, order)
        of_order = counts.groupBy(suffix.alias("_s")).agg(*(F.sum(f"_n_{c}").alias(f"_n_{c}") for c in classes))
        rows = rows.withColumns({"_s": suffix, "_c": context}).join(of_order, "_s", "left")
        sums = [F.sum(f"_n_{c}").alias(f"_all_{c}") for c in classes] + [
            F.count_if(F.col(f"_n_{c}") > 0).alias(f"_kinds_{c}") for c in classes
        ]
        if order == 0:
            one = of_order.agg(*sums).first().asDict()
            rows = rows.withColumns({k: F.lit(v or 0) for k, v in one.items()})
        else:
            rows = rows.join(of_order.groupBy(F.substring("_s", 1, order).alias("_c")).agg(*sums), "_c", "left")
        for c in classes:
            seen, every, kinds = (F.coalesce(F.col(f"_{n}_{c}"), F.lit(0)) for n in ("n", "all", "kinds"))
            mixed = (seen + kinds * F.col(f"_p_{c}")) / (every + kinds)
            rows = rows.withColumn(f"_p_{c}", F.when(every > 0, mixed).otherwise(F.col(f"_p_{c}")))
        rows = rows.select("_gram", *(f"_p_{c}" for c in classes))
    return rows.select("_gram", (F.log("_p_allow") - F.log("_p_block")).alias("_ratio"))


def _threshold(scores: DataFrame) -> float | None:
    """Score that best parts the held-out classes, the mean of both error rates being least."""
    at = [k / GRID for k in range(GRID + 1)]
    found = scores.groupBy("_label").agg(F.percentile_approx("score", at, 10_000).alias("q")).collect()  # two rows
    quantiles = {r["_label"]: np.array(r["q"]) for r in found}
    if len(quantiles) < 2:
        return None
    levels = np.unique(np.concatenate(list(quantiles.values())))
    cuts = np.concatenate(([levels[0]], (levels[1:] + levels[:-1]) / 2))
    lost = np.searchsorted(quantiles["allow"], cuts) / (GRID + 1)
    let_in = 1 - np.searchsorted(quantiles["block"], cuts) / (GRID + 1)
    best = np.flatnonzero(lost + let_in == (lost + let_in).min())
    return float(cuts[best[len(best) // 2]])


def scored(rows: DataFrame) -> tuple[DataFrame, float | None]:
    """_text and score of every different URL text, and the threshold.

    rows: _text and _label, the verdict of a rule or null. A text of both labels counts for
    its rows' most frequent one; rows of the same text count each in the models.
    """
    texts = rows.groupBy("_text").agg(
        F.count_if(F.col("_label") == "allow").alias("_allow"), F.count_if(F.col("_label") == "block").alias("_block")
    )
    held = F.pmod(F.xxhash64(F.lit("held"), "_text"), F.lit(HELD_OUT)) == 0
    more = F.when(F.col("_allow") >= F.col("_block"), "allow").otherwise("block")
    label = F.when(F.col("_allow") + F.col("_block") > 0, more)
    texts = stage(texts.withColumns({"_label": label, "_held": held}), "texts").df
    grams = _grams(texts)
    learned = F.when(F.col("_held"), 0)
    counts = grams.groupBy("_gram").agg(
        F.sum(learned.otherwise(F.col("_allow"))).alias("_n_allow"),
        F.sum(learned.otherwise(F.col("_block"))).alias("_n_block"),
    )
    counts = stage(counts, "counts").df
    ratios = _ratios(counts.where("_n_allow + _n_block > 0"), counts.select("_gram"))
    scores = grams.select("_text", "_label", "_held", "_gram").join(ratios, "_gram")
    scores = scores.groupBy("_text", "_label", "_held").agg(F.avg("_ratio").alias("score"))
    scores = stage(scores, "scores").df
    learnable = counts.agg(F.sum("_n_allow"), F.sum("_n_block")).first()
    threshold = _threshold(scores.where("_held AND _label IS NOT NULL")) if all(learnable) else None
    return scores.select("_text", "score"), threshold


def judged(pages: DataFrame, keep: tuple[str, ...] = ("page_id",), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The kept columns with host, path, rule, verdict and score."""
    rows = with_rule(pages.select(*keep, "url"), rules).withColumn("_text", F.coalesce("url", F.lit("")))
    scores, threshold = scored(rows.select("_text", F.col("_ruled").alias("_label")))
    own = F.lit("allow") if threshold is None else F.when(F.col("score") >= threshold, "allow").otherwise("block")
    rows = rows.join(scores, "_text").withColumn("verdict", F.coalesce("_ruled", own))
    return rows.select(*keep, "host", "path", "rule", "verdict", "score")


def op7_url_language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return judged(table(spark, sf_dir, "pages").select("page_id", "url"))
