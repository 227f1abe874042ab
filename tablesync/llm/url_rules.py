"""URL filters: fixed rules, and association rules mined from URLs whose verdict is known.

A URL's tokens are its scheme, host labels, path segments, file ending and query names. Spark's
FP-growth mines the token sets that are frequent among labelled URLs, with the label as one more
token; sets that hold a label give rules "these tokens, so this label". Rules below a support or
confidence are pruned, and so is a rule that is as sure without one of its tokens. Rules are
matched by an inverted index: each is listed under its rarest token, a URL looks up its tokens,
and a rule fires if all its tokens are there. A URL is blocked if a block rule fires.

A fixed rule fits a host and its subdomains where the path starts with the rule's path; the
longest wins, and it goes before what is mined.

All work is DataFrame functions and Spark's own FP-growth. URLs are matched once per distinct
token set, so a host with a third of all rows is a few rows there. Null URLs and URLs without
"://" have an empty host and path and no tokens; they are allowed. Repeated rows are judged
each. Without labelled URLs nothing is mined and everything else is allowed. Other columns are
kept by `judged`; one that is named like a result gives way to it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tablesync.catalog import quote
from tablesync.llm.common import settled

#: Share of the labelled URLs, and of those with a rule's tokens, from which a rule counts.
#: Both are shares, so a table and its copies give the same rules.
SUPPORT, CONFIDENCE = 0.05, 0.9
#: Different labelled URLs that a rule must rest on.
LEAST_URLS = 3
#: How much surer than the label's own share a rule must be.
LIFT = 1.1

RESULTS = ("host", "path", "rule", "verdict", "mined")
_LABEL = "="
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: str = "url") -> dict[str, Column]:
    """host (A-Z in lower case) and path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return {
        "host": F.translate(F.regexp_extract(text, pattern, 1), _UPPER, _LOWER),
        "path": F.regexp_extract(text, pattern, 2),
    }


def fixed(rules: list[tuple[str, str, str]]) -> dict[str, Column]:
    """rule and rule_verdict of the longest of `rules` (host, path, verdict) that fits host and path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, said).otherwise(verdict)
    return {"rule": rule, "rule_verdict": verdict}


def tokens(url: str = "url") -> Column:
    """The distinct tokens of a URL whose host and path are columns, sorted."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    named = lambda kind, values: F.transform(values, lambda x: F.concat(F.lit(kind), x))
    full = lambda values: F.filter(values, lambda x: x != "")
    sets = [
        named("scheme:", F.array(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?)://", 1)))),
        named("host:", full(F.split("host", r"\."))),
        named("path:", full(F.split(F.lower("path"), "/"))),
        named("end:", full(F.array(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)))),
        named("query:", full(F.transform(F.split(query, "&"), lambda x: F.regexp_replace(x, "=.*", "")))),
    ]
    return F.when(F.col("host") != "", F.array_sort(F.array_distinct(reduce(F.concat, sets)))).otherwise(
        F.array().cast("array<string>")
    )


def mined(labelled: DataFrame, *, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Rules (antecedent: tokens, label, confidence, anchor: the rarest token) from `labelled` (tokens, label)."""
    items = F.concat("tokens", F.array(F.concat(F.lit(_LABEL), "label")))
    rows = labelled.where("label is not null and size(tokens) > 0").select(items.alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(rows)
    sets = settled(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    # a set with a label, joined with the same set without it
    label = F.filter("items", lambda x: x.startswith(_LABEL))
    rest = F.filter("items", lambda x: ~x.startswith(_LABEL))
    with_label = sets.where(F.size(label) == 1).select(
        F.substr(label[0], F.lit(len(_LABEL) + 1)).alias("label"), rest.alias("antecedent"), F.col("freq").alias("both")
    )
    alone = sets.where(F.size(label) == 0).select(F.col("items").alias("antecedent"), "freq")
    shares = with_label.where("size(antecedent) = 0").select("label", F.col("both").alias("label_freq"))
    total = with_label.where("size(antecedent) = 0").agg(F.sum("both").alias("total"))
    rules = settled(
        with_label.where("size(antecedent) > 0")
        .join(alone, "antecedent")
        .withColumn("confidence", F.col("both") / F.col("freq"))
        .where((F.col("confidence") >= confidence) & (F.col("both") >= LEAST_URLS))
        .join(shares, "label")
        .withColumn("lift", F.col("confidence") / F.col("label_freq"))
        .select("antecedent", "label", "confidence", "freq", "lift")
    )
    n = total.first()[0] or 0
    rules = rules.where(F.col("lift") * n >= LIFT)
    # rules that give the same label as surely without one of their tokens
    number = F.xxhash64("antecedent", "label")
    shorter = F.transform("antecedent", lambda token: F.array_remove("antecedent", token))
    redundant = (
        rules.where("size(antecedent) > 1")
        .select(number.alias("id"), "label", "confidence", F.explode(shorter).alias("antecedent"))
        .join(rules.select("antecedent", "label", F.col("confidence").alias("sure")), ["antecedent", "label"])
        .where("sure >= confidence")
        .select("id")
        .distinct()
    )
    kept = rules.withColumn("id", number).join(redundant, "id", "left_anti")
    rarity = alone.where("size(antecedent) = 1").select(F.col("antecedent")[0].alias("token"), F.col("freq").alias("often"))
    anchors = (
        kept.select("id", F.explode("antecedent").alias("token"))
        .join(rarity, "token")
        .groupBy("id")
        .agg(F.min_by("token", F.struct("often", "token")).alias("anchor"))
    )
    return settled(kept.join(anchors, "id").select("antecedent", "label", "confidence", "anchor"))


def fired(sets: DataFrame, rules: DataFrame, label: str) -> DataFrame:
    """The distinct `tokens` of `sets` on which a rule for `label` fires."""
    index = rules.where(F.col("label") == label).select("anchor", "antecedent")
    posted = sets.select("tokens").distinct().select("tokens", F.explode("tokens").alias("anchor"))
    whole = F.size(F.array_except("antecedent", "tokens")) == 0
    return posted.join(index, "anchor").where(whole).select("tokens").distinct()


def judged(
    pages: DataFrame, rules: list[tuple[str, str, str]], *, support: float = SUPPORT, confidence: float = CONFIDENCE
) -> DataFrame:
    """The rows of `pages` (url) with host, path, rule, verdict and mined: whether a mined rule blocks the URL.

    The URLs that a fixed rule judges are the labelled ones, each counted once.
    """
    others = [F.col(f"page.{quote(c)}") for c in pages.columns if c.lower() not in RESULTS]
    rows = pages.select(F.struct(*[F.col(quote(c)) for c in pages.columns]).alias("page"), "url").withColumns(parts())
    rows = rows.withColumns(fixed(rules)).withColumn("tokens", tokens())
    labelled = rows.where("rule is not null").select("tokens", F.col("rule_verdict").alias("label"))
    labelled = labelled.distinct()  # a URL says no more if it is there more often
    found = mined(labelled, support=support, confidence=confidence)
    blocked = fired(rows.where("rule is null"), found, "block").withColumn("mined", F.lit(True))
    verdict = F.coalesce("rule_verdict", F.when(F.col("mined"), "block").otherwise("allow"))
    return (
        rows.join(blocked, "tokens", "left")
        .withColumn("mined", F.coalesce("mined", F.lit(False)) & F.col("rule").isNull())
        .withColumn("verdict", verdict)
        .select(*others, *RESULTS)
    )
