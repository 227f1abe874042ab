"""Quality rules as weak supervision.

Each rule votes good (1) or bad (-1) on a document, or abstains (0). Expectation-maximisation
over the counts of vote patterns estimates each rule's accuracy: the share of its votes that
agree with what a document is, given all votes on it. The posterior probability of good, from
even odds and the votes' log odds of being right, then takes the place of "all rules must
pass". A rule that others contradict loses its weight; one that is no better than chance has
none. An abstention says nothing.

All work is DataFrame functions. Patterns are at most 3 ** len(RULES) rows, however many
documents there are; each round of the estimation is one aggregate over them, and only its sums
reach the driver. Statistics of a document come from its own row, so nothing can be skewed.

Null and empty texts have no words: all counts are 0, and the base rules reject them. Repeated
rows are judged each, alike. An empty table gives no rows. Other columns of `docs` are ignored
by `measured` and kept by `kept_rows`.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, functions as F

from tablesync.llm.common import settled, words_of

SPAN = 8
ROUNDS = 25
#: Posterior probability of good from which a document is kept.
KEEP = 0.5
#: What every rule is taken for in the first round, and what none exceeds.
FIRST_ACCURACY, MOST_ACCURACY = 0.9, 0.999

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_capitals", "n_bangs", "n_stutters", "n_stops")

#: name: (bad if, good if), over the counts; neither: the rule abstains.
RULES = {
    "symbols": ("10 * n_symbols >= n_words", "false"),
    "capitals": ("10 * n_capitals >= 3 * word_chars", "false"),
    "bangs": ("10 * n_bangs >= 3 * n_words", "false"),
    "stutters": ("10 * n_stutters >= n_words", "false"),
    "repeats": ("5 * n_repeat_words >= n_words", "false"),
    "lines": ("3 * n_dup_lines >= n_lines and n_lines >= 4", "false"),
    "length": ("n_words < 20", "false"),
    "word_length": ("word_chars < 2 * n_words or word_chars > 15 * n_words", "false"),
    "plain": (
        "false",
        "n_words >= 20 and 50 * n_symbols <= n_words and 20 * n_capitals <= 3 * word_chars "
        "and 20 * n_bangs <= n_words and 50 * n_stutters <= n_words",
    ),
    "prose": ("200 * n_stops < n_words and n_words >= 100", "50 * n_stops >= n_words and 20 * n_symbols <= n_words "
        "and 20 * n_bangs <= n_words and 20 * n_stutters <= n_words"),
}


def _only(kept: str) -> Column:
    """How many characters of the text are in a class."""
    return F.length(F.regexp_replace("text", f"[^{kept}]+", ""))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each row of `docs` (doc_id, text)."""
    after = f"slice(%s, %d + 1, greatest(n_words, 1))"
    blank = "[^ \\\\t-\\\\r]"
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = own.select("doc_id", "text", words_of("text").alias("words"))
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _only("#*$%&|<>").cast("long").alias("n_symbols"),
        _only("\\p{Lu}").cast("long").alias("n_capitals"),
        _only("!").cast("long").alias("n_bangs"),
        _only(".?!").cast("long").alias("n_stops"),
        F.expr(f"filter(split(text, '\\n'), l -> l rlike '{blank}')").alias("lines"),
        F.expr("transform(words, w -> xxhash64(w))").alias("h1"),
    )
    rows = rows.withColumns(
        {
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_stutters": F.expr(
                f"size(filter(zip_with(h1, {after % ('h1', 1)}, (a, b) -> a = b), same -> same))"
            ).cast("long"),
            "h2": F.expr(f"zip_with(h1, {after % ('h1', 1)}, (a, b) -> xxhash64(a, b))"),
        }
    ).drop("lines", "h1")
    # spans of 8 words by doubling; the last seven would run over the end
    rows = rows.withColumn("h4", F.expr(f"zip_with(h2, {after % ('h2', 2)}, (a, b) -> xxhash64(a, b))")).drop("h2")
    spans = f"slice(zip_with(h4, {after % ('h4', 4)}, (a, b) -> xxhash64(a, b)), 1, greatest(n_words - {SPAN - 1}, 0))"
    rows = rows.withColumn("spans", F.expr(spans)).drop("h4")
    # only texts with a repeated span go further
    rows = rows.withColumn(
        "sorted",
        F.expr(
            "case when size(array_distinct(spans)) < size(spans) "
            "then sort_array(transform(spans, (x, i) -> struct(x as span, i as at))) end"
        ),
    ).drop("spans")
    rows = rows.withColumn(
        "at",
        F.expr(
            "sort_array(array_distinct(flatten(zip_with(sorted, slice(sorted, 2, greatest(n_words, 1)), "
            "(a, b) -> case when a.span = b.span then array(a.at, b.at) else array() end))))"
        ),
    ).drop("sorted")
    covered = (
        f"aggregate(zip_with(at, slice(at, 2, greatest(n_words, 1)), (a, b) -> least({SPAN}, coalesce(b - a, {SPAN}))), "
        "0L, (total, n) -> total + n)"
    )
    return rows.withColumn("n_repeat_words", F.coalesce(F.expr(covered), F.lit(0).cast("long"))).select(
        "doc_id", *_COUNTS, *_MORE
    )


def votes() -> dict[str, Column]:
    return {name: F.expr(f"case when {bad} then -1 when {good} then 1 else 0 end") for name, (bad, good) in RULES.items()}


class VoteModel:
    """How often each rule's votes are right."""

    def __init__(self, accuracy: dict[str, float]):
        self.accuracy = accuracy

    def posterior(self) -> Column:
        # an array literal keeps the numbers out of the generated code, which all rounds share
        weights = F.lit([log(a / (1 - a)) for a in self.accuracy.values()])
        odds = F.lit(0.0)
        for i, name in enumerate(self.accuracy):
            odds = odds + F.col(f"vote_{name}") * weights[i]
        return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, rounds: int = ROUNDS, tolerance: float = 1e-3) -> VoteModel:
    """Estimate the model from `patterns`: vote_* columns and the `n` documents that cast them."""
    model = VoteModel(dict.fromkeys(RULES, FIRST_ACCURACY))
    for _ in range(rounds):
        weighed = patterns.withColumn("good", model.posterior())
        sums = {}
        for rule in RULES:
            vote = F.col(f"vote_{rule}")
            right = F.when(vote == 1, F.col("good")).when(vote == -1, 1 - F.col("good"))
            sums[f"right {rule}"] = F.sum(F.col("n") * right)
            sums[f"cast {rule}"] = F.sum(F.col("n") * F.abs(vote))
        row = weighed.agg(*[column.alias(name) for name, column in sums.items()]).first()
        accuracy = {}
        for rule in RULES:
            right, cast = row[f"right {rule}"] or 0.0, row[f"cast {rule}"] or 0
            # ten votes of the first accuracy besides, so that rare votes aren't taken for certain
            share = (right + 10 * FIRST_ACCURACY) / (cast + 10)
            accuracy[rule] = min(max(share, 0.5), MOST_ACCURACY)
        before, model = model, VoteModel(accuracy)
        if all(abs(accuracy[rule] - before.accuracy[rule]) < tolerance for rule in RULES):
            break
    return model


def judged(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, the counts, base_failed, posterior and kept."""
    counts = settled(measured(docs))
    voted = counts.withColumns({f"vote_{name}": vote for name, vote in votes().items()})
    patterns = settled(voted.groupBy(*[f"vote_{r}" for r in RULES]).agg(F.count("*").alias("n")))
    model = fit(patterns)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return voted.withColumns({"base_failed": base_failed, "posterior": model.posterior()}).select(
        "doc_id",
        *_COUNTS,
        "base_failed",
        "posterior",
        (~F.col("base_failed") & (F.col("posterior") >= KEEP)).alias("kept"),
    )


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose documents are kept; of rows that share an id, those of a kept text."""
    key = F.struct("doc_id", F.xxhash64("text").alias("text"))
    rejected = judged(docs.select(key.alias("doc_id"), "text")).where("not kept").select(F.col("doc_id").alias("__key"))
    return docs.join(rejected.distinct(), key.eqNullSafe(F.col("__key")), "left_anti")
