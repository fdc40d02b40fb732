"""Quality rules by weak supervision.

Rules look at counts of a text and vote good (+1), bad (-1) or abstain (0). The votes are a naive Bayes mixture of two
classes: rule j is right with probability a_j when it votes. Expectation-maximisation estimates the a_j from the votes
alone; the posterior probability of "good" replaces the demand that all rules pass.

EM sees only how many texts cast each combination of votes, at most 3^7 rows however large the input, so one pass over
the texts fits the model. Everything is an expression of Spark's: no Python touches a row.

Defined results: a NULL or empty text has no words and fails the base rule; a table without rows gives no rows and a
model that keeps its starting values; repeated rows vote once each; columns of other names pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.llm.common import free_name, let, stored, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ITERATIONS = 20
START_ACCURACY = 0.9
# Rules are taken to be better than chance and never certain; this also fixes which class is "good".
ACCURACY_RANGE = (0.55, 0.95)
# Probability of "good" before any vote. It is given: estimated along with the accuracies it would rise with the share
# of sound texts until no rule could reject one.
BALANCE = 0.5
THRESHOLD = 0.5

FEATURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_shouts",
]


def repeated_words(w: Column) -> Column:
    """Words that lie in windows of eight words found at least twice in the text."""
    hashes = F.when(
        F.size(w) >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        again = let(
            by_hash,
            lambda s: F.filter(
                s,
                lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                | ((i < F.size(s) - 1) & (F.get(s, i + 1)["h"] == x["h"])),
            ),
        )
        starts = F.sort_array(F.transform(again, lambda x: x["p"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")),
            lambda acc: acc["n"],
        )

    return let(hashes, lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0)).otherwise(covered(h)))


def features(text: Column) -> Column:
    """Struct of the counts that the rules look at; each regular expression runs once per text."""
    text = F.coalesce(text, F.lit(""))

    def kept(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    def counts(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
        return let(
            lines,
            lambda ls: F.struct(
                F.size(w).cast("long").alias("n_words"),
                kept(r"[\x20\x09-\x0D]+").cast("long").alias("word_chars"),
                kept(r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
                F.size(ls).cast("long").alias("n_lines"),
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                repeated_words(w).cast("long").alias("n_repeat_words"),
                kept(r"[^A-Z]+").cast("long").alias("n_upper"),
                kept(r"[^!]+").cast("long").alias("n_shouts"),
            ),
        )

    return let(words(text), counts)


def base_failed(f: Column) -> Column:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])


# Each rule gives two conditions on the counts, bad and good; it abstains where neither holds. A kind of junk trips two
# rules, so that one odd count of a sound text is outvoted.
RULES = {
    "shape": lambda f: (
        f["n_words"] < MIN_WORDS,
        (f["n_words"] >= 40) & (f["word_chars"] >= 3 * f["n_words"]) & (f["word_chars"] <= 10 * f["n_words"]),
    ),
    "symbols": lambda f: (10 * f["n_symbols"] > f["n_words"], F.lit(False)),
    "symbol_share": lambda f: (100 * f["n_symbols"] > 3 * f["word_chars"], F.lit(False)),
    "dup_lines": lambda f: (2 * f["n_dup_lines"] > f["n_lines"], F.lit(False)),
    "repeats": lambda f: (100 * f["n_repeat_words"] > 25 * f["n_words"], F.lit(False)),
    "capitals": lambda f: (10 * f["n_upper"] > 3 * f["word_chars"], F.lit(False)),
    "shouts": lambda f: (5 * f["n_shouts"] > f["n_words"], F.lit(False)),
}


def votes(f: Column) -> list[Column]:
    """One vote per rule over the struct of counts."""
    out = []
    for name, rule in RULES.items():
        bad, good = rule(f)
        out.append(F.when(bad, -1).when(good, 1).otherwise(0).alias(name))
    return out


@dataclass(frozen=True)
class Model:
    """Accuracy of each rule."""

    accuracies: tuple[float, ...]

    def posterior(self, cast: list[Column]) -> Column:
        """Probability of "good" given the votes."""
        odds = F.lit(math.log(BALANCE / (1 - BALANCE)))
        for vote, a in zip(cast, self.accuracies, strict=True):
            odds = odds + vote * F.lit(math.log(a / (1 - a)))
        return 1 / (1 + F.exp(-odds))


def patterns(counted: DataFrame, f: str) -> DataFrame:
    """Vote combinations with their number of texts: at most 3^rules rows."""
    return counted.select(*votes(F.col(f))).groupBy(*RULES).agg(F.count("*").alias("n"))


def fit(combinations: DataFrame, iterations: int = ITERATIONS) -> Model:
    """Expectation-maximisation over the vote combinations; each round is one aggregate of those few rows."""
    combinations = stored(combinations.coalesce(1), "vote-patterns")
    model = Model((START_ACCURACY,) * len(RULES))
    low, high = ACCURACY_RANGE
    for _ in range(iterations):
        q, n = F.col("q"), F.col("n")
        estimates = []
        for name in RULES:
            vote = F.col(name)
            right = F.sum(n * F.when(vote == 1, q).when(vote == -1, 1 - q))
            estimates.append((right / F.sum(F.when(vote != 0, n))).alias(name))
        row = combinations.withColumn("q", model.posterior([F.col(name) for name in RULES])).agg(*estimates).first()
        # A rule that never votes keeps its accuracy.
        kept = zip(RULES, model.accuracies, strict=True)
        model = Model(tuple(a if row[name] is None else round(min(max(row[name], low), high), 12) for name, a in kept))
    return model


def quality(f: Column, model: Model) -> Column:
    """Posterior probability of "good" from the struct of counts, to six digits."""
    return F.round(model.posterior(votes(f)), 6)


def keep_good(docs: DataFrame, text: str = "text", iterations: int = ITERATIONS) -> DataFrame:
    """The rows whose text passes; the same columns. The counts are taken once and stored with the rows."""
    name = free_name(docs, "counts")
    counted = stored(docs.withColumn(name, features(F.col(text))), "counted-texts")
    model = fit(patterns(counted, name), iterations)
    f = F.col(name)
    return counted.where(~base_failed(f) & (quality(f, model) >= THRESHOLD)).drop(name)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", iterations: int = ITERATIONS) -> DataFrame:
    """Per row: key, counts, ``base_failed``, ``good_probability`` and ``kept``."""
    counted = stored(docs.select(F.col(key).alias("key"), features(F.col(text)).alias("counts")), "rule-counts")
    model = fit(patterns(counted, "counts"), iterations)
    f = F.col("counts")
    out = counted.select(
        F.col("key").alias(key),
        *[f[n].alias(n) for n in FEATURES],
        base_failed(f).alias("base_failed"),
        quality(f, model).alias("good_probability"),
    )
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("good_probability") >= THRESHOLD))
