"""Quality rules that vote or abstain, weighed by weak supervision, with DataFrame functions only.

Each rule looks at counts of a text's structure and votes good (1), bad (0) or abstains (null). No labels are used:
expectation-maximisation on how rules agree estimates how often each rule's votes are right, and the share of good
texts; a text's verdict is the posterior probability of being good. Abstaining says nothing about a text.

A text matters to the estimation only through its pattern of votes, so all documents are folded to one row per
pattern first: 3 to the number of rules at most, whatever the input. The iterations run on that stored table,
and only their few sums reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.texts import WORD_SEPARATOR_PATTERN, documents, settle, word_array

#: Fixed values of the base rules.
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = r"[^#*$%&|<>]+"

ROUNDS = 12
#: Before any text is seen: how often a rule's vote is right, and how many votes that belief weighs, as a part of the corpus.
PRIOR_ACCURACY, PRIOR_WEIGHT = 0.9, 0.01
#: A rule is held to be better than chance, and never to be infallible.
LEAST_ACCURACY, MOST_ACCURACY = 0.55, 0.995


def _windows(hashes: Column) -> Column:
    """Hashes of all windows over an array of word hashes."""
    last = F.size(hashes) - WINDOW
    windows = F.transform(
        F.sequence(F.lit(1), last + 1),
        lambda i: F.xxhash64(*[F.element_at(hashes, (i + k).cast("int")) for k in range(WINDOW)]),
    )
    return F.when(last < 1, F.array().cast("array<bigint>")).otherwise(windows)


def structure_counts(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``n_lines``.

    Words are maximal runs of other characters than ASCII white space. A null text has no words.
    """
    text = F.col("text")
    rows = documents(docs).select(
        "doc_id",
        word_array(text).alias("_words"),
        F.length(F.regexp_replace(text, WORD_SEPARATOR_PATTERN, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    rows = rows.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    # Steps are columns of their own: an array expression written inside a lambda would be made anew for each element.
    rows = rows.withColumn("_windows", _windows(F.col("_hashes")))
    # Texts without an equal pair of windows, nearly all, are done after counting distinct ones. In the others
    # equal windows become neighbours by sorting, and the places of repeated ones are walked through in order.
    sorted_places = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    doubled = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn("_sorted", F.when(doubled, sorted_places))
    rows = rows.withColumn("_order", F.transform("_sorted", lambda x: x["h"]))
    none, n = F.array(F.lit(None).cast("long")), F.size("_order")
    # A window is repeated if it equals its neighbour in sorted order on either side.
    beside = F.transform(
        F.arrays_zip(
            F.col("_sorted").alias("s"),
            F.concat(none, F.slice("_order", 1, n - 1)).alias("b"),
            F.concat(F.slice("_order", 2, n), none).alias("a"),
        ),
        lambda x: F.when((x["s"]["h"] == x["b"]) | (x["s"]["h"] == x["a"]), x["s"]["i"]),
    )
    rows = rows.withColumn("_places", F.array_sort(F.filter(beside, lambda i: i.isNotNull())))
    steps = F.zip_with(
        F.slice("_places", 2, F.size("_places")),
        F.slice("_places", 1, F.greatest(F.size("_places") - 1, F.lit(0))),
        lambda later, earlier: F.least(later - earlier, F.lit(WINDOW)),
    )
    covered = F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.when(F.size("_places") > 0, covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, F.lit(1)).when(bad, F.lit(0)).cast("int")


def rule_votes() -> dict[str, Column]:
    """The rules, over the columns of :func:`structure_counts`.

    Most can only find fault: that a text is long enough, say, is no reason to call it good, so they abstain.
    """
    words, symbols, never = F.col("n_words"), F.col("n_symbols"), F.lit(False)
    mean_chars = F.try_divide(F.col("word_chars"), words)
    dup_share = F.try_divide(F.col("n_dup_lines"), F.col("n_lines"))
    repeat_share = F.try_divide(F.col("n_repeat_words"), words)
    return {
        "length": _vote(never, words < LEAST_WORDS),
        "symbols": _vote(symbols * 100 <= words, symbols * 5 > words),
        "word_length": _vote(never, (mean_chars < 1.5) | (mean_chars > 25)),
        "lines": _vote(never, dup_share > 0.3),
        "repetition": _vote(never, repeat_share > MOST_REPEATED_PERCENT / 100),
    }


@dataclass(frozen=True)
class VoteModel:
    """Share of good texts, and the probability that a vote of each rule is right."""

    share: float
    accuracy: dict[str, float]

    def posterior(self) -> Column:
        """Probability of a good text given the vote columns; the share where every rule abstains."""

        def likelihood(share: float, said: int) -> Column:
            factors = [
                F.when(F.col(n) == said, p).when(F.col(n) == 1 - said, 1 - p).otherwise(1.0) for n, p in self.accuracy.items()
            ]
            return reduce(lambda a, b: a * b, factors, F.lit(share))

        good, bad = likelihood(self.share, 1), likelihood(1 - self.share, 0)
        return good / (good + bad)


def fit_votes(patterns: DataFrame, rules: list[str]) -> VoteModel:
    """Expectation-maximisation over a stored table of vote patterns with their number ``n``.

    It starts from the prior accuracies and four good texts of five; an empty table gives that start back.
    """
    model = VoteModel(0.8, dict.fromkeys(rules, PRIOR_ACCURACY))
    for _ in range(ROUNDS):
        n, p = F.col("n"), F.col("_p")
        sums = [F.sum("n").alias("total"), F.sum(n * p).alias("good")]
        for rule in rules:
            right = F.when(F.col(rule) == 1, p).when(F.col(rule) == 0, 1 - p)
            sums += [F.sum(n * right).alias(f"{rule}_right"), F.sum(F.when(F.col(rule).isNotNull(), n)).alias(f"{rule}_votes")]
        found = patterns.withColumn("_p", model.posterior()).agg(*sums).first()
        total = found["total"]
        if not total:
            return model
        weight = PRIOR_WEIGHT * total
        accuracy = {
            r: ((found[f"{r}_right"] or 0.0) + weight * PRIOR_ACCURACY) / ((found[f"{r}_votes"] or 0) + weight) for r in rules
        }
        model = VoteModel(
            min(0.999, max(0.001, found["good"] / total)),
            {r: min(MOST_ACCURACY, max(LEAST_ACCURACY, a)) for r, a in accuracy.items()},
        )
    return model


def judge(docs: DataFrame) -> DataFrame:
    """One row per input row: the counts of :func:`structure_counts`, ``base_failed``, ``posterior`` and ``kept``.

    ``kept`` is false for texts that fail the base rules and else whether the posterior is at least one half. Null and empty
    texts have no words and fail. Repeated rows and ties are judged alike; null ids come back as null; an empty table gives an
    empty result. Texts may be of any length.
    """
    rules = rule_votes()
    votes = structure_counts(docs).withColumns(rules)
    votes = settle(votes, "votes")
    patterns = settle(votes.groupBy(*rules).agg(F.count(F.lit(1)).alias("n")), "vote-patterns")
    model = fit_votes(patterns, list(rules))
    judged = votes.withColumns({"base_failed": base_failed(), "posterior": model.posterior()})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)).drop(*rules, "n_lines")
