"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (1) or bad (-1) or abstains (0) on a text. Nobody tells which
votes are right: expectation-maximisation over all texts estimates, for the good
and the bad class, how often each rule votes what, and a text's posterior
probability of being good decides instead of an all-must-pass filter.

Texts enter the estimate only through their vote pattern, so it runs over the
counts of patterns, at most 3**rules rows however large the input. Spark counts them
in one aggregate over all texts; those few rows come to the driver, and the rounds run there
until the estimate is at rest, some thousand rounds of a few hundred numbers. Votes
and measures are computed once and written to the shared folder.

The base rules, too few words and too much repetition, drop texts by themselves, so no rule that
votes says the same again.

Defined results: null or empty text has no words, all measures 0, fails the base
rule. Nulls elsewhere, repeated rows and repeated keys are judged row by row. Very
long texts are measured whole. Empty table: empty, and the model is its start.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm import columns as C

GOOD, BAD, ABSTAIN = 1, -1, 0

#: Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED_PCT = 50

#: The posterior from which a text is kept.
KEEP_FROM = 0.5

#: Expectation-maximisation is at rest when no probability changes by more in a round. The
#: rounds it may take, some hundred times what the slowest estimate seen here took, only guard
#: against one that never rests.
STILL = 1e-8
MOST_ROUNDS = 500_000

#: Weight of what is believed beforehand about every class, in texts, however many there are.
PRIOR_COUNT = 10.0

#: No kind of junk is believed to hold a larger share of all texts. This is what tells a
#: kind that only one rule sees from a rule that is often wrong on good texts, which votes
#: alone cannot: what goes beyond it is the rule's error, unless other rules speak up too.
KIND_MOST = 0.1


# ---- measures -----------------------------------------------------------------


def measures(df: DataFrame, text: str) -> DataFrame:
    """The frame with ``q_words``, ``q_word_chars``, ``q_symbols``, ``q_lines``,
    ``q_dup_lines``, ``q_repeat_words``, ``q_capitals`` and ``q_shouts`` (all long)."""
    content = F.coalesce(F.col(text), F.lit(""))
    w = F.col("q_w")
    window = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")
        ),
    )
    s = F.col("q_sorted")
    twice = F.filter(
        s,
        lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]),
    )
    at = F.col("q_at")
    covered = F.aggregate(
        at,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(i - a["last"], F.lit(3))).alias("n")
        ),
        lambda a: a["n"],
    )
    lines = F.filter(F.split(content, "\n", -1), lambda x: x.rlike(C.WORD))
    return (
        df.withColumn("q_w", C.words(text))
        .withColumn("q_words", F.size("q_w").cast("long"))
        .withColumn("q_word_chars", F.length(F.array_join("q_w", "")).cast("long"))
        .withColumn(
            "q_sorted",
            F.when(F.size("q_w") >= 3, F.sort_array(window)),
        )
        .withColumn("q_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
        .withColumn("q_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
        .drop("q_w", "q_sorted", "q_at")
        .withColumn("q_symbols", F.regexp_count(content, F.lit(r"[#*$%&|<>]")).cast("long"))
        .withColumn("q_capitals", F.regexp_count(content, F.lit(r"\p{Lu}")).cast("long"))
        .withColumn("q_shouts", F.regexp_count(content, F.lit("!")).cast("long"))
        .withColumn("q_l", lines)
        .withColumn("q_lines", F.size("q_l").cast("long"))
        .withColumn("q_dup_lines", (F.size("q_l") - F.size(F.array_distinct("q_l"))).cast("long"))
        .drop("q_l")
    )


def base_failed() -> Column:
    """Too few words, or too large a share of them in windows found twice."""
    return (F.col("q_words") < LEAST_WORDS) | (
        100 * F.col("q_repeat_words") > MOST_REPEATED_PCT * F.col("q_words")
    )


# ---- rules --------------------------------------------------------------------


def _vote(bad: Column, good: Column) -> Column:
    """An undefined ratio abstains."""
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def _per(a: str, b: str) -> Column:
    return F.try_divide(F.col(a).cast("double"), F.col(b))


def default_rules() -> dict[str, Column]:
    length, per_word = _per("q_word_chars", "q_words"), lambda c: _per(c, "q_words")
    return {
        "word_length": _vote((length < 2.5) | (length > 12), (length >= 3) & (length <= 9)),
        "symbols": _vote(per_word("q_symbols") > 0.1, per_word("q_symbols") < 0.02),
        "capitals": _vote(
            _per("q_capitals", "q_word_chars") > 0.3, _per("q_capitals", "q_word_chars") < 0.1
        ),
        "shouting": _vote(per_word("q_shouts") > 0.1, per_word("q_shouts") < 0.02),
        "repeated_lines": _vote(
            (F.col("q_dup_lines") >= 3) & (_per("q_dup_lines", "q_lines") > 0.5),
            _per("q_dup_lines", "q_lines") < 0.1,
        ),
    }


# ---- estimate -----------------------------------------------------------------


@dataclass
class Model:
    """Shares of the classes, and per class and rule the probabilities of its votes.

    Class ``good`` holds the good texts. Badness comes in kinds that have little in
    common, so each rule has a bad class of its own, the texts it was written against.
    """

    share: dict[str, float]
    votes: dict[str, dict[str, dict[int, float]]]


#: What is believed before any text is seen.
_GOOD_SHARE = 0.8
_ON_GOOD = {GOOD: 0.800, ABSTAIN: 0.195, BAD: 0.005}
_ON_OWN_KIND = {GOOD: 0.02, ABSTAIN: 0.03, BAD: 0.95}

#: In a rule's own bad class it votes bad more often than not: that is what makes the kind.
_OWN_LEAST = 0.5


def start_model(rules: list[str]) -> Model:
    share = {"good": _GOOD_SHARE} | {r: (1 - _GOOD_SHARE) / len(rules) for r in rules}
    return Model(
        share,
        {c: {r: dict(_ON_OWN_KIND if r == c else _ON_GOOD) for r in rules} for c in share},
    )


_VALUES = (GOOD, ABSTAIN, BAD)


def _arrays(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Shares by class, and probabilities by class, rule and vote; class 0 is good."""
    table = [[[p[v] for v in _VALUES] for p in rules.values()] for rules in model.votes.values()]
    return np.array(list(model.share.values())), np.array(table)


def _improved(
    share: np.ndarray, table: np.ndarray, seen: np.ndarray, n: np.ndarray, first: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """One round: which class each pattern's texts belong to, then the shares and votes that gives."""
    own = np.arange(table.shape[1])  # rule r has its kind in class r + 1
    weight = share * np.exp(np.einsum("prv,crv->pc", seen, np.log(table)))
    texts = weight * (n / weight.sum(axis=1))[:, None]
    # what a rule says of another rule's kind is taken to be what it says of good texts
    belief = np.repeat(table[:1], len(table), axis=0)
    belief[0], belief[own + 1, own] = first[1][0], first[1][own + 1, own]
    votes = np.einsum("pc,prv->crv", texts, seen) + PRIOR_COUNT * belief
    votes = np.clip(votes / votes.sum(axis=2, keepdims=True), 1e-9, 1 - 1e-9)
    kinds = votes[own + 1, own]
    bad = np.maximum(kinds[:, 2], _OWN_LEAST)
    kinds[:, :2] *= ((1 - bad) / (1 - kinds[:, 2]))[:, None]
    kinds[:, 2] = bad
    votes[own + 1, own] = kinds
    total = texts.sum(axis=0) + PRIOR_COUNT * first[0]
    shares = np.maximum(total / total.sum(), 1e-12)
    shares[1:] = np.minimum(shares[1:], KIND_MOST)
    shares[0] = 1 - shares[1:].sum()
    return shares, votes


def estimate(votes: DataFrame, rules: list[str]) -> Model:
    """The model in which expectation-maximisation over all rows' votes comes to rest.

    The counts of vote patterns, at most 3**rules rows, come to the driver.
    """
    counted = votes.groupBy(*[f"v_{r}" for r in rules]).agg(F.count(F.lit(1)).alias("n"))
    rows = sorted(tuple(r) for r in counted.collect())  # one order, so that reruns agree to the bit
    start = start_model(rules)
    if not rows:
        return start
    patterns = np.array([row[:-1] for row in rows]).reshape(len(rows), len(rules))
    seen = (patterns[:, :, None] == np.array(_VALUES)).astype(float)
    n = np.array([row[-1] for row in rows], float)
    first = share, table = _arrays(start)
    for _ in range(MOST_ROUNDS):
        before = table
        share, table = _improved(share, table, seen, n, first)
        if np.abs(table - before).max() < STILL:
            break
    classes = list(start.share)
    return Model(
        dict(zip(classes, share.tolist(), strict=True)),
        {c: {r: dict(zip(_VALUES, p.tolist(), strict=True)) for r, p in zip(rules, t, strict=True)}
         for c, t in zip(classes, table, strict=True)},
    )


def posterior(model: Model) -> Column:
    """Probability that a text with votes ``v_<rule>`` is good."""
    weights = {}
    for c, rules in model.votes.items():
        total = F.lit(log(model.share[c]))
        for r, p in rules.items():
            v = F.col(f"v_{r}")
            total = total + F.when(v == GOOD, log(p[GOOD])).when(v == BAD, log(p[BAD])).otherwise(
                log(p[ABSTAIN])
            )
        weights[c] = total
    good = weights.pop("good")
    # bad against good, so that the largest exponent cannot overflow
    against = sum((F.exp(F.least(w - good, F.lit(700.0))) for w in weights.values()), F.lit(0.0))
    return F.lit(1.0) / (1 + against)


def judge(
    docs: DataFrame,
    text: str = "text",
    rules: Mapping[str, Column] | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """Input columns (``text`` only with ``keep_text``), the measures, ``base_failed``,
    ``kept`` and ``posterior``."""
    rules = default_rules() if rules is None else rules
    names = [n for n in docs.columns if keep_text or n != text]
    column = C.position(docs, text)
    inner = measures(C.hidden(docs), column)
    if not keep_text:
        inner = inner.drop(column)
    inner = inner.select("*", *[vote.alias(f"v_{r}") for r, vote in rules.items()])
    judged = C.written(inner, "votes")
    model = estimate(judged, list(rules))
    judged = judged.withColumn("out_posterior", posterior(model))
    judged = judged.withColumn("out_failed", base_failed())
    judged = judged.withColumn(
        "out_kept", ~F.col("out_failed") & (F.col("out_posterior") >= KEEP_FROM)
    )
    order = [i for i, n in enumerate(docs.columns) if keep_text or n != text]
    judged = judged.select(
        *[F.col(f"in_{i}").alias(f"in_{k}") for k, i in enumerate(order)],
        *[c for c in judged.columns if not c.startswith("in_")],
    )
    return C.shown(
        judged,
        names,
        {
            "n_words": "q_words",
            "word_chars": "q_word_chars",
            "n_symbols": "q_symbols",
            "n_dup_lines": "q_dup_lines",
            "n_repeat_words": "q_repeat_words",
            "base_failed": "out_failed",
            "kept": "out_kept",
            "posterior": "out_posterior",
        },
    )
