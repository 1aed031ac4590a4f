"""Mixing sources to target weights by subset sums of exact lengths.

A source's target is its share of the budget by weight; a target stops at
``MOST_TIMES`` times the source's size and the excess is shared anew by weight until
none is above. Each source takes whole copies of all its texts as often as they fit
into its target, and fills the rest exactly, or as nearly as its lengths allow:

1. Texts are counted by exact length, per source.
2. Of each length the same fraction is taken, rounded down, so the mix keeps the
   source's lengths.
3. What is still missing is filled from the longest lengths down to a bounded rest,
   and that rest by a bounded-knapsack dynamic programme over lengths and counts.
4. Per length the texts with the smallest seeded draws are taken; equal rows, which share
   a draw, by the numbers they got when the draws were written.

How it runs: lengths and draws are computed once and written. Counts are kept per
source, length and 1/``SPREAD`` of the draws, so a length shared by a third of all
texts is ranked in many tasks. Only a threshold per (source, length, slice) joins
back, so a text's fate depends on nothing but its own draw and number. A source's counts, one
row per distinct length, are fitted in one task: n words have at most sqrt(2n)
distinct lengths. Sources, one row each, are put in order in one task.

Defined results: null or empty text has size 0 and is taken as often as its source's
whole copies. Sources in code-point order, null last. A source of size 0 has target
0. Of equal rows as many are taken as it takes, whichever. Empty table: empty.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm import columns as C
from lendmill.llm.shipping import by_value

by_value(__name__)

WEIGHTS = (1, 2, 3)
MOST_TIMES = 3
SEED = "mix-1"

#: Slices of the draws of one length.
SPREAD = 64

#: The dynamic programme fills rests of about this many words, or of the longest text if
#: that is more; larger rests are first brought down.
KNAPSACK = 1 << 16


# ---- targets ------------------------------------------------------------------


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most_times: int = MOST_TIMES
) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row per source.

    Weights repeat along the sources' order. The water level is raised until the
    capped and the weighted targets add up to the budget; each round is one sum.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = sizes.withColumn("place", F.row_number().over(order) - 1).withColumn(
        "weight",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
        ),
    )
    ranked = C.written(ranked.withColumn("most", most_times * F.col("source_size")), "sources")
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.col("most") <= F.col("weight") * level
        row = ranked.agg(
            F.sum(F.when(over, F.col("most")).otherwise(0)).alias("fixed"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(over.cast("long")).alias("n"),
        ).first()
        if not row["open"] or row["n"] == capped:
            break
        capped, level = row["n"], (budget - row["fixed"]) / row["open"]
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(float(level)))
    return ranked.select("source", "source_size", target.alias("target"))


# ---- fitting ------------------------------------------------------------------


def knapsack(lengths: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many texts of each length to take so that their sum is as near below ``budget`` as
    can be: bounded-knapsack dynamic programme on bit sets of reachable sums."""
    reach, full = 1, (1 << budget + 1) - 1
    steps: list[tuple[int, int, int]] = []
    for i, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        pack, left = 1, min(count, budget // length) if length else 0
        while left and not reach >> budget & 1:
            n = min(pack, left)
            new = (reach | reach << n * length) & full
            if new != reach:
                steps.append((i, n, reach))
                reach = new
            left, pack = left - n, pack * 2
        if reach >> budget & 1:
            break
    taken, sum_left = [0] * len(lengths), reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> sum_left & 1:
            taken[i] += n
            sum_left -= n * lengths[i]
    return taken


def fit(lengths: Sequence[int], counts: Sequence[int], budget: int, most: int = KNAPSACK) -> list[int]:
    """Texts to take per length, lengths ascending and above 0, for a sum as near ``budget`` as found."""
    whole = sum(length * n for length, n in zip(lengths, counts, strict=True))
    if budget >= whole:
        return list(counts)
    taken = [n * budget // whole for n in counts]
    rest = budget - sum(length * n for length, n in zip(lengths, taken, strict=True))
    for i in reversed(range(len(lengths))):
        if rest <= most:
            break
        more = min(counts[i] - taken[i], (rest - most // 2) // lengths[i])
        taken[i] += max(more, 0)
        rest -= max(more, 0) * lengths[i]
    # short lengths first: they make every sum reachable soon
    free = [(length, n - t, i) for i, (length, n, t) in enumerate(zip(lengths, counts, taken, strict=True))]
    free = [x for x in free if x[1] and x[0] <= rest]
    picked = knapsack([x[0] for x in free], [x[1] for x in free], rest)
    for (_, _, i), n in zip(free, picked, strict=True):
        taken[i] += n
    return taken


def _fit_source(counted: pd.DataFrame) -> pd.DataFrame:
    counted = counted.sort_values("size").reset_index(drop=True)
    size, target = int(counted["source_size"].iloc[0]), float(counted["target"].iloc[0])
    copies = int(target // size) if size else 0
    some = counted[counted["size"] > 0]
    taken = fit(some["size"].tolist(), some["n"].tolist(), round(target - copies * size))
    counted["copies"] = copies
    counted["extra"] = 0
    counted.loc[some.index, "extra"] = taken
    return counted[["source", "size", "copies", "extra"]]


# ---- selection ----------------------------------------------------------------


def mix_plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source, size and slice of draws: ``copies`` and the draw, and the number among equal
    draws, up to which one more is taken.

    ``sized`` has source, size, draw, slice and number for every text.
    """
    slices = C.written(
        sized.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("n")), "mix-counts"
    )
    counted = slices.groupBy("source", "size").agg(F.sum("n").alias("n"))
    counted = counted.join(targets, counted.source.eqNullSafe(targets.source)).select(
        counted.source, "size", "n", "source_size", "target"
    )
    fitted = C.written(
        counted.groupBy("source").applyInPandas(
            _fit_source, "source string, size long, copies long, extra long"
        ),
        "mix-fit",
    )
    order = Window.partitionBy("source", "size").orderBy("slice")
    below = slices.withColumn("until", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    below = below.withColumnsRenamed({"source": "s_source", "size": "s_size"})
    plan = fitted.join(
        below, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("size") == F.col("s_size"))
    ).select(
        "source",
        "size",
        "slice",
        "copies",
        F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - F.col("until") + F.col("n"))).alias("pick"),
        "n",
    )
    plan = C.written(plan, "mix-picks")
    # the draw that ends a slice taken in part
    some = plan.where((F.col("pick") > 0) & (F.col("pick") < F.col("n"))).select(
        F.col("source").alias("s_source"), F.col("size").alias("s_size"), F.col("slice").alias("s_slice"), "pick"
    )
    rank = Window.partitionBy("source", "size", "slice").orderBy("draw", "number")
    edge = (
        sized.join(
            some,
            F.col("source").eqNullSafe(F.col("s_source"))
            & (F.col("size") == F.col("s_size"))
            & (F.col("slice") == F.col("s_slice")),
        )
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") == F.col("pick"))
        .select("s_source", "s_size", "s_slice", F.col("draw").alias("edge"), F.col("number").alias("edge_number"))
    )
    return plan.join(
        edge,
        F.col("source").eqNullSafe(F.col("s_source"))
        & (F.col("size") == F.col("s_size"))
        & (F.col("slice") == F.col("s_slice")),
        "left",
    ).select(
        "source",
        "size",
        "slice",
        "copies",
        F.when(F.col("pick") == 0, F.lit(None).cast("long"))
        .when(F.col("pick") == F.col("n"), F.lit((1 << 63) - 1))
        .otherwise(F.col("edge"))
        .alias("edge"),
        F.coalesce(F.col("edge_number"), F.lit((1 << 63) - 1)).alias("edge_number"),
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    most_times: int = MOST_TIMES,
    seed: str = SEED,
    keep_text: bool = True,
) -> DataFrame:
    """Input columns (``text`` only with ``keep_text``), then ``size``, ``source_size``, ``target``,
    ``times`` (how often the mix takes the text) and ``taken`` (words taken)."""
    inner = C.hidden(docs)
    t, s = C.position(docs, text), C.position(docs, source)
    known = [F.col(c) for c, kind in inner.dtypes if not any(k in kind for k in ("map<", "variant"))]
    inner = inner.withColumn("source", F.col(s).cast("string"))
    inner = inner.withColumn("size", C.n_words(t)).withColumn("draw", F.xxhash64(F.lit(seed), *known))
    # draws are taken from the smallest on, so slices follow their order
    inner = inner.withColumn(
        "slice", F.shiftright("draw", 64 - (SPREAD.bit_length() - 1)).cast("int")
    )
    if not keep_text:
        inner = inner.drop(t)
    sized = C.written(inner.withColumn("number", F.monotonically_increasing_id()), "mix-sized")
    narrow = sized.select("source", "size", "draw", "slice", "number")
    targets = C.written(
        source_targets(
            narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most_times
        ),
        "mix-targets",
    )
    plan = mix_plan(narrow, targets)
    targets = targets.withColumnRenamed("source", "t_source")
    plan = plan.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).select(
        F.col("source").alias("p_source"),
        F.col("size").alias("p_size"),
        F.col("slice").alias("p_slice"),
        "copies",
        "edge",
        "edge_number",
        "source_size",
        "target",
    )
    taken = sized.join(
        plan,
        F.col("source").eqNullSafe(F.col("p_source"))
        & (F.col("size") == F.col("p_size"))
        & (F.col("slice") == F.col("p_slice")),
    )
    more = (F.col("draw") < F.col("edge")) | (
        (F.col("draw") == F.col("edge")) & (F.col("number") <= F.col("edge_number"))
    )
    times = F.col("copies") + F.coalesce(more.cast("long"), F.lit(0))
    taken = taken.withColumn("times", times).withColumn("taken", F.col("times") * F.col("size"))
    order = [i for i, n in enumerate(docs.columns) if keep_text or n != text]
    taken = taken.select(
        *[F.col(f"in_{i}").alias(f"in_{k}") for k, i in enumerate(order)],
        *[F.col(c).alias(f"out_{c}") for c in ("size", "source_size", "target", "times", "taken")],
    )
    results = {c: f"out_{c}" for c in ("size", "source_size", "target", "times", "taken")}
    return C.shown(taken, [docs.columns[i] for i in order], results)
