"""Reply trees to training conversations, in DataFrame functions only.

Messages answer messages. Every path from a root to a message without an answer is
a branch; each tree's best branches by score become one conversation each, in a
template that marks turns and says which characters the loss is taken on.

Paths come from iterative self-joins that double their reach: round k knows each
message's ancestor 2**k steps up, and what the steps between add to score and
length. A chain of n messages takes log2(n) rounds. Only the chosen branches are then spelled out,
by the same tables from the longest step to the shortest, so no path is ever
built for a message that is not needed; rows stay below messages plus the length
of the chosen branches. A formatted conversation is one value of one row, as is
its list of turns.

Template
    ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. In roles and texts a
    backslash is put between ``<`` and ``|``, after any that are there, so that no
    control string can arise; a line break in a role becomes ``<|n|>``. Reading
    back takes the added ones away.

Defined results: null text or role: empty. Null score: 0. A parent that is null or
not in the tree makes a root. Null tree: a tree like any other. Messages without an
id, or in or below a loop of answers, are on no path. Rows with one id: the
smallest by parent, role and text stands. Ties in score: the longer branch, then
the smaller leaf id. Empty table: empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm import columns as C

#: Fixed values of the template.
START, END, BREAK = "<|im_start|>", "<|im_end|>\n", "<|n|>"

LOSS_ROLES = ("assistant",)


# ---- template -----------------------------------------------------------------


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), F.replace(escaped(role), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))


def turns_read(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)

    def turn(part: Column) -> Column:
        body = F.substr(part, F.lit(len(START) + 1))
        role = F.split(body, "\n", 2)
        return F.struct(
            unescaped(F.replace(F.get(role, F.lit(0)), F.lit(BREAK), F.lit("\n"))).alias("role"),
            unescaped(F.get(role, F.lit(1))).alias("text"),
        )

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def loss_read(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, escapes taken away, nothing between the spans."""
    texts = F.transform(
        spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))
    )
    return F.array_join(texts, "")


# ---- paths --------------------------------------------------------------------


def _messages(df: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None):
    """One row per id: ``me`` and ``up`` as (tree, id), ``said`` and ``points``."""
    points = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    rows = df.select(
        F.struct(F.col(tree).alias("tree"), F.col(node).alias("node")).alias("me"),
        F.col(tree).alias("tree"),
        F.col(parent).alias("parent"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        points.alias("points"),
    ).where(F.col("me.node").isNotNull())
    one = F.min(F.struct("parent", "role", "text", "points")).alias("it")
    return rows.groupBy("me").agg(one).select(
        "me",
        F.when(
            F.col("it.parent").isNotNull(),
            F.struct(F.col("me.tree").alias("tree"), F.col("it.parent").alias("node")),
        ).alias("up"),
        F.struct("it.role", "it.text").alias("said"),
        "it.points",
    )


def _reaches(nodes: DataFrame) -> list[DataFrame]:
    """Round k: ``me``, its ancestor ``up`` 2**k steps away (null beyond the root), and of the messages
    from ``me`` to before ``up`` the uppermost (``top``), the number ``n`` and the ``points``."""
    known = nodes.select(F.col("me").alias("there"))
    first = nodes.join(known, nodes.up == known.there, "left").select(
        "me", F.col("there").alias("up"), F.col("me").alias("top"), F.lit(1).cast("long").alias("n"), "points"
    )
    rounds = [C.written(first, "reach")]
    most = max(1, rounds[0].count()).bit_length()
    while len(rounds) <= most and rounds[-1].where("up IS NOT NULL").limit(1).count():
        # messages whose root is reached are done; only the others look further up
        near, done = rounds[-1].where("up IS NOT NULL"), rounds[-1].where("up IS NULL")
        far = rounds[-1].select([F.col(c).alias(f"far_{c}") for c in near.columns])
        further = near.join(far, near.up == far.far_me).select(
            "me",
            F.col("far_up").alias("up"),
            F.col("far_top").alias("top"),
            (F.col("n") + F.col("far_n")).alias("n"),
            (F.col("points") + F.col("far_points")).alias("points"),
        )
        rounds.append(C.written(further.union(done), "reach"))
    return rounds


def branch_members(
    nodes: DataFrame, branches: int
) -> DataFrame:
    """``path`` (its leaf), ``rank`` of the path in its tree, ``place`` from 1 at the root, ``me``."""
    rounds = _reaches(nodes)
    answered = rounds[0].where("up IS NOT NULL").select(F.col("up").alias("asked"))
    leaves = rounds[-1].where("up IS NULL").join(answered, F.col("me") == F.col("asked"), "left_anti")
    order = Window.partitionBy("top").orderBy(F.desc("points"), F.desc("n"), "me")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    members = C.written(
        chosen.select(F.col("me").alias("path"), "rank", F.col("n").alias("place"), "me"), "paths"
    )
    for k in reversed(range(len(rounds) - 1)):
        step = rounds[k].where("up IS NOT NULL").select(F.col("me").alias("from"), "up")
        above = members.join(step, members.me == F.col("from")).select(
            "path", "rank", (F.col("place") - (1 << k)).alias("place"), F.col("up").alias("me")
        )
        members = C.written(members.union(above), "paths")
    return members


def conversations(
    df: DataFrame,
    tree: str,
    node: str,
    parent: str,
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    branches: int = 1,
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """``tree_id``, ``rank`` (1 is the tree's best branch of that root), ``leaf``, ``formatted`` and
    ``loss_spans``, [start, end) in code points of ``formatted``."""
    nodes = C.written(_messages(df, tree, node, parent, role, text, score), "messages")
    members = branch_members(nodes.select("me", "up", "points"), branches)
    said = nodes.select(F.col("me").alias("who"), "said")
    spoken = members.join(said, members.me == F.col("who")).select("path", "rank", "place", "said.*")
    spoken = spoken.withColumn("head", _head(F.col("role"))).withColumn("body", escaped(F.col("text")))
    length = F.length("head") + F.length("body") + len(END)
    before = Window.partitionBy("path").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long") + F.length("head")
    spoken = spoken.withColumn("start", start).withColumn("end", F.col("start") + F.length("body"))
    span = F.when(F.col("role").isin(*loss_roles), F.struct("start", "end"))
    turns = F.sort_array(
        F.collect_list(
            F.struct("place", F.concat("head", "body", F.lit(END)).alias("turn"), span.alias("span"))
        )
    )
    return (
        spoken.groupBy("path", "rank")
        .agg(turns.alias("turns"))
        .select(
            F.col("path.tree").alias("tree_id"),
            "rank",
            F.col("path.node").alias("leaf"),
            F.array_join("turns.turn", "").alias("formatted"),
            F.array_compact("turns.span").alias("loss_spans"),
        )
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives."""
    loss = loss_read(F.col("formatted"), F.col("loss_spans"))
    read = formatted.withColumn("turns", turns_read(F.col("formatted"))).withColumn("loss", loss)
    flat = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
