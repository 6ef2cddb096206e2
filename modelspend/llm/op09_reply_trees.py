"""Chat formatting: reply trees to conversations, with DataFrame operations only.

Messages form trees through their parents.  Self-joins that double their reach
in every round (so a path of d messages takes log2 d rounds) give each leaf the
score of its whole branch; the best branches of each tree are chosen, and the
same tables of doubled jumps list the messages of each chosen path.  One path
becomes one conversation in a reversible template, with the code-point spans of
the assistant's texts as its loss mask.

Every join has a unique message on one side, so a huge tree doesn't gather in
one task; only a chosen path, which is one output row, does.

Edge cases: null text or role is empty; null score counts 0; a message whose
parent doesn't exist starts a tree's path like a root; messages on or below a cycle of parents
have no root and give no path; ties in score go to the smallest leaf id; an
empty table gives no rows; other columns are ignored.  Message ids must be
unique within a tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelspend.llm.shared import read_table, stage

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
ASSISTANT = "assistant"
#: The conversation that the contract adds to the table's own.
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    """Double each backslash, and break control strings with one."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.regexp_replace(text, r"<([|/sS])", r"<\\$1")
    return F.regexp_replace(text, r"\[(/?INST)", r"[\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def messages_from_turns(conversations: DataFrame) -> DataFrame:
    """Chains from rows (conv_id, turn, role, text): each row replies to the one before it.

    Rows of equal turn, repeated ones too, follow each other by role and text.
    A null conv_id is a conversation of its own; a null turn comes first.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("tree", key)
    order = W.partitionBy("tree").orderBy("turn", "role", "text")
    return rows.withColumn("id", F.row_number().over(order).cast("long")).select(
        "tree",
        "conv_id",
        "id",
        F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
        "role",
        "text",
        F.lit(1.0).alias("score"),
    )


def jump_tables(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestors 1, 2, 4, ... steps up, and the whole score of the branch that ends in each message."""
    own = messages.select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = own.select(F.col("tree"), F.col("id").alias("parent"))
    # an unknown parent is no parent
    linked = own.filter("parent IS NOT NULL").join(known, ["tree", "parent"], "left_semi")
    step = stage(
        own.select("tree", "id", "score")
        .join(linked.select("tree", "id", F.col("parent").alias("up")), ["tree", "id"], "left")
        .select("tree", "id", "up", "score"),
        "jumps",
    )
    jumps, reach, total = [], 1, step.count()
    # a path longer than the number of messages has a cycle; what still climbs then has no root
    while reach <= total and not step.filter("up IS NOT NULL").isEmpty():
        jumps.append(step.filter("up IS NOT NULL").select("tree", "id", "up"))
        above = step.select("tree", F.col("id").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"))
        climbing = step.filter("up IS NOT NULL").join(above, ["tree", "up"])
        step = stage(
            climbing.select("tree", "id", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"))
            .unionByName(step.filter("up IS NULL")),
            "jumps",
        )
        reach *= 2
    return jumps, step.filter("up IS NULL").select("tree", "id", "score")


def chosen_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, leaf, id, rank, above): the messages of each tree's best branches, and how many steps above the leaf; None keeps all branches."""
    jumps, reached = jump_tables(messages)
    inner = messages.filter("parent IS NOT NULL").select("tree", F.col("parent").alias("id")).distinct()
    leaves = reached.join(inner, ["tree", "id"], "left_anti")
    best = W.partitionBy("tree").orderBy(F.desc("score"), "id")
    leaves = leaves.withColumn("rank", F.row_number().over(best))
    if branches is not None:
        leaves = leaves.filter(F.col("rank") <= branches)
    paths = leaves.select("tree", F.col("id").alias("leaf"), "id", "rank", F.lit(0).cast("long").alias("above"))
    for n, jump in enumerate(jumps):
        # a jump of round n goes 2 ** n messages up
        higher = paths.join(jump, ["tree", "id"]).select("tree", "leaf", F.col("up").alias("id"), "rank", (F.col("above") + (1 << n)).alias("above"))
        paths = stage(paths.unionByName(higher), "paths")
    return paths


def format_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """One row per chosen path: tree, leaf, rank, formatted text, loss mask (start, end exclusive)."""
    paths = chosen_paths(messages, branches)
    turn = F.struct((-F.col("above")).alias("place"), F.coalesce("role", F.lit("")).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text"))
    rows = paths.join(messages.select("tree", "id", "role", "text"), ["tree", "id"])
    turns = rows.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT), t["text"], F.lit(END)))
    start = lambda at, t: at + F.length(escape(t["role"])) + len(TURN) + len(TEXT)
    mask = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask")),
        lambda acc, t: F.struct(
            (start(acc["at"], t) + F.length(t["text"]) + len(END)).alias("at"),
            F.when(
                t["role"] == ASSISTANT,
                F.concat(
                    acc["mask"],
                    F.array(
                        F.struct(
                            start(acc["at"], t).alias("start"),
                            (start(acc["at"], t) + F.length(t["text"])).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["mask"])
            .alias("mask"),
        ),
        lambda acc: acc["mask"],
    )
    return turns.select("tree", "leaf", "rank", F.array_join(parts, "").alias("formatted"), mask.alias("loss_mask"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.array_remove(F.split(formatted, r"<\|end\|>\n"), "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring_index(p, TEXT, 1), TURN, -1)).alias("role"),
            unescape(F.substring_index(p, TEXT, -1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(mask, lambda m: unescape(F.substring(formatted, m["start"] + 1, m["end"] - m["start"]))), ""
    )


def op9_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table and the probe, formatted and read back."""
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = stage(messages_from_turns(table.unionByName(probe)), "messages")
    tree = messages.filter("id = 1").select("tree", "conv_id")
    done = format_paths(messages).join(tree, "tree")
    loss = loss_text(F.col("formatted"), F.col("loss_mask"))
    read = done.select(
        "conv_id", read_back(F.col("formatted")).alias("turns"), loss.alias("loss"), F.length("formatted").alias("chars")
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"),
    )
