"""Chat formatting over reply trees.

A message names its parent; every path from a root to a leaf is a conversation. Iterative
self-joins double the known distance: round k holds, for every message, the ancestor 2**k
steps up and the score in between, so a tree of depth d takes log2(d) rounds. Leaves are
ranked in their tree by their path's score, the chosen paths are spelled out by the same
tables, and every path becomes one text.

The template gives each turn a head line ``### role:``, its text and an end line ``</turn>``.
Lines of a text that start with either mark, after any number of backslashes, get one more
backslash, which reading takes off again; roles escape backslash and line end. So any text
comes back as it was.

Null roles and texts are empty. A message whose parent is missing is a root; messages on or
below a cycle of parents hang on no root and are on no path. Rows that repeat a message id
are one message only if all their columns are equal. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoprank.session import materialise

HEAD, END = "### ", "</turn>"
NO_ID = -(1 << 63)
_MARKED = r"(?dm)^(\\*)(### |</turn>)"
_ESCAPED = r"(?dm)^\\(\\*)(### |</turn>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def format_turns(turns: Column) -> Column:
    """One text of an array of structs (role, text)."""
    role = lambda t: F.replace(F.replace(t["role"], F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(HEAD), role(t), F.lit(":\n"), escape(t["text"]), F.lit(f"\n{END}\n"))), "")


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that ``format_turns`` wrote."""
    parts = F.filter(F.split(formatted, f"\\n{END}\\n", -1), lambda p: p != "")
    head = lambda p: F.substring_index(p, ":\n", 1)
    # between doubled backslashes, the other ones stand before an n
    unrole = lambda r: F.array_join(F.transform(F.split(r, r"\\\\", -1), lambda x: F.replace(
        x, F.lit("\\n"), F.lit("\n"))), "\\")
    return F.transform(parts, lambda p: F.struct(
        unrole(F.substring(head(p), len(HEAD) + 1, 1 << 30)).alias("role"),
        unescape(F.substring(p, F.length(head(p)) + 3, F.length(p))).alias("text")))


def best_paths(messages: DataFrame, paths: int = 1) -> DataFrame:
    """(tree_id, leaf, rank, score, place, msg_id) of the ``paths`` best root-to-leaf paths of
    every tree of ``messages`` (tree_id, msg_id, parent_id, score); place counts from the root.
    A path's score is the mean score of its messages; ties go to the smaller leaf id."""
    own = messages.select("tree_id", "msg_id", "parent_id", F.coalesce(F.col("score"), F.lit(0.0)).alias("score")).distinct()
    parents = own.select("tree_id", F.col("msg_id").alias("parent_id"), F.lit(True).alias("there"))
    jump = materialise(
        own.join(parents, ["tree_id", "parent_id"], "left").select(
            "tree_id", "msg_id", F.when(F.col("there"), F.col("parent_id")).alias("up"),
            F.lit(1).cast("long").alias("steps"), "score"), "chat-jump")
    leaves = jump.select("tree_id", "msg_id").join(
        jump.where("up is not null").select("tree_id", F.col("up").alias("msg_id")), ["tree_id", "msg_id"], "left_anti")
    total, rounds = jump.count(), 0
    ended, levels = jump.where("up is null"), [jump.where("up is not null")]
    while not levels[-1].isEmpty() and 1 << rounds <= total:
        # after round k a message knows its ancestor 2**k up, or all of its path; those that
        # know all of it are only looked up from then on
        here = levels[-1]
        up = ended.unionByName(here).select("tree_id", F.col("msg_id").alias("up"), F.col("up").alias("far"),
                                            F.col("steps").alias("more"), F.col("score").alias("extra"))
        step = materialise(here.join(up, ["tree_id", "up"]).select(
            "tree_id", "msg_id", F.col("far").alias("up"), (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("score") + F.col("extra")).alias("score")), "chat-jump")
        ended = ended.unionByName(step.where("up is null"))
        levels.append(step.where("up is not null"))
        rounds += 1
    done = ended.join(leaves, ["tree_id", "msg_id"])
    order = Window.partitionBy("tree_id").orderBy(F.desc("score"), "leaf")
    chosen = (done.select("tree_id", F.col("msg_id").alias("leaf"), "steps", (F.col("score") / F.col("steps")).alias("score"))
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= paths))
    path = materialise(chosen.select("*", (F.col("steps") - 1).alias("place"), F.col("leaf").alias("msg_id")), "chat-path")
    for k in reversed(range(len(levels))):
        # messages 2**k above the known ones; the widest jumps come first
        far = levels[k].select("tree_id", "msg_id", "up")
        more = path.join(far, ["tree_id", "msg_id"]).select(
            "tree_id", "leaf", "steps", "score", "rank", (F.col("place") - (1 << k)).alias("place"), F.col("up").alias("msg_id"))
        path = materialise(path.unionByName(more.select(*path.columns)), "chat-path")
    return path.drop("steps")


def conversations_of(messages: DataFrame, paths: int = 1) -> DataFrame:
    """(tree_id, leaf, rank, score, formatted) for the best paths of ``messages`` (tree_id,
    msg_id, parent_id, score, role, text)."""
    messages = messages.select("tree_id", "msg_id", "parent_id", "score", "role", "text").distinct()
    texts = messages.select("tree_id", "msg_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = best_paths(messages, paths).join(texts, ["tree_id", "msg_id"])
    rows = turns.groupBy("tree_id", "leaf", "rank", "score").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    return rows.select("tree_id", "leaf", "rank", "score", format_turns(F.col("turns")).alias("formatted"))


def chains(conversations: DataFrame) -> DataFrame:
    """Messages of ``conversations`` (conv_id, turn, role, text): each turn answers the one
    before; equal turns follow one another by role and text. Rows without a conv_id are one
    conversation, whose id comes back as null."""
    own = conversations.select(F.coalesce("conv_id", F.lit(NO_ID)).alias("tree_id"), "turn", "role", "text")
    order = Window.partitionBy("tree_id").orderBy("turn", "role", "text")
    numbered = own.withColumn("msg_id", F.row_number().over(order).cast("long"))
    return numbered.select("tree_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
                           F.lit(0.0).alias("score"), "role", "text")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back: turns, loss text and lengths."""
    back = formatted.select(F.when(F.col("tree_id") != NO_ID, F.col("tree_id")).alias("conv_id"), "formatted", read_turns(F.col("formatted")).alias("turns"))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
