"""Chat formatting of reply trees, in DataFrame functions alone.

Messages name their parent. Root-to-leaf paths are found by self-joins that double their reach:
after k of them a message knows its ancestor 2**k steps up and the score on the way, so depth d
takes log2(d) rounds. The branches of a tree are ranked by the sum of their messages' scores at
their leaves; only the chosen ones are written out as paths, and each becomes one conversation.

Template: ``<|im_start|>role``, a line feed, the text, ``<|im_end|>``, a line feed. Inside roles
and texts a backslash is doubled, ``<|`` becomes ``<\\|``, and a line feed in a role ``\\n``; so no
text can hold a mark, and every text can be read back. The loss mask are the ranges of the
assistant's texts in the formatted string.

Defined cases: null texts and roles are empty; a null score is 0. A message whose parent doesn't
exist is a root. Messages in a cycle reach no root and are left out. Branches of equal score are
ranked by their leaf. Conversations with a null id are one conversation. Rows that share an id
in one tree aren't told apart: ids must be unique, as ``chained`` makes them. An empty table
gives no rows. Very long texts are escaped in their row. Other columns, of any name, are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.storage import cut

#: Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escape(text: Column, one_line: bool = False) -> Column:
    safe = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(safe, F.lit("\n"), F.lit("\\n")) if one_line else safe


def unescape(text: Column) -> Column:
    """Doubled backslashes are set apart first, so that each escape is read once."""

    def plain(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n"))

    return F.array_join(F.transform(F.split(text, "\\\\\\\\", -1), plain), "\\")


def chained(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as trees: every row replies to the one before it, by turn."""
    narrow = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    named = cut(narrow.withColumn("node", F.monotonically_increasing_id()))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"), F.col("node"))
    return named.withColumn("parent", F.lag("node").over(order)).withColumn("score", F.lit(0.0))


def best_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """``messages`` (conv, node, parent, role, text, score) on the ``top`` paths of each tree.

    Adds ``leaf``, which names the path, ``rank`` and ``depth`` (the root has 0)."""
    known = messages.select("node", F.coalesce("score", F.lit(0.0)).alias("score"))
    parents = messages.select("node", F.col("parent").alias("up")).where("up is not null")
    real = parents.join(known.select(F.col("node").alias("up")), "up", "left_semi")
    # ``root`` is known as soon as nothing is further up
    state = known.join(real, "node", "left").select(
        "node", "up", F.col("node").alias("root"), "score", F.lit(1).cast("long").alias("steps")
    )
    state = cut(state)
    rounds = max(1, math.ceil(math.log2(max(2, state.count()))) + 1)
    jumps = []
    for _ in range(rounds):
        jump = state.where("up is not null").select("node", "up")
        if jump.isEmpty():
            break
        jumps.append(jump)
        above = state.select(
            F.col("node").alias("up"), F.col("up").alias("next"), F.col("root").alias("top"), F.col("score").alias("more"), F.col("steps").alias("far")
        )
        # a message that has reached its root waits; only the others go on
        further = state.where("up is not null").drop("root").join(above, "up").select(
            "node",
            F.col("next").alias("up"),
            F.col("top").alias("root"),
            (F.col("score") + F.col("more")).alias("score"),
            (F.col("steps") + F.col("far")).alias("steps"),
        )
        state = cut(state.where("up is null").union(further.select(*state.columns)))
    rooted = state.where("up is null").select("node", "root", "score", (F.col("steps") - 1).alias("depth"))

    # branches are ranked by their leaves; only the chosen ones are written out
    leaves = rooted.join(real.select(F.col("up").alias("node")).distinct(), "node", "left_anti")
    by_score = Window.partitionBy("root").orderBy(F.col("score").desc(), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    path = ranked.select(F.col("node").alias("leaf"), "node", "rank")
    for jump in jumps:
        # each round doubles what is known of a path, and would double the plan as well
        path = cut(path.union(path.join(jump, "node").select("leaf", F.col("up").alias("node"), "rank")))
    chosen = path.join(rooted.select("node", "depth"), "node")
    return messages.drop("score").join(chosen, "node")


def format_paths(turns: DataFrame) -> DataFrame:
    """Per path: ``conv_id``, ``leaf``, ``rank``, ``n_turns``, ``formatted`` and ``loss_spans``.

    Spans are code points from ``start`` up to ``end``, in order. A path is one row, so its turns
    meet in one task."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), escape(role, one_line=True), F.lit("\n"))
    body = escape(text)
    pieces = turns.select(
        "conv", "leaf", "rank", "depth", (role == ASSISTANT).alias("loss"), head.alias("head"), body.alias("body"),
        F.concat(head, body, F.lit(f"{END}\n")).alias("piece"),
    )
    before = Window.partitionBy("leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn(
        "start", F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)) + F.char_length("head")
    ).withColumn("end", F.col("start") + F.char_length("body"))
    row = F.struct("depth", "piece", "loss", F.struct("start", "end").alias("span"))
    grouped = placed.groupBy("leaf").agg(
        F.first("conv").alias("conv_id"), F.first("rank").alias("rank"), F.sort_array(F.collect_list(row)).alias("rows")
    )
    return grouped.select(
        "conv_id",
        "leaf",
        "rank",
        F.size("rows").cast("long").alias("n_turns"),
        F.array_join("rows.piece", "").alias("formatted"),
        F.transform(F.filter("rows", lambda r: r["loss"]), lambda r: r["span"]).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """Roles and texts of a formatted conversation, as structs in order."""
    turns = F.filter(F.split(formatted, "<\\|im_end\\|>\n", -1), lambda part: part != "")

    def parse(part: Column) -> Column:
        inner = F.substr(part, F.lit(len(START) + 1))
        feed = F.instr(inner, "\n")
        return F.struct(
            unescape(F.substr(inner, F.lit(1), feed - 1)).alias("role"), unescape(F.substr(inner, feed + 1)).alias("text")
        )

    return F.transform(turns, parse)


def with_digests(paths: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: turns and the text under the mask."""
    turns = F.transform(
        read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    masked = F.transform(
        "loss_spans",
        lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    loss = F.array_join(masked, "")
    return paths.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
