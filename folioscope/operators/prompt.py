"""Prompt rows: context block, conversation history and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.operators.blocks import prefix_sums

SPEAKERS = ["user", "assistant"]
TURNS_PER_BLOCK = 4096


def context_blocks(hits: DataFrame) -> DataFrame:
    """Per query: the ranked hits as one text, their number and the top sources.

    A query has at most its own number of requested results here.
    """
    relevance = F.round("relevance_score", 3)
    block = F.concat(
        F.lit("\n**Source "), F.col("rank"), F.lit("** - "), F.col("section_type"),
        F.lit(" (Pages "), F.col("page_range"), F.lit(")\nRelevance: "),
        F.format_string("%.3f", relevance),
        F.lit("\n\nContent: "), F.col("content"),
        F.lit("\n\nSummary: "), F.coalesce("summary", F.lit("")), F.lit("\n---"),
    )
    source = F.struct(
        F.col("chunk_id").alias("chunk_id"),
        F.col("section_type").alias("section"),
        F.col("page_range").alias("pages"),
        relevance.alias("relevance"),
    )
    ranked = F.col("ranked")
    return (
        hits.groupBy("query_id")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("rank", block.alias("block"), source.alias("source")))
            ).alias("ranked")
        )
        .select(
            "query_id",
            F.array_join(ranked["block"], "\n").alias("context"),
            F.size(ranked).alias("num_contexts"),
            F.slice(ranked["source"], 1, fv.MAX_SOURCES).alias("sources"),
        )
    )


def _messages(conversations: DataFrame) -> DataFrame:
    return conversations.where(F.col("role").isin(SPEAKERS))


def _last(items: Column, n: int) -> Column:
    return F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), n)


def recent_messages(conversations: DataFrame, k: int = fv.MEMORY_EXCHANGES) -> DataFrame:
    """The last ``k`` exchanges (2k messages) of each conversation.

    The rank limit is a constant, so each task cuts a long conversation to 2k rows
    before the shuffle.
    """
    newest = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    ranked = (
        _messages(conversations)
        .withColumn("_age", F.row_number().over(newest))
        .where(F.col("_age") <= 2 * k)
    )
    return ranked.groupBy("conv_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
            lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text")),
        ).alias("history")
    )


def history_window(
    conversations: DataFrame,
    k: int = fv.MEMORY_EXCHANGES,
    turns_per_block: int = TURNS_PER_BLOCK,
) -> DataFrame:
    """For every user message: the up to 2k messages before it.

    A conversation is cut into blocks of turns.  The first messages of a block also
    need the end of earlier blocks: the last 2k messages of each, of which the 2k
    nearest blocks are enough, as none is empty.
    """
    size = 2 * k
    blocked = _messages(conversations).withColumn(
        "turn_block", F.floor(F.col("turn") / F.lit(turns_per_block))
    )
    keys = ["conv_id", "turn_block"]
    newest = Window.partitionBy(*keys).orderBy(F.desc("turn"))
    message = F.struct("role", "text")
    tails = (
        blocked.withColumn("_age", F.row_number().over(newest))
        .where(F.col("_age") <= size)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("tail"))
    )
    before = Window.partitionBy("conv_id").orderBy("turn_block").rowsBetween(-size, -1)
    carried = tails.select(
        *keys, _last(F.flatten(F.collect_list("tail").over(before)), size).alias("carried")
    ).where(F.size("carried") > 0).withColumn(
        "carried",
        F.transform("carried", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text"))),
    )
    inside = Window.partitionBy(*keys).orderBy("turn").rowsBetween(-size, -1)
    own = blocked.withColumn("own", F.collect_list(message).over(inside)).where(
        F.col("role") == "user"
    )
    joined = own.join(carried, keys, "left")
    history = F.when(
        F.col("carried").isNull() | (F.size("own") == size), F.col("own")
    ).otherwise(_last(F.concat("carried", "own"), size))
    return joined.select(
        "conv_id", "turn", F.col("text").alias("question"), history.alias("history")
    )


def message_rows(conversations: DataFrame, turns_per_block: int = TURNS_PER_BLOCK) -> DataFrame:
    """Every message with its place in the full history of its conversation.

    ``conv_id, turn, turn_block, position`` (from 1)``, start, role, text``; ``start`` is the
    number of characters before it when messages are written as ``role: text``, one a line.
    Null texts are empty; rows without a conversation are left out; those of one turn are ordered
    by role and text.
    """
    messages = _messages(conversations).where(F.col("conv_id").isNotNull())
    messages = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    written = (F.char_length("role") + F.char_length("text") + 3).cast("long")
    placed = prefix_sums(
        messages, ["conv_id"], "turn", {"earlier": F.lit(1).cast("long"), "start": written}, turns_per_block, ("role", "text")
    )
    return placed.select(
        "conv_id", "turn", "turn_block", (F.col("earlier") + 1).alias("position"), "start", "role", "text"
    )


def history_extents(conversations: DataFrame, turns_per_block: int = TURNS_PER_BLOCK) -> DataFrame:
    """For every user message its full history as an extent: the number of messages and of
    characters before it.

    The history itself is those first rows of ``message_rows``; written out for every message it
    would grow with the square of the conversation.
    """
    return message_rows(conversations, turns_per_block).where(F.col("role") == "user").select(
        "conv_id",
        "turn",
        F.col("text").alias("question"),
        (F.col("position") - 1).alias("history_messages"),
        F.col("start").alias("history_chars"),
    )


def _history_blocks(queries: DataFrame, messages: DataFrame, k: int | None) -> DataFrame:
    """Per query the blocks of its conversation that its history reaches into, and how many
    messages are left out before it."""
    blocks = messages.groupBy("conv_id", "turn_block").agg(F.max("position").alias("last"))
    total = F.max("last").over(Window.partitionBy("conv_id"))
    omitted = F.greatest(total - 2 * k, F.lit(0)) if k is not None else F.lit(0).cast("long")
    blocks = blocks.select("conv_id", "turn_block", "last", total.alias("total"), omitted.alias("omitted"))
    asked = queries.select("query_id", F.col("conversation_id").alias("conv_id")).where("conv_id IS NOT NULL")
    return asked.join(blocks.where("last > omitted"), "conv_id")


def history_rows(
    queries: DataFrame,
    conversations: DataFrame,
    k: int | None = None,
    turns_per_block: int = TURNS_PER_BLOCK,
) -> DataFrame:
    """The history of each query's conversation as rows ``query_id, position, start, role, text``.

    With ``k`` the last ``k`` exchanges, without it all messages.  Queries meet the blocks of
    their conversation, then messages by conversation and block, so no task holds a conversation
    and no row a history.
    """
    messages = message_rows(conversations, turns_per_block)
    met = messages.join(_history_blocks(queries, messages, k), ["conv_id", "turn_block"]).where("position > omitted")
    start = F.col("start")
    if k is not None:
        # at most 2k rows
        start = start - F.min("start").over(Window.partitionBy("query_id"))
    return met.select("query_id", (F.col("position") - F.col("omitted")).alias("position"), start.alias("start"), "role", "text")


def system_prompt(document: dict[str, str] = fv.PROMPT_DOCUMENT) -> str:
    return fv.SYSTEM_PROMPT.format(**document)


def human_message(query: Column, context: Column) -> Column:
    return F.concat(
        F.lit(fv.HUMAN_PROMPT_OPENING), context,
        F.lit(fv.HUMAN_PROMPT_QUESTION), F.coalesce(query, F.lit("")),
        F.lit(fv.HUMAN_PROMPT_CLOSING),
    )


def prompt_struct(
    query: Column, context: Column, history: Column, system: str | None = None
) -> Column:
    """System text, history and the human message, ready for any chat model."""
    return F.struct(
        F.lit(system or system_prompt()).alias("system"),
        history.alias("history"),
        human_message(query, context).alias("human"),
    )


def prompt_rows(
    queries: DataFrame,
    hits: DataFrame,
    conversations: DataFrame | None = None,
    k: int = fv.MEMORY_EXCHANGES,
    system: str | None = None,
) -> DataFrame:
    """One row per query: prompt, number of contexts and sources.

    ``queries``: ``query_id, query, conversation_id``.  Queries without hits stay, with
    the fixed sentence as context; without a conversation the history is empty.
    """
    no_sources = F.lit([]).cast(
        context_blocks(hits).schema["sources"].dataType
    )
    no_history = F.lit([]).cast("array<struct<role:string,text:string>>")
    rows = queries.select("query_id", "query", "conversation_id").join(
        context_blocks(hits), "query_id", "left"
    )
    if conversations is None:
        rows = rows.withColumn("history", no_history)
    else:
        asked = queries.select(F.col("conversation_id").alias("conv_id")).where(
            "conv_id IS NOT NULL"
        )
        recent = recent_messages(conversations.join(asked.distinct(), "conv_id", "left_semi"), k)
        # rows without a conversation would all meet in one task
        talking = rows.where("conversation_id IS NOT NULL").join(
            recent.withColumnRenamed("conv_id", "conversation_id"), "conversation_id", "left"
        )
        silent = rows.where("conversation_id IS NULL").withColumn("history", no_history)
        rows = talking.unionByName(silent)
    return rows.select(
        "query_id",
        "conversation_id",
        prompt_struct(
            F.col("query"),
            F.coalesce("context", F.lit(fv.NO_CONTEXT)),
            F.coalesce("history", no_history),
            system,
        ).alias("prompt"),
        F.coalesce("num_contexts", F.lit(0)).alias("num_contexts"),
        F.coalesce("sources", no_sources).alias("sources"),
    )


def prompt_messages(
    queries: DataFrame,
    hits: DataFrame,
    conversations: DataFrame,
    k: int | None = None,
    system: str | None = None,
    turns_per_block: int = TURNS_PER_BLOCK,
) -> DataFrame:
    """The prompt of each query as chat messages, one a row: ``query_id, position, role, text``.

    Position 0 is the system text, then come the history (all of it without ``k``) and the human
    message.  ``queries``: ``query_id, query, conversation_id``, one row a query.
    """
    sizes = message_rows(conversations, turns_per_block).groupBy("conv_id").agg(F.max("position").alias("total"))
    said = F.coalesce("total", F.lit(0))
    last = said if k is None else F.least(said, F.lit(2 * k))
    # rows without a conversation would all meet in one task
    talking = queries.where("conversation_id IS NOT NULL").join(
        sizes.withColumnRenamed("conv_id", "conversation_id"), "conversation_id", "left"
    )
    counted = talking.select("query_id", "query", (last + 1).alias("position")).unionByName(
        queries.where("conversation_id IS NULL").select("query_id", "query", F.lit(1).cast("long").alias("position"))
    )
    human = counted.join(context_blocks(hits).select("query_id", "context"), "query_id", "left").select(
        "query_id",
        "position",
        F.lit("user").alias("role"),
        human_message(F.col("query"), F.coalesce("context", F.lit(fv.NO_CONTEXT))).alias("text"),
    )
    opening = queries.select(
        "query_id", F.lit(0).cast("long").alias("position"), F.lit("system").alias("role"), F.lit(system or system_prompt()).alias("text")
    )
    history = history_rows(queries, conversations, k, turns_per_block).select("query_id", "position", "role", "text")
    return opening.unionByName(history).unionByName(human)
