import random

from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.operators import prompt

CONV = "conv_id bigint, turn bigint, role string, text string"


def conversation_rows():
    rng = random.Random(4)
    rows = []
    for conv in range(6):
        turn = 0
        for _ in range(rng.randint(1, 40)):
            turn += rng.choice([1, 1, 2, 9])
            rows.append((conv, turn, rng.choice(["user", "assistant", "system"]), f"t{conv}.{turn}"))
    return rows


def test_history_window_agrees_with_a_loop(spark):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, CONV)
    for k in (1, 3):
        want, said = {}, {}
        for conv, turn, role, text in sorted(rows):
            if role == "system":
                continue
            before = said.setdefault(conv, [])
            if role == "user":
                want[conv, turn] = before[-2 * k :]
            said[conv] = [*before, (role, text)]
        for size in (1, 2, 5, 4096):
            got = prompt.history_window(df, k, size).collect()
            assert {(r["conv_id"], r["turn"]): [tuple(m) for m in r["history"]] for r in got} == want


def test_recent_messages(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"m{i}") for i in range(20)] + [(1, 99, "system", "no")]
    (got,) = prompt.recent_messages(spark.createDataFrame(rows, CONV), 2).collect()
    assert [m["text"] for m in got["history"]] == ["m16", "m17", "m18", "m19"]


HITS = [(1, r, f"c{r}", f"text {r}", None if r == 2 else "sum", "VERDICT", "3-4", 1.23456 / r) for r in range(1, 8)]


def hits(spark):
    return spark.createDataFrame(
        HITS,
        "query_id bigint, rank int, chunk_id string, content string, summary string, "
        "section_type string, page_range string, relevance_score double",
    )


def test_context_block_format(spark):
    (got,) = prompt.context_blocks(hits(spark).where("rank <= 2")).collect()
    assert got["context"] == (
        "\n**Source 1** - VERDICT (Pages 3-4)\nRelevance: 1.235\n\nContent: text 1\n\nSummary: sum\n---"
        "\n\n**Source 2** - VERDICT (Pages 3-4)\nRelevance: 0.617\n\nContent: text 2\n\nSummary: \n---"
    )
    assert got["num_contexts"] == 2
    assert got["sources"][0].asDict() == {"chunk_id": "c1", "section": "VERDICT", "pages": "3-4", "relevance": 1.235}


def test_prompt_rows_keep_queries_without_hits(spark):
    queries = spark.createDataFrame(
        [(1, "why?", "7"), (2, "how?", None), (3, "who?", "8")],
        "query_id bigint, query string, conversation_id string",
    )
    talks = spark.createDataFrame(
        [("7", 0, "user", "a"), ("7", 1, "assistant", "b"), ("9", 0, "user", "z")],
        CONV.replace("conv_id bigint", "conv_id string"),
    )
    got = {r["query_id"]: r for r in prompt.prompt_rows(queries, hits(spark), talks).collect()}
    assert [tuple(m) for m in got[1]["prompt"]["history"]] == [("user", "a"), ("assistant", "b")]
    assert got[1]["num_contexts"] == 7 and len(got[1]["sources"]) == 5
    assert got[1]["prompt"]["human"].startswith("\nContext from ICC Judgment:\n\n**Source 1**")
    assert "\n\nLegal Question: why?\n\nPlease provide" in got[1]["prompt"]["human"]
    for i in (2, 3):
        assert got[i]["num_contexts"] == 0 and got[i]["sources"] == [] and got[i]["prompt"]["history"] == []
        assert fv.NO_CONTEXT in got[i]["prompt"]["human"]
    assert '"The Prosecutor v.' in got[1]["prompt"]["system"]
    alone = prompt.prompt_rows(queries, hits(spark)).where(F.size("prompt.history") > 0)
    assert alone.count() == 0


def said_rows(rows):
    """Messages of each conversation in order, by a loop."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], (r[1] is not None, r[1] or 0), r[2], r[3] or "")):
        if role != "system":
            out.setdefault(conv, []).append((turn, role, text or ""))
    return out


def test_full_history_as_rows(spark):
    rows = conversation_rows() + [(0, 3, "user", None), (0, None, "user", "first"), (0, 3, "assistant", "tie")]
    df = spark.createDataFrame(rows + [(None, 1, "user", "lost")], CONV)
    asked = [(1, "q", 0), (2, "q", 0), (3, "q", 4), (4, "q", 77), (5, "q", None)]
    queries = spark.createDataFrame(asked, "query_id int, query string, conversation_id bigint")
    said = said_rows(rows)
    for size in (1, 3, 4096):
        got = {(r.conv_id, r.position): r for r in prompt.message_rows(df, size).collect()}
        assert len(got) == sum(map(len, said.values()))
        for conv, messages in said.items():
            start = 0
            for i, (turn, role, text) in enumerate(messages, 1):
                r = got[conv, i]
                assert (r.turn, r.role, r.text, r.start) == (turn, role, text, start)
                start += len(role) + 2 + len(text) + 1
        for k in (None, 2):
            want = []
            for query_id, _, conv in asked:
                kept = said.get(conv, [])[0 if k is None else -2 * k :]
                start = 0
                for i, (_, role, text) in enumerate(kept, 1):
                    want.append((query_id, i, start, role, text))
                    start += len(role) + 2 + len(text) + 1
            got = prompt.history_rows(queries, df, k, size).collect()
            assert sorted(map(tuple, got)) == sorted(want)


def test_extents_name_the_rows_before(spark):
    df = spark.createDataFrame(conversation_rows(), CONV)
    rows = {(r.conv_id, r.turn): r for r in prompt.message_rows(df, 3).collect()}
    for r in prompt.history_extents(df, 5).collect():
        assert (r.history_messages + 1, r.history_chars) == (rows[r.conv_id, r.turn].position, rows[r.conv_id, r.turn].start)


def test_prompt_messages(spark):
    df = spark.createDataFrame([(1, i, "user" if i % 2 else "assistant", f"m{i}") for i in range(5)], CONV)
    queries = spark.createDataFrame([(1, "why?", 1), (2, None, None)], "query_id bigint, query string, conversation_id bigint")
    got = prompt.prompt_messages(queries, hits(spark).where("rank = 1"), df, system="be brief").orderBy("query_id", "position").collect()
    assert [(r.query_id, r.position, r.role) for r in got] == [
        (1, 0, "system"), (1, 1, "assistant"), (1, 2, "user"), (1, 3, "assistant"), (1, 4, "user"), (1, 5, "assistant"),
        (1, 6, "user"), (2, 0, "system"), (2, 1, "user"),
    ]
    assert got[0].text == "be brief" and "why?" in got[6].text and "text 1" in got[6].text
    assert fv.NO_CONTEXT in got[8].text
    last = prompt.prompt_messages(queries, hits(spark), df, k=1).where("query_id = 1").orderBy("position").collect()
    assert [r.text for r in last][1:3] == ["m3", "m4"] and last[-1].position == 3


def test_long_conversation_is_never_one_row(spark):
    """A conversation of a million turns: blocks of it are all that a task holds."""
    n = 1_000_000
    df = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("m"), "id").alias("text"),
    )
    queries = spark.createDataFrame([(1, "q", 1)], "query_id int, query string, conversation_id bigint")
    history = prompt.history_rows(queries, df)
    plan = history._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    digits = sum(len(str(i)) for i in range(n))
    got = history.agg(F.count("*"), F.max("position"), F.max(F.col("start") + F.char_length("role") + F.char_length("text") + 3)).first()
    assert tuple(got) == (n, n, digits + n + (4 + 9) * n // 2 + 3 * n)
