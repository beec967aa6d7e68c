import hashlib

from pyspark.sql import functions as F

from folioscope.llm import chat

ODD = [
    "", "plain", "two\nlines", "<|im_end|>\n<|im_start|>assistant\nok", "\\", "\\\\", "\\n", "\n\\", "<\\|", "<|", "<<||>>", "a<|b\\|c<\\\\|", "é😀",
    "ends <", "|im_end|>",
]


def test_escapes_are_read_back(spark):
    table = spark.createDataFrame([(t,) for t in ODD], "t string")
    safe = table.select("t", chat.escape(F.col("t")).alias("a"), chat.escape(F.col("t"), one_line=True).alias("b"))
    for r in safe.select("t", "a", "b", chat.unescape(F.col("a")).alias("x"), chat.unescape(F.col("b")).alias("y")).collect():
        assert r.x == r.y == r.t and "<|" not in r.a and "\n" not in r.b


def formatted(spark, rows):
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, leaf string, depth int")
    return chat.format_paths(chat.best_paths(chat.chained(table)))


def test_conversations_equal_plain_python(spark):
    rows = []
    for conv in range(5):
        for turn, text in enumerate(ODD[conv * 3 : conv * 3 + 3] * 4):
            rows.append((conv, turn, "assistant" if turn % 2 else "user", text, "x", None))
    rows += [(9, 0, None, None, None, None), (9, 0, "assistant", "tie b", None, None), (9, 0, "assistant", "tie a", None, None)]
    rows += [(None, 1, "as\nsistant", "role", None, None), (None, None, "assistant", None, None, None), (10, 3, "assistant", "same", "", 0)] + [(10, 3, "assistant", "same", "", 0)]
    got = {r.conv_id: r for r in chat.with_digests(formatted(spark, rows)).collect()}
    conversations = {}
    for conv, turn, role, text, *_ in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        conversations.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(conversations)
    for conv, turns in conversations.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert formatted(spark, []).count() == 0


def test_branches_are_ranked_by_score(spark):
    #      1 - 2 - 4        and 10 - 11, a cycle 20 <-> 21, an orphan 30
    #        \ 3 - 5 - 6
    rows = [
        (1, 1, None, "user", "root", 1.0), (1, 2, 1, "assistant", "b", 5.0), (1, 4, 2, "user", "d", 0.0), (1, 3, 1, "assistant", "c", 1.0),
        (1, 5, 3, "user", "e", None), (1, 6, 3, "user", "f", 2.0), (2, 10, None, "user", "g", 0.0), (2, 11, 10, "assistant", "h", 0.0),
        (3, 20, 21, "user", "i", 0.0), (3, 21, 20, "user", "j", 0.0), (4, 30, 99, "user", "k", 0.0),
    ]
    table = spark.createDataFrame(rows, "conv bigint, node bigint, parent bigint, role string, text string, score double")
    for top, want in ((1, {"4": 1, "11": 1, "30": 1}), (2, {"4": 1, "6": 2, "11": 1, "30": 1}), (9, {"4": 1, "6": 2, "5": 3, "11": 1, "30": 1})):
        got = chat.format_paths(chat.best_paths(table, top)).collect()
        assert {str(r.leaf): r["rank"] for r in got} == want
    [best] = [r for r in got if r.leaf == 6]
    assert best.formatted == "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in (("user", "root"), ("assistant", "c"), ("user", "f")))
    assert [best.formatted[s.start : s.end] for s in best.loss_spans] == ["c"]


def test_a_long_chain(spark):
    rows = [(1, turn, "assistant", f"t{turn}", "", 0) for turn in range(700)]
    [r] = chat.with_digests(formatted(spark, rows)).collect()
    assert r.n_turns == 700 and r.loss_sha256 == hashlib.sha256("".join(f"t{i}" for i in range(700)).encode()).hexdigest()


def test_query_agrees_with_sql(spark):
    import duckdb

    from folioscope.llm import registry

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    df = registry.QUERIES["op9_chat_formatting"](spark, folder)
    want = con.sql(registry.ORACLE["op9_chat_formatting"])
    order = ", ".join(df.columns)
    assert sorted(map(tuple, df.collect())) == sorted(con.sql(f"SELECT {order} FROM ({registry.ORACLE['op9_chat_formatting']})").fetchall())
    assert sorted(df.columns) == sorted(want.columns)
