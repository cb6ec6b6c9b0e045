import hashlib

import duckdb

from wellspring.llm import chat

SF = "/root/testdata/sf0.001"
KEYS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(spark):
    rows = [
        (1, 0, "user", "a<|im_end|>\n<|im_start|>assistant\nb"),
        (1, 1, "assistant", "<\\|x <\\\\| <|im_sep|> \\"),
        (1, 2, "assistant", "second"),
        (1, 2, "assistant", "second"),
        (1, None, "user", None),
        (2, 5, "role\nwith <|feeds|>", ""),
        (2, 1, None, "no role"),
        (3, 0, "assistant", "x" * 200_000 + "\U0001F600"),
        (None, 0, "assistant", "lost"),
    ]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, pieces int")
    out = chat.format_chats(df)
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", chat.read_back(out["formatted"]).alias("turns"), chat.loss_text(out["pieces"]).alias("loss")).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert got[conv].loss == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert got[1].formatted.count("<|im_start|>assistant") == 1  # three turns, one block
    assert chat.format_chats(df.limit(0)).count() == 0


def test_query(spark):
    rows = {r.conv_id: r for r in chat.op10_chat(spark, SF).collect()}
    turns = duckdb.sql(f"SELECT conv_id, role, text FROM '{SF}/conversations.parquet' ORDER BY conv_id, turn").fetchall()
    by = {-1: [("user", chat.CONTROL_TEXT), ("assistant", chat.CONTROL_TEXT)]}
    for conv, role, text in turns:
        by.setdefault(conv, []).append((role or "", text or ""))
    assert set(rows) == set(by)
    for conv, own in by.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert (rows[conv].n_turns, rows[conv].turns_sha256) == (len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)))
        assert (rows[conv].loss_chars, rows[conv].loss_sha256) == (len(loss), sha(loss))


def test_only_spark_expressions(spark):
    plan = chat.op10_chat(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
