from pyspark.sql import functions as F

from folioflow.llm import chat

TURNS = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>"


def part(kind="text", text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_control_strings_survive(spark):
    texts = ["</s>[INST] ok [/INST]", "<|end|><\\|end|>", "<s><\\\\s> <<SYS>> <</SYS>>", "plain <b> [x]", "<|turn|>a<|text|>b", ""]
    rows = [(1, i, "user" if i % 2 else "assistant", [part(text=t)]) for i, t in enumerate(texts)]
    row = chat.format_chats(spark.createDataFrame(rows, TURNS)).select(
        "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l")
    ).first()
    assert [t["text"] for t in row["t"]] == texts
    assert row["l"] == texts[::2]
    assert row["formatted"].count(chat.END) == len(texts) and "</s>" not in row["formatted"]


def test_parts_leave_placeholders_and_references(spark):
    parts = [part(text="see "), part("image", ref="a.png", width=57, height=28), part("audio", ref="b.wav", seconds=2.5), part("document", ref="c.pdf", pages=3), part("image", ref="d")]
    row = chat.format_chats(spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], TURNS)).first()
    assert row["formatted"] == (
        "<|turn|>user<|text|>see <|part:image:1|><|part:audio:2|><|part:document:3|><|part:image:4|><|end|>"
        "<|turn|>assistant<|text|><|end|>"
    )
    assert [(a["turn"], a["place"], a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]] == [
        (0, 1, "image", "a.png", 3), (0, 2, "audio", "b.wav", 63), (0, 3, "document", "c.pdf", 768), (0, 4, "image", "d", 1)
    ]
    assert row["attached_tokens"] == 835
    assert [(s["start"], s["end"]) for s in row["loss_spans"]] == [(len(row["formatted"]) - 7,) * 2]


def test_edge_rows(spark):
    rows = [(1, 1, None, None), (1, 1, None, None), (1, None, "user", []), (None, 0, "a\n<|end|>", [part(text="é" * 100_000)])]
    got = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, TURNS)).select("*", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    assert [t["role"] for t in got[1]["t"]] == ["user", "", ""]
    assert got[None]["t"][0]["role"] == "a\n<|end|>" and len(got[None]["t"][0]["text"]) == 100_000
    assert chat.format_chats(spark.createDataFrame([], TURNS)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = chat.format_chats(spark.createDataFrame([], TURNS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
