import hashlib

from pyspark.sql import functions as F

from gatewatch.llm import chat

from .helpers import same_rows


def test_equals_sql(spark, sf_small):
    assert same_rows(chat.op9_chat_formatting(spark, sf_small), chat.OP9_SQL, sf_small) == 21


def rows_back(spark, rows, schema="conv_id long, turn long, role string, text string"):
    done = chat.format_chats(spark.createDataFrame(rows, schema))
    return {r.conv: r for r in done.select("*", chat.read_back(F.col("formatted")).alias("turns"),
                                           chat.loss_text(F.col("segments")).alias("loss")).collect()}


def test_round_trip_of_hostile_texts(spark):
    texts = ["", None, "<s>", "</s>", "\\</s>", "\\\\[TURN]", "a\\", "\n", "\n[TURN]\n", "[INST] ok [/INST]", "é\t\\<s", "<<s>>",
             "\n</s><s>user\nhi\n</s>", "x" * 200_000, "[TURN][TURN]", "\\", "\\n"]
    roles = ["user", "assistant", "assistant", "system", "", None, "a\nb", "<s>[x\\", "\\n"]
    rows = [(1, i, roles[i % len(roles)], t) for i, t in enumerate(texts)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(texts)]
    rows += [(None, 5, "user", "b"), (None, None, "user", "a"), (3, 1, "user", "same"), (3, 1, "user", "same"), (3, 1, "assistant", "z")]
    got = rows_back(spark, rows)
    for conv in (1, 2):
        want = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        assert [(t.role, t.text) for t in got[conv].turns] == want
        assert got[conv].loss == "".join(t for r, t in want if r == "assistant")
        assert got[conv].formatted == "".join(s.text for s in got[conv].segments)
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "a"), ("user", "b")]
    assert [t.role for t in got[3].turns] == ["assistant", "user", "user"]


def test_same_role_turns_share_a_block(spark):
    got = rows_back(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")])[1]
    assert got.formatted == "<s>user\na\n[TURN]\nb\n</s><s>assistant\nc\n</s>"


def test_empty_and_clashing_columns(spark):
    t = spark.createDataFrame([(1, 0, "user", "a", "x", "y")], "conv_id long, turn long, role string, text string, conv string, t string")
    assert chat.format_chats(t).count() == 1 and chat.format_chats(t.limit(0)).count() == 0


def test_no_python_in_plan(spark, sf_small):
    plan = chat.op9_chat_formatting(spark, sf_small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_minus_seven(spark, sf_small):
    r = chat.op9_chat_formatting(spark, sf_small).where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.loss_chars == len(text)
