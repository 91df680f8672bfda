"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by (turn, role,
text); runs of turns with the same role become one block:

    <s>ROLE NEWLINE TEXT [NEWLINE [TURN] NEWLINE TEXT]... NEWLINE </s>

``[TURN]`` stands between the turns that were merged, so the turns can be read
back. A control string inside a text gets one backslash before it and before the
backslashes that already precede it; every mark of the template follows a start
of text, a newline or another mark, never a backslash. In a role the backslash,
newline, ``<`` and ``[`` are spelt out. Both are undone exactly.

The result of a conversation is a list of segments (text, loss): their
concatenation is the formatted text, and the loss mask covers the segments with
loss, which are the assistant's texts and nothing between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE, TURN = "<s>", "\n</s>", "\n[TURN]\n"
CONTROL = r"(?:</?s>|\[/?INST\]|\[TURN\])"
# What a role cannot hold, and how it is spelt; the backslash comes first.
ROLE_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("<", "\\l"), ("[", "\\k"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*{CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*{CONTROL})", "$1")


def escape_role(role: Column) -> Column:
    for a, b in ROLE_ESCAPES:
        role = F.replace(role, F.lit(a), F.lit(b))
    return role


def unescape_role(role: Column) -> Column:
    for a, b in reversed(ROLE_ESCAPES):
        role = F.replace(role, F.lit(b), F.lit(a))
    return role


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """(conv, segments, formatted): one row per conversation.

    Null text or role: empty. A null turn sorts first, null conversation ids are
    one conversation, repeated rows are turns of their own, other columns are
    not read, and an empty table gives no rows. The output of a conversation is
    one row, so its turns meet in one task; all steps on them are linear."""
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    starts = sorted_turns.withColumn(
        "starts", F.expr("filter(sequence(1, size(t)), i -> i = 1 or t[i - 1].role <> t[i - 2].role)"))
    blocks = starts.select("conv", F.expr("""
        transform(starts, (s, k) -> slice(t, s, coalesce(get(starts, k + 1), size(t) + 1) - s))""").alias("blocks"))

    def segments(block: Column) -> Column:
        role = F.element_at(block, 1)["role"]
        head = F.struct(F.concat(F.lit(OPEN), escape_role(role), F.lit("\n")).alias("text"), F.lit(False).alias("loss"))
        tail = F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss"))
        between = F.struct(F.lit(TURN).alias("text"), F.lit(False).alias("loss"))
        inner = F.flatten(F.transform(block, lambda t, i: F.when(
            i == 0, F.array(F.struct(escape(t["text"]).alias("text"), (role == trained_role).alias("loss")))).otherwise(
            F.array(between, F.struct(escape(t["text"]).alias("text"), (role == trained_role).alias("loss"))))))
        return F.concat(F.array(head), inner, F.array(tail))

    done = blocks.select("conv", F.flatten(F.transform("blocks", segments)).alias("segments"))
    return done.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text."""
    blocks = F.slice(F.split(formatted, r"(?<!\\)<s>", -1), 2, 1 << 30)

    def turns(block: Column) -> Column:
        role = unescape_role(F.substring_index(block, "\n", 1))
        at = F.instr(block, F.lit("\n"))
        body = F.substr(block, at + 1, F.length(block) - at - len(CLOSE))
        return F.transform(F.split(body, r"\n\[TURN\]\n", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, read back from the output, of all ``conversations`` and of -7."""
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    done = format_chats(chats.unionByName(extra))
    read = done.select("conv", "formatted", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    return read.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
        .alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP9_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *, length(regexp_replace(text, '(</?s>|\[/?INST\]|\[TURN\])', '\1#', 'g')) AS n,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS DISTINCT FROM role AS opens
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
    CAST(sum(n) + sum(CASE WHEN opens THEN length(role) + 9 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""
