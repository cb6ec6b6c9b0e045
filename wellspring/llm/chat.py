"""Chat formatting with Spark expressions only.

Per conversation the turns are collected as structs, sorted, merged into
blocks of adjacent equal roles with array functions, and concatenated.
Template of a block (texts of one block keep their borders, so the
formatted text can be read back):

    <|im_start|>ROLE\\nTEXT[<|im_sep|>TEXT ...]<|im_end|>\\n

Control strings inside texts and roles are escaped reversibly: every ``<``
followed by n backslashes and ``|`` gets n + 1 backslashes, so ``<|`` never
occurs outside the template.  Line feeds inside roles become ``<|nl|>``.
The loss mask is kept per piece of the output: ``pieces`` is an array of
(text, loss) whose texts joined are ``formatted``; loss is true for exactly
the (escaped) assistant texts.

Defined cases: a null text or role is empty; turns are ordered by
(turn, role, text) with null turns last, so ties and repeated rows have one
order and each is kept; rows with a null conv_id form one conversation with a
null id; an empty table gives no rows.  One conversation becomes one string
and is therefore assembled in one task; that is the only grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|nl|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit(NEWLINE))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit(NEWLINE), F.lit("\n")))


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """(conv_id, pieces, formatted), one row per conversation."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).isNull().alias("last"),
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    # 1-based places where a block of equal roles begins, and one past the end.
    n = F.size("turns")
    begins = F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (i == 1) | (F.get("turns", i - 1)["role"] != F.get("turns", i - 2)["role"]),
    )
    blocks = sorted_turns.withColumn("begins", F.concat(begins, F.array(n + 1))).withColumn(
        "blocks",
        F.transform(
            F.slice("begins", 1, F.size("begins") - 1),
            lambda b, k: F.slice("turns", b, F.get("begins", k + 1) - b),
        ),
    )

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def block_pieces(block: Column) -> Column:
        role = F.get(block, F.lit(0))["role"]
        no = F.lit(False)
        texts = F.flatten(
            F.transform(
                block,
                lambda t, j: F.array(
                    piece(F.when(j == 0, F.concat(F.lit(START), escape_role(role), F.lit("\n"))).otherwise(F.lit(SEP)), no),
                    piece(escape(t["text"]), role == loss_role),
                ),
            )
        )
        return F.concat(texts, F.array(piece(F.lit(END), no)))

    pieces = blocks.select("conv_id", F.flatten(F.transform("blocks", block_pieces)).alias("pieces"))
    return pieces.withColumn("formatted", F.array_join(F.transform("pieces", lambda p: p["text"]), ""))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns, parsed from a formatted text."""
    blocks = F.split(formatted, r"<\|im_end\|>\n", -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns_of(block: Column) -> Column:
        inner = F.substr(block, F.lit(len(START) + 1))
        role = F.substring_index(inner, "\n", 1)
        texts = F.split(F.substr(inner, F.length(role) + 2), r"<\|im_sep\|>", -1)
        return F.transform(texts, lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(pieces: Column) -> Column:
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")


#: Conversation -1 of the query: both turns say the template's own marks.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op10_chat(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    out = format_chats(turns.unionByName(control))
    out = out.withColumn("_turns", read_back(F.col("formatted"))).withColumn("_loss", loss_text(F.col("pieces")))
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS LAST, role, text) AS i,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS LAST, role, text) AS before,
         len(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars,
         len(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>')) AS role_chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + CASE WHEN before IS NULL OR before <> role
                             THEN 12 + role_chars + 1 + 11 ELSE 10 END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""
