"""Chat formatting with a grammar round trip (native).

Template, one turn::

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Grammar of the parser: a formatted conversation is a sequence of such turns;
inside a turn no control string may occur, the role ends at the first line
break, and escapes are undone. A turn is first rendered as it is and parsed
back. Where the recovered turn differs from the source (a control string in a
text, a line break in a role, a text that looks like an escape), the turn is
rendered again with its content escaped. The whole conversation is then parsed
and compared with its source; a difference fails the job.

Escape: ``<`` + any number of backslashes + ``|`` gets one backslash more, so
no control string is left, and taking one away restores every text. A line
break in a role becomes the control string ``<|nl|>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.sources.tables import stage_table, table

START, END, ROLE_BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
LOSS_ROLE = "assistant"
_BETWEEN = r"<\|im_end\|>\n<\|im_start\|>"
_CONTROL = r"<\|im_(start|end)\|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit(ROLE_BREAK))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit(ROLE_BREAK), F.lit("\n")))


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a formatted conversation; null where
    the string is not in the grammar."""
    def turn(body):
        role = F.substring_index(body, "\n", 1)
        text = F.substr(body, F.char_length(role) + F.lit(2))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    framed = formatted.startswith(START) & formatted.endswith(END + "\n")
    inner = F.substr(formatted, F.lit(len(START) + 1),
                     F.char_length(formatted) - F.lit(len(START) + len(END) + 1))
    bodies = F.split(inner, _BETWEEN, -1)
    broken = F.exists(bodies, lambda b: b.rlike(_CONTROL) | ~F.contains(b, F.lit("\n")))
    return F.when(framed & ~broken, F.transform(bodies, turn))


def _turn_hash(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(role, F.lit("\n"), text), 256)


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, formatted, loss_spans`` from rows
    ``conv_id, turn, role, text``; other columns are ignored.

    ``loss_spans`` holds, in order, the code point range (start, end
    exclusive) of every assistant text inside ``formatted``, escapes included.
    A null role or text counts as empty; null ``conv_id`` is a conversation of
    its own; a null ``turn`` comes first. Rows tied on ``turn`` are ordered by
    role, then text, and repeated rows are repeated turns. No rows, no
    conversations.

    A conversation is one output record, so its turns meet in one task; the
    per-turn rendering, parsing and escaping run before that shuffle.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    raw = render_turn(F.col("role"), F.col("text"))
    back = parse(raw)
    same = F.coalesce((F.size(back) == 1) & (back[0]["role"] == F.col("role"))
                      & (back[0]["text"] == F.col("text")), F.lit(False))
    rows = rows.withColumn("same", same)
    out_role = F.when(F.col("same"), F.col("role")).otherwise(escape_role(F.col("role")))
    out_text = F.when(F.col("same"), F.col("text")).otherwise(escape(F.col("text")))
    rows = rows.select("conv_id", "turn", "role", "text", out_role.alias("out_role"), out_text.alias("out_text"),
                       _turn_hash(F.col("role"), F.col("text")).alias("source_hash"))
    rows = rows.withColumn("rendered", render_turn(F.col("out_role"), F.col("out_text")))

    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.char_length("rendered")).over(before), F.lit(0))
    first = begin + F.lit(len(START) + 1) + F.char_length("out_role")
    placed = rows.select("conv_id", "rendered", "source_hash",
                         F.row_number().over(order).alias("n"),
                         F.when(F.col("role") == LOSS_ROLE,
                                F.struct(first.alias("start"),
                                         (first + F.char_length("out_text")).alias("end"))).alias("span"))
    members = F.sort_array(F.collect_list(F.struct("n", "rendered", "source_hash", "span")))
    conv = placed.groupBy("conv_id").agg(members.alias("m")).select(
        "conv_id", F.size("m").cast("bigint").alias("n_turns"),
        F.array_join(F.col("m")["rendered"], "").alias("formatted"),
        F.filter(F.col("m")["span"], lambda s: s.isNotNull()).alias("loss_spans"),
        F.col("m")["source_hash"].alias("source"))
    recovered = F.transform(parse(F.col("formatted")), lambda t: _turn_hash(t["role"], t["text"]))
    checked = F.when(recovered.eqNullSafe(F.col("source")), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("chat round trip differs for conversation "),
                               F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))).cast("string"))
    return conv.select("conv_id", "n_turns", checked.alias("formatted"), "loss_spans")


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, joined without separators."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digest columns read back from formatted conversations."""
    turns = F.array_join(F.transform(parse(F.col("formatted")), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    return (formatted.select("conv_id", F.size(parse(F.col("formatted"))).cast("bigint").alias("n_turns"),
                             F.sha2(turns, 256).alias("turns_sha256"), loss.alias("loss"),
                             F.char_length("formatted").cast("bigint").alias("formatted_chars"))
                     .select("conv_id", "n_turns", "turns_sha256",
                             F.char_length("loss").cast("bigint").alias("loss_chars"),
                             F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations plus conversation -1, whose two texts are control
    strings; formatted, written, read back and parsed."""
    turns = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    control = F.lit(END + START + "assistant ok")
    odd = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
                                control.alias("text"))
    return conversation_digests(stage_table(format_conversations(turns.unionByName(odd)), "chat"))


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
c AS (
  SELECT *, regexp_matches(role || ' ' || text, '<\|im_(start|end)\|>|<\\+\|')
            OR contains(role, chr(10)) OR contains(role, '<|nl|>') AS conflict FROM t),
r AS (
  SELECT *, CASE WHEN conflict THEN replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>')
                 ELSE role END AS out_role,
            CASE WHEN conflict THEN regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') ELSE text END AS out_text
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length(out_role) + length(out_text) + 24) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""
