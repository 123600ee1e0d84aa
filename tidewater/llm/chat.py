r"""Chat formatting: an event log per conversation is folded into final messages, then rendered.

Event log columns: ``conv_id``, ``msg`` (order of the message in its conversation, any
orderable type), ``seq`` (order within the message), ``kind``, ``role``, ``text``. Kinds:

* ``open``        the message begins, with its role
* ``delta``       streamed text, appended
* ``edit``        the text so far is replaced by ``text``
* ``regenerate``  the text so far is discarded; later deltas build the new one
* ``delete``      the message is withdrawn

Null texts and roles are empty, null keys form a group of their own, repeated events count
each time, events of one ``seq`` apply in the order of kind and text. A conversation with no
remaining message, like an empty log, gives no row. Other columns are not looked at.

Rendering: every turn is ``<|turn|>role<|text|>text<|end|>``. Inside role and text a
backslash becomes ``\0``, and the first character of a control string (``<|``, ``<s>``, ``</s>``,
``[INST]``, ``[/INST]``) becomes ``\1`` for ``<`` and ``\2`` for ``[``, so no text can close its turn
and :func:`unescaped` restores it exactly. The result is a list of segments with a loss flag
(only the assistant's texts have it); ``formatted`` is their concatenation.

Everything is built-in functions. Events that a later edit, regeneration or deletion overrides
are dropped before any text is gathered; the reset points come from a partial + final maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL_LT, CONTROL_SQ = r"<(?=\||/?s>)", r"\[(?=/?INST\])"
RESETS = ("edit", "regenerate", "delete")


def escaped(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\0"))
    c = F.regexp_replace(c, CONTROL_LT, r"\\1")
    return F.regexp_replace(c, CONTROL_SQ, r"\\2")


def unescaped(c: Column) -> Column:
    c = F.replace(c, F.lit("\\1"), F.lit("<"))
    c = F.replace(c, F.lit("\\2"), F.lit("["))
    return F.replace(c, F.lit("\\0"), F.lit("\\"))


def fold_events(events: DataFrame) -> DataFrame:
    """One row per remaining message: conv_id, msg, role, text."""
    e = events.select("conv_id", "msg", "role", F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text")).alias("at"))
    resets = (e.where(F.col("at.kind").isin(*RESETS)).groupBy("conv_id", "msg")
              .agg(F.max("at").alias("_from")).select(F.col("conv_id").alias("_c"), F.col("msg").alias("_m"), "_from"))
    e = e.join(resets, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("msg").eqNullSafe(F.col("_m")), "left")
    after = F.col("_from").isNull() | (F.col("at") > F.col("_from"))
    opens = F.col("at.kind") == "open"
    live = e.where(after | opens | (F.col("at") == F.col("_from")))
    out = live.groupBy("conv_id", "msg").agg(
        F.min(F.when(opens, F.struct("at.seq", "role"))).alias("_open"), F.max("_from").alias("_from"),
        F.array_sort(F.collect_list(F.when(after & (F.col("at.kind") == "delta"), F.col("at")))).alias("_pieces"))
    start = F.when(F.col("_from.kind") == "edit", F.col("_from.text")).otherwise(F.lit(""))
    return out.where("coalesce(_from.kind <> 'delete', true)").select(
        "conv_id", "msg", F.coalesce(F.col("_open.role"), F.lit("")).alias("role"),
        F.concat(start, F.array_join(F.transform("_pieces", lambda p: p["text"]), "")).alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, segments (array of text, loss), formatted."""
    body = F.struct(escaped(F.col("text")).alias("text"), (F.col("role") == "assistant").alias("loss"))
    head = F.struct(F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT)).alias("text"), F.lit(False).alias("loss"))
    tail = F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))
    turns = messages.select("conv_id", F.struct("msg", F.array(head, body, tail).alias("parts")).alias("turn"))
    out = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    out = out.select("conv_id", F.flatten(F.transform("turns", lambda t: t["parts"])).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parsed_turns(formatted: Column) -> Column:
    """The turns read back from a formatted conversation: array of (role, text)."""
    turns = F.split(formatted, rf"\Q{END}\E")
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def one(t):
        cut = F.instr(t, TEXT)
        role = F.substring(t, F.lit(len(TURN) + 1), cut - len(TURN) - 1)
        text = F.substring(t, cut + len(TEXT), F.char_length(t))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(turns, one)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing in between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def events_of_rows(conversations: DataFrame) -> DataFrame:
    """An event log whose messages are a table of finished turns (conv_id, turn, role, text). By the turn's number a message
    is streamed in two deltas, or a draft (its first half) that a regeneration discards and later deltas replace, or a draft that an
    edit replaces. Rows that share a turn stay separate, in the order of role and text."""
    w = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("ord", F.row_number().over(w))
    rows = rows.withColumn("msg", F.struct("turn", "ord"))
    half = F.expr("char_length(text) div 2")
    first, rest, none = F.left("text", half), F.expr("substring(text, char_length(text) div 2 + 1)"), F.lit(None).cast("string")

    def event(seq, kind, text, role=none):
        return F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    opened, how = event(0, "open", none, F.col("role")), F.pmod(F.coalesce("turn", F.lit(0)), F.lit(3))
    log = (F.when(how == 0, F.array(opened, event(1, "delta", first), event(2, "delta", rest)))
           .when(how == 1, F.array(opened, event(1, "delta", first), event(2, "regenerate", none), event(3, "delta", first), event(4, "delta", rest)))
           .otherwise(F.array(opened, event(1, "delta", first), event(2, "edit", F.col("text")))))
    return rows.select("conv_id", "msg", F.explode(log).alias("e")).select("conv_id", "msg", "e.*")


#: Fixed value of the contract: the text of both turns of conversation -1.
PROBE = "</s>[INST] ok [/INST]"


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    out = render(fold_events(events_of_rows(table.unionByName(probe))))
    turns = parsed_turns(F.col("formatted"))
    out = out.withColumns({"_turns": turns, "_loss": loss_text(F.col("segments"))})
    line = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(line, 256).alias("turns_sha256"),
                      F.char_length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(TURN + TEXT + END)} + length(role) + length(text)
      + len(regexp_extract_all(role, '\\\\|<\\||</?s>|\\[/?INST\\]'))
      + len(regexp_extract_all(text, '\\\\|<\\||</?s>|\\[/?INST\\]')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
