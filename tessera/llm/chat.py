"""Chat formatting by relational steps only (operator 6).

Template: a turn is a role marker followed by its text, e.g.
``[INST]text[/INST]``. Adjacent turns of one role are one block: the first part
opens it, further parts carry a ``+`` marker, the last closes it:

    [SYS]be brief[/SYS][INST]hello[+INST]and again[/INST]<s>hi</s>

Other roles are ``[ROLE:name]text[/ROLE]``. Markers begin with ``[`` or ``<``.
In texts and role names ``\\`` is written ``\\e``, ``[`` as ``\\b`` and ``<`` as
``\\l``, so no text can hold a marker and splitting at ``[`` and ``<`` reads the
turns back exactly. The loss mask are the character ranges of assistant texts.

Turns are sorted by turn (then role and text); repeated rows stay. A null text
or role is empty. Rows without a conv_id are one conversation without id. One
conversation is one output row; its parts are laid out by a window inside the
conversation, so all steps are linear in its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Role -> (marker of the first part, of a further part, closing marker).
MARKERS = {
    "system": ("[SYS]", "[+SYS]", "[/SYS]"),
    "user": ("[INST]", "[+INST]", "[/INST]"),
    "assistant": ("<s>", "<+s>", "</s>"),
}
TRAINED = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\e"))
    return F.replace(F.replace(out, F.lit("["), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def escape_role(role: Column) -> Column:
    """Also ``]`` as ``\\c`` and ``>`` as ``\\g``: a role stands inside its marker."""
    return F.replace(F.replace(escape(role), F.lit("]"), F.lit("\\c")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    out = text
    for code, plain in (("\\l", "<"), ("\\b", "["), ("\\c", "]"), ("\\g", ">"), ("\\e", "\\")):
        out = F.replace(out, F.lit(code), F.lit(plain))
    return out


def _marker(role: Column, part: int) -> Column:
    """Opening (0), further (1) or closing (2) marker of a role."""
    other = (F.concat(F.lit("[ROLE:" if part == 0 else "[+ROLE:"), escape_role(role), F.lit("]")) if part < 2
             else F.lit("[/ROLE]"))
    out = F
    for name, own in MARKERS.items():
        out = out.when(role == name, own[part])
    return out.otherwise(other)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans array<struct<start, end>> (characters from 0)."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    opens = F.lag("role").over(turns).eqNullSafe(F.col("role")) == F.lit(False)
    closes = F.lead("role").over(turns).eqNullSafe(F.col("role")) == F.lit(False)
    role = F.col("role")
    parts = (rows.select("*", opens.alias("opens"), closes.alias("closes"), F.row_number().over(turns).alias("no"))
             .select("conv_id", "no", "role", F.col("opens"),
                     F.when(F.col("opens"), _marker(role, 0)).otherwise(_marker(role, 1)).alias("before"),
                     escape(F.col("text")).alias("body"),
                     F.when(F.col("closes"), _marker(role, 2)).otherwise(F.lit("")).alias("after"))
             .withColumn("size", F.length("before") + F.length("body") + F.length("after")))
    upto = Window.partitionBy("conv_id").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum("size").over(upto) - F.col("size") + F.length("before")
    laid = parts.withColumn("start", start)
    turn = F.struct("no", "role", F.concat("before", "body", "after").alias("piece"), "start",
                    (F.col("start") + F.length("body")).alias("end"))
    sorted_turns = F.array_sort(F.collect_list(turn))
    return (laid.groupBy("conv_id").agg(sorted_turns.alias("turns"))
            .select("conv_id",
                    F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                    F.transform(F.filter("turns", lambda t: t["role"] == TRAINED),
                                lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss_spans")))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text, opens>> of the turns in a formatted string."""
    segments = F.filter(F.split(formatted, r"[\[<]", -1), lambda s: (s != "") & ~s.startswith("/"))
    end = lambda s: F.least(*[  # noqa: E731  where the marker ends: its first ] or >
        F.when(F.instr(s, c) > 0, F.instr(s, c)).otherwise(F.length(s) + 1) for c in "]>"])

    def turn(s: Column) -> Column:
        name = F.substring(s, F.lit(1), end(s) - 1)
        further = name.startswith("+")
        bare = F.when(further, F.substring(name, F.lit(2), F.length(name))).otherwise(name)
        role = F
        for known, own in MARKERS.items():
            role = role.when(bare == own[0][1:-1], known)
        role = role.otherwise(unescape(F.substring(bare, F.lit(6), F.length(bare))))
        return F.struct(role.alias("role"), unescape(F.substring(s, end(s) + 1, F.length(s))).alias("text"),
                        (~further).alias("opens"))

    return F.transform(segments, turn)


def masked(formatted: Column, spans: Column) -> Column:
    """array<string>: the texts under the loss mask, unescaped."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Contract of op6: the conversations and conversation -1, formatted and read back.
    If the table holds a conversation -1, the two added rows are turns 0 and 1 of it too."""
    probe = "</s>[INST] ok [/INST]"
    extra = conversations.sparkSession.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    own = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    out = (format_conversations(own.unionByName(extra))
           .select("conv_id", "formatted", "loss_spans", read_back(F.col("formatted")).alias("turns")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(masked(F.col("formatted"), F.col("loss_spans")), "")
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (
  SELECT *, row_number() OVER w AS no, lag(role) OVER w IS DISTINCT FROM role AS opens,
    lead(role) OVER w IS DISTINCT FROM role AS closes FROM c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
z AS (
  SELECT *, length(text) * 2 - length(regexp_replace(text, '[\\<\[]', '', 'g')) AS body,
    CASE role WHEN 'system' THEN 5 WHEN 'user' THEN 6 WHEN 'assistant' THEN 3 ELSE
      7 + length(role) * 2 - length(regexp_replace(role, '[\\<>\[\]]', '', 'g')) END AS mark,
    CASE role WHEN 'system' THEN 6 WHEN 'user' THEN 7 WHEN 'assistant' THEN 4 ELSE 7 END AS shut FROM n)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY no)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY no) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(body + mark + CASE WHEN opens THEN 0 ELSE 1 END + CASE WHEN closes THEN shut ELSE 0 END) AS BIGINT) AS formatted_chars
FROM z GROUP BY conv_id
"""
