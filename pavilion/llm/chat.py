r"""Chat formatting with a grammar round trip.

The grammar of a formatted conversation::

    conversation := turn*
    turn         := "[INST]" text "[/INST]"          a user
                  | "<s>" text "</s>"                an assistant
                  | "[SYS]" text "[/SYS]"            the system
                  | "<r:HEX>" text "</r>"            any other role, its UTF-8 bytes in hex
    text         := characters without a control string

Control strings are cut out one after another, so the parser is deterministic and reads
the text once. A conversation is rendered as it is and parsed again; if the turns found
differ from the source, conflicting content is escaped: a backslash goes behind the first
character of each control string, or of one that already has backslashes there. Unescaping
takes one backslash away, so any text comes back. The escaped form is parsed and compared
as well, and an inequality raises an error.

Loss falls on assistant texts. Conversations are grouped by ``conv_id``; one conversation
is one value of the output, so its turns meet in one row.

Cases: a null text or role is the empty one; null identifiers form one conversation; turns
of an equal number go by role, then text, and those without a number come first; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"</?s>|\[/?INST\]|\[/?SYS\]|<r:[0-9A-F]*>|</r>"
CONFLICT = r"([<\[])(\\*)(?=/?s>|/?INST\]|/?SYS\]|r:[0-9A-F]*>|/r>)"
ESCAPED = r"([<\[])\\(\\*)(?=/?s>|/?INST\]|/?SYS\]|r:[0-9A-F]*>|/r>)"
# fixed values of the template
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
OTHER = ("<r:", "</r>")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONFLICT, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def opening(role: Column) -> Column:
    mark = F.concat(F.lit(OTHER[0]), F.hex(F.encode(role, "UTF-8")), F.lit(">"))
    for name, (start, _) in MARKS.items():
        mark = F.when(role == name, F.lit(start)).otherwise(mark)
    return mark


def closing(role: Column) -> Column:
    mark = F.lit(OTHER[1])
    for name, (_, end) in MARKS.items():
        mark = F.when(role == name, F.lit(end)).otherwise(mark)
    return mark


def rendered(turns: Column, text) -> Column:
    """The conversation as one string; ``text`` maps a turn's text."""
    parts = F.transform(
        turns, lambda t: F.concat(opening(t["role"]), text(t["text"]), closing(t["role"]))
    )
    return F.array_join(parts, "")


def role_of(mark: Column) -> Column:
    inner = F.substring(mark, 4, F.length(mark) - 4)
    role = F.decode(F.unhex(inner), "UTF-8")
    for name, (start, _) in MARKS.items():
        role = F.when(mark == start, F.lit(name)).otherwise(role)
    return role


def parsed(formatted: Column) -> Column:
    """The turns found in a formatted conversation, or null where the grammar is broken."""
    marks = F.regexp_extract_all(formatted, F.lit(f"({CONTROL})"), F.lit(1)).alias("mark")
    texts = F.slice(F.split(formatted, CONTROL, -1), 2, 1 << 30).alias("text")
    # a text follows each mark; those behind closing marks are empty. Both lists are made
    # once: inside a lambda they would be made again for each turn.
    openings = F.filter(F.arrays_zip(marks, texts), lambda _, i: i % 2 == 0)
    turn = F.transform(
        openings,
        lambda x: F.struct(role_of(x["mark"]).alias("role"), unescaped(x["text"]).alias("text")),
    )
    return F.when(
        formatted == "", F.array().cast("array<struct<role:string,text:string>>")
    ).when(F.size(marks) % 2 == 0, turn)


def conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and its ``turns`` in order."""
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    bare = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return grouped.select("conv_id", bare.alias("turns"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, and ``parsed``: the turns read back from it."""
    turns = F.col("turns")
    plain = conversations(rows).withColumn("formatted", rendered(turns, lambda t: t))
    same = parsed(F.col("formatted")).eqNullSafe(turns)
    tried = plain.withColumn(
        "formatted", F.when(same, F.col("formatted")).otherwise(rendered(turns, escaped))
    )
    checked = tried.withColumn("parsed", parsed(F.col("formatted")))
    lost = F.raise_error(F.concat(F.lit("no round trip: conversation "), F.col("conv_id")))
    return checked.select(
        "conv_id",
        "formatted",
        F.when(F.col("parsed").eqNullSafe(turns), F.col("parsed"))
        .otherwise(lost.cast("array<struct<role:string,text:string>>"))
        .alias("parsed"),
    )


def format_digests(rows: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations give back."""
    turns = F.col("parsed")
    whole = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.filter(turns, lambda t: t["role"] == "assistant")
    return (
        format_conversations(rows)
        .withColumn("loss", F.array_join(F.transform(loss, lambda t: t["text"]), ""))
        .select(
            "conv_id",
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(F.encode(F.array_join(whole, ""), "UTF-8"), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def with_probe(rows: DataFrame) -> DataFrame:
    """Conversation -1, whose texts hold control strings, beside the given ones."""
    text = "</s>[INST] ok [/INST]"
    probe = rows.sparkSession.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)],
        "conv_id long, turn long, role string, text string",
    )
    return rows.select("conv_id", "turn", "role", "text").unionByName(probe)


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, length(text) + len(regexp_extract_all(
      text, '[<\[]\\*(?:/?s>|/?INST\]|/?SYS\]|r:[0-9A-F]*>|/r>)'))
    + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 11
      ELSE 8 + 2 * strlen(role) END AS size
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""
