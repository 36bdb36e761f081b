"""Chat formatting with a grammar round trip (DataFrame functions only).

Grammar of the output::

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" body "<|im_end|>" "\\n"

``role`` holds no line break, ``body`` neither mark. The parser is deterministic: it
splits at the start mark, takes the role up to the first line break and the body up to the first
end mark, and wants nothing but a line break behind that.

Each turn is first rendered as it is and parsed back. Where the parser does not give back the same
role and text, the conflicting content is escaped (text: one more backslash inside each
``<\\...|``; role: percent codes), and the result is parsed again. That second rendering always
comes back, since escaped text cannot hold "<|" and an escaped role neither "<" nor a line break;
``round_trip`` reports the comparison of the
whole conversation.

Cases: null text or role = empty; rows are ordered by (turn, role, text), null turn first, repeated
rows are all kept; a null conv_id is a conversation of its own; empty table = no rows; other columns
are ignored. A conversation becomes one row, since its formatted text is one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    c = F.replace(c, F.lit("%"), F.lit("%25"))
    c = F.replace(c, F.lit("\n"), F.lit("%0A"))
    return F.replace(c, F.lit("<"), F.lit("%3C"))


def unescape_role(c: Column) -> Column:
    c = F.replace(c, F.lit("%3C"), F.lit("<"))
    c = F.replace(c, F.lit("%0A"), F.lit("\n"))
    return F.replace(c, F.lit("%25"), F.lit("%"))


def render(role: Column, body: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), body, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """Array of (role, text) read from formatted text; null where the grammar is broken."""
    parts = F.split(formatted, r"<\|im_start\|>", -1)

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        rest = F.substr(p, F.char_length(head) + 2)
        body = F.substring_index(rest, END, 1)
        fits = (F.contains(p, F.lit("\n"))) & (rest == F.concat(body, F.lit(END + "\n")))
        return F.when(fits, F.struct(unescape_role(head).alias("role"), unescape_text(body).alias("text")))

    turns = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)
    return F.when((F.get(parts, F.lit(0)) == "") & ~F.exists(turns, lambda t: t.isNull()), turns)


def format_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Rendered turns: conv_id, turn, role, text, rendered; escaped only where the parser needs it."""
    t = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    plain = render(F.col("role"), F.col("text"))
    same = parse(plain) == F.array(F.struct("role", "text"))
    # without "<" and "%" in the role, a line break in it or "<" before "|" the parser need not run
    risky = F.col("role").rlike(r"[<%\n]") | F.col("text").rlike(r"<\\*\|")
    safe = render(escape_role(F.col("role")), escape_text(F.col("text")))
    return t.withColumn("rendered", F.when(risky, F.when(F.coalesce(same, F.lit(False)), plain).otherwise(safe))
                        .otherwise(plain))


def format_conversations(rows: DataFrame, loss_role: str = "assistant", **names: str) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (0-based start, length in code points
    of every body of ``loss_role``), round_trip (the parsed turns equal the source)."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = format_turns(rows, **names)
    t = t.withColumn("at", F.coalesce(F.sum(F.char_length("rendered"))
                                      .over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    head = F.char_length(F.substring_index("rendered", "\n", 1)) + 1
    span = F.struct((F.col("at") + head).alias("start"),
                    (F.char_length("rendered") - head - len(END) - 1).alias("length"))
    g = t.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "role", "text", "rendered"))).alias("turns"),
        F.sort_array(F.collect_list(F.when(F.col("role") == loss_role, span))).alias("loss_spans"))
    g = g.withColumn("formatted", F.array_join(F.transform("turns", lambda x: x["rendered"]), ""))
    source = F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return g.select("conv_id", "formatted", "loss_spans",
                    F.coalesce(parse(F.col("formatted")) == source, F.lit(False)).alias("round_trip"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the parser and the loss spans give back from formatted conversations."""
    turns = parse(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape_text(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return (formatted.select("conv_id", "formatted", "round_trip", turns.alias("turns"), said.alias("said"),
                             loss.alias("loss"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2("said", 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars"), "round_trip"))
