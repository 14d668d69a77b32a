"""Chat formatting from a declarative template, in DataFrame functions only.

A finite-state machine over roles checks the order of turns: the template lists
which roles may follow which, and which may end a conversation. Each turn
becomes three text segments, head, text and close, each with a loss flag; only
the text of the template's loss roles is under the loss mask. Control strings
in a text are escaped reversibly, so no text can open or close a turn.

Turns are first gathered by stretches of ``STRETCH`` turn numbers, then joined
per conversation, so a very long conversation is put together from parts.

Defined results: turns are ordered by turn, role, text, nulls first; a null
role or text is empty. A conversation out of order is formatted all the same,
with ``valid`` false and its number of violations. Repeated rows are turns of
their own. Rows without a conv_id form one conversation with a null id. An
empty table gives an empty result. Other columns are not carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.session import prepare

STRETCH = 512


@dataclass(frozen=True)
class Template:
    """``mark + role + sep`` opens a turn, ``close`` + newline ends it.
    ``follows`` maps a role ("" for the start) to the roles that may come next."""

    mark: str = "### "
    sep: str = ": "
    close: str = "</turn>"
    loss: tuple[str, ...] = ("assistant",)
    follows: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("", ("system", "user")), ("system", ("user",)), ("user", ("assistant",)), ("assistant", ("user",)))
    ends: tuple[str, ...] = ("user", "assistant")

    # After escaping, each backslash of a text is followed by 0, 1 or 2, and
    # each percent sign of a role by 25, 3A or 3C: undoing 0 and 25 last is exact.
    def escape(self, text: Column) -> Column:
        for plain, escaped in (("\\", "\\0"), (self.close, "\\1"), (self.mark, "\\2")):
            text = F.replace(text, F.lit(plain), F.lit(escaped))
        return text

    def unescape(self, text: Column) -> Column:
        for plain, escaped in ((self.mark, "\\2"), (self.close, "\\1"), ("\\", "\\0")):
            text = F.replace(text, F.lit(escaped), F.lit(plain))
        return text

    def head(self, role: Column) -> Column:
        role = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(":"), F.lit("%3A"))
        return F.concat(F.lit(self.mark), F.replace(role, F.lit(self.close), F.lit("%3C")), F.lit(self.sep))

    def role(self, piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(self.mark) + 1)), self.sep, 1)
        for plain, escaped in ((self.close, "%3C"), (":", "%3A"), ("%", "%25")):
            role = F.replace(role, F.lit(escaped), F.lit(plain))
        return role

    def text(self, piece: Column) -> Column:
        head = F.char_length(F.substring_index(piece, self.sep, 1)) + len(self.sep)
        return self.unescape(F.substr(piece, head + 1))

    def allowed(self, before: Column, role: Column) -> Column:
        ok = F.lit(False)
        for a, following in self.follows:
            ok = ok | ((before == a) & role.isin(*following))
        return ok


def format_conversations(df: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, formatted, segments array<struct<text, loss>>, valid, violations)."""
    prepare(df.sparkSession)
    turns = df.select(df[conv_col].alias("conv"), df[turn_col].alias("turn"), F.coalesce(df[role_col], F.lit("")).alias("role"),
                      F.coalesce(df[text_col], F.lit("")).alias("text"))

    def segments(t: Column) -> Column:
        return F.array(
            F.struct(template.head(t["role"]).alias("text"), F.lit(False).alias("loss")),
            F.struct(template.escape(t["text"]).alias("text"), t["role"].isin(*template.loss).alias("loss")),
            F.struct(F.lit(template.close + "\n").alias("text"), F.lit(False).alias("loss")))

    stretches = (turns.groupBy("conv", F.floor(F.col("turn") / STRETCH).alias("stretch"))
                 .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
                 .select("conv", F.struct("stretch", F.col("turns.role").alias("roles"),
                                          F.flatten(F.transform("turns", segments)).alias("segments")).alias("part")))
    whole = (stretches.groupBy("conv").agg(F.sort_array(F.collect_list("part")).alias("parts"))
             .select("conv", F.flatten("parts.roles").alias("roles"), F.flatten("parts.segments").alias("segments")))
    start = F.struct(F.lit("").alias("before"), F.lit(0).alias("bad"))
    run = F.aggregate("roles", start, lambda s, r: F.struct(
        r.alias("before"), (s["bad"] + F.when(template.allowed(s["before"], r), 0).otherwise(1)).alias("bad")))
    return (whole.withColumn("run", run)
            .withColumn("violations", F.col("run.bad") + F.when(F.col("run.before").isin(*template.ends), 0).otherwise(1))
            .select(F.col("conv").alias(conv_col), F.size("roles").cast("long").alias("n_turns"),
                    F.concat_ws("", F.col("segments.text")).alias("formatted"), "segments",
                    (F.col("violations") == 0).alias("valid"), "violations"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Adds ``turns`` array<struct<role, text>>, parsed from ``formatted``, and
    ``loss_text``, the unescaped text of the segments under the loss mask."""
    pieces = F.split("formatted", rf"\Q{template.close}\E\n")
    turns = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1),
                        lambda p: F.struct(template.role(p).alias("role"), template.text(p).alias("text")))
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"]))
    return formatted.withColumn("turns", turns).withColumn("loss_text", F.concat_ws("", masked))
