"""Chat formatting from a declarative template, in SQL functions only.

A finite-state machine over the roles validates the turn order. Each turn becomes
three text segments (header, content, footer), each with its own loss flag, as
the template says. Control strings inside roles and texts are escaped so that
only the template can write them, and unescaping gives back the exact text:
every escape is a backslash and one letter, and a backslash itself is escaped
first, so no two texts share an escaped form.

Null texts and null roles count as empty. Turns are ordered by turn (null
first), then role, then text; repeated rows are repeated turns. A null conv_id
is a conversation of its own. A conversation whose order the machine refuses is
still formatted, with ``valid`` false and the index of the first wrong turn. An
empty table gives no rows. One conversation is one output value and so has to
fit into a task; the table as a whole need not.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_lake.llm.common import table


@dataclass(frozen=True)
class Template:
    """What marks a turn, what is learned, which orders of roles are allowed."""

    turn: str = "<|turn|>"
    body: str = "<|body|>"
    end: str = "<|end|>\n"
    #: Strings that texts must not contain: the template's own and those of other formats.
    control: tuple[str, ...] = (
        "<|turn|>", "<|body|>", "<|end|>", "<|endoftext|>", "<|im_start|>", "<|im_end|>",
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )
    #: Roles whose content counts for the loss; headers and footers never do.
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("assistant",)
    #: state -> roles that may follow; the new state is the role.
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    @property
    def letters(self) -> dict[str, str]:
        """The escape letter of each first character of a control string."""
        first = sorted({c[0] for c in self.control})
        return dict(zip(first, "abcdfghijklmno"))


DEFAULT = Template()


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """Breaks every control string and keeps the rest as it is."""
    text = F.replace(text, F.lit("\\"), F.lit("\\e"))
    for control in template.control:
        text = F.replace(text, F.lit(control), F.lit("\\" + template.letters[control[0]] + control[1:]))
    return text


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    for char, letter in template.letters.items():
        text = F.replace(text, F.lit("\\" + letter), F.lit(char))
    return F.replace(text, F.lit("\\e"), F.lit("\\"))


def _first_wrong(roles: Column, template: Template) -> Column:
    """Index of the first turn the machine refuses; the number of turns if it ends
    in a state that is not accepting; null if all is well."""
    allowed = [f"{state}>{role}" for state, after in template.follows.items() for role in after]

    def step(seen: Column, role: Column) -> Column:
        move = F.concat(seen["state"], F.lit(">"), role)
        good = seen["wrong"].isNull() & move.isin(allowed)
        return F.struct(
            F.when(good, role).otherwise(seen["state"]).alias("state"),
            F.when(good | seen["wrong"].isNotNull(), seen["wrong"]).otherwise(seen["at"]).alias("wrong"),
            (seen["at"] + 1).alias("at"),
        )

    start = F.struct(
        F.lit(template.start).alias("state"), F.lit(None).cast("int").alias("wrong"), F.lit(0).alias("at")
    )
    return F.aggregate(
        roles,
        start,
        step,
        lambda seen: F.when(seen["wrong"].isNotNull(), seen["wrong"]).when(
            ~seen["state"].isin(list(template.accepting)), seen["at"]
        ),
    )


def render(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """(conv_id, segments, formatted, valid, wrong_turn) for every conversation.

    segments is an array of (text, loss); formatted is their concatenation.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("turns"))

    def segments(turn: Column) -> Column:
        parts = (
            (F.concat(F.lit(template.turn), escape(turn["role"], template), F.lit(template.body)), F.lit(False)),
            (escape(turn["text"], template), turn["role"].isin(list(template.learned))),
            (F.lit(template.end), F.lit(False)),
        )
        return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts])

    return turns.select(
        "conv_id",
        F.flatten(F.transform("turns", segments)).alias("segments"),
        _first_wrong(F.transform("turns", lambda t: t["role"]), template).alias("wrong_turn"),
    ).select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.col("wrong_turn").isNull().alias("valid"),
        "wrong_turn",
    )


def turns_of(formatted: Column, template: Template = DEFAULT) -> Column:
    """The (role, text) of every turn, parsed from the formatted string."""
    pieces = F.split(formatted, _quoted(template.turn))

    def parse(piece: Column) -> Column:
        sides = F.split(piece, _quoted(template.body), 2)
        text = F.substring(sides[1], 1, F.length(sides[1]) - len(template.end))
        return F.struct(
            unescape(sides[0], template).alias("role"), unescape(text, template).alias("text")
        )

    return F.transform(F.slice(pieces, 2, F.size(pieces)), parse)


def learned_text(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"], template)), "")


def _quoted(control: str) -> str:
    return "\\Q" + control + "\\E"


def digests(rendered: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """What the output says when read back: turns, learned text, lengths."""
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return (
        rendered.select("*", turns_of(F.col("formatted"), template).alias("turns"))
        .select("*", learned_text(F.col("segments"), template).alias("learned"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(told, 256).alias("turns_sha256"),
            F.length("learned").cast("long").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
            "wrong_turn",
        )
    )


#: A conversation whose texts hold control strings; it goes through with all others.
PROBE_ID, PROBE = -7, "</s>[INST] ok [/INST]"


def with_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return rows.union(probe)
