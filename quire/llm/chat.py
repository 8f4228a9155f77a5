"""Chat formatting by a finite-state machine over roles.

A declarative template names the marks of a turn, the wrapping of each role,
and the machine: for each state the roles that may follow and the states they
lead to, and the states on whose entry the text is trained on. A role always
leads to the same state, so the state behind a turn follows from the turn
before: the machine runs over all turns of a conversation at once, in linear
time. Each turn emits three segments of text; those of the body carry the loss
flag of the state that the turn enters. Joined, the segments are the formatted
text. Only DataFrame functions are used.

Control strings inside texts are escaped reversibly: in every control string,
with any number of backslashes after its first character, one more backslash
is put after that character; reading back takes one away. An escaped text
holds no control string, so the end mark splits turns without doubt. Role
names are URL-encoded in the turn's first line.

Defined results: a NULL text or role counts as empty; unknown roles are
formatted without wrapping and make the conversation invalid (state
``refused``, ``valid`` false), as does any move that the machine lacks; such
turns are formatted and flagged as anywhere else, and nothing is dropped. Turns
with equal numbers (NULL first) are ordered by role, then text; repeated rows
are repeated turns; rows with a NULL conversation id form one conversation;
an empty table gives no rows; other columns are not read.

A conversation is one record: its digest needs all its turns in order, so
they meet in one row. Turns are rendered before they are gathered.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    begin: str = "<s>"
    end: str = "</s>"
    wraps: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("", "")})
    control: tuple = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    start: str = "empty"
    moves: dict = field(default_factory=lambda: {
        "empty": {"system": "briefed", "user": "asked"}, "briefed": {"user": "asked"},
        "asked": {"assistant": "answered"}, "answered": {"user": "asked"}})
    accepted: tuple = ("asked", "answered")
    trained: tuple = ("answered",)

    def __post_init__(self):
        self.enters()

    def enters(self) -> dict[str, str]:
        """The state that each role leads to."""
        out: dict[str, str] = {}
        for nexts in self.moves.values():
            for role, after in nexts.items():
                if out.setdefault(role, after) != after:
                    raise ValueError(f"role {role!r} leads to {out[role]!r} and to {after!r}")
        return out

    def _mark(self, slashes: str) -> str:
        heads = "".join(sorted({re.escape(c[0]) for c in self.control}))
        rests = "|".join(sorted((re.escape(c[1:]) for c in self.control), key=len, reverse=True))
        return rf"([{heads}]){slashes}({rests})"

    def escape(self, c: Column) -> Column:
        return F.regexp_replace(c, self._mark(r"(\\*)"), r"$1\\$2$3")

    def unescape(self, c: Column) -> Column:
        return F.regexp_replace(c, self._mark(r"\\(\\*)"), "$1$2$3")

    def wrap(self, role: Column, side: int) -> Column:
        out = F.lit("")
        for name, pair in self.wraps.items():
            out = F.when(role == name, F.lit(pair[side])).otherwise(out)
        return out


def format_chats(df: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, segments array<struct<text, loss>>, formatted,
    state, valid), one row per conversation."""
    role = F.coalesce(F.col(role_col), F.lit(""))
    turns = df.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    entered = F.lit(None)
    for name, state in template.enters().items():
        entered = F.when(F.col("role") == name, F.lit(state)).otherwise(entered)
    rendered = turns.select("conv_id", F.struct(
        "turn", "role", "text",
        F.concat(F.lit(template.begin), F.url_encode("role"), F.lit("\n"), template.wrap(F.col("role"), 0)).alias("head"),
        template.escape(F.col("text")).alias("body"),
        F.concat(template.wrap(F.col("role"), 1), F.lit(template.end)).alias("tail"),
        entered.alias("entered"), F.coalesce(entered.isin(*template.trained), F.lit(False)).alias("loss")).alias("turn"))
    gathered = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def segment(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    allowed = F.array(*[F.lit(f"{state}\n{name}") for state, nexts in template.moves.items() for name in nexts])
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        segment(t["head"], no), segment(t["body"], t["loss"]), segment(t["tail"], no))))

    def refused(turn: Column, place: Column) -> Column:
        before = F.when(place == 0, F.lit(template.start)).otherwise(F.get(F.col("turns"), place - 1)["entered"])
        return ~F.coalesce(F.array_contains(allowed, F.concat(before, F.lit("\n"), turn["role"])), no)

    state = F.when(F.array_contains(F.transform("turns", refused), True), F.lit("refused")) \
        .otherwise(F.element_at("turns", -1)["entered"])
    return (gathered.select("conv_id", F.size("turns").cast("long").alias("n_turns"), segments.alias("segments"),
                            state.alias("state"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
            .withColumn("valid", F.col("state").isin(*template.accepted)))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """array<struct<role, text>> read from a formatted text."""
    pieces = F.split(formatted, re.escape(template.end))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)  # behind the last end mark there is nothing

    def turn(piece: Column) -> Column:
        line = F.substring_index(piece, "\n", 1)
        role = F.url_decode(F.substring(line, F.lit(len(template.begin) + 1), F.length(line)))
        body = F.substring(piece, F.length(line) + 2, F.length(piece))
        return F.struct(role.alias("role"), body.alias("body"))

    def bare(t: Column) -> Column:
        head, tail = F.length(template.wrap(t["role"], 0)), F.length(template.wrap(t["role"], 1))
        return F.struct(t["role"].alias("role"), template.unescape(
            F.substring(t["body"], head + 1, F.length(t["body"]) - head - tail)).alias("text"))

    return F.transform(F.transform(pieces, turn), bare)


def trained_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: template.unescape(s["text"])), "")
