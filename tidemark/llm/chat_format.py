"""Conversations as training text: turn order checked by a finite-state machine, a loss flag for every segment."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    """How a role's turn is written. Marks begin with [ or < and hold neither these nor a backslash later on."""

    open: str
    close: str
    loss: bool


@dataclass(frozen=True)
class Template:
    """A declarative chat template.

    `turns` names the roles; a turn of any other role is written with `other`, the role's name standing between
    `other.open` and `name_end`. `control` are further strings that a model reads as control; like the marks,
    they never appear inside a text. `order` gives, for each state, the state each role leads to; `start` is
    the first state, `final` are those in which a conversation may end.
    """

    turns: dict[str, Turn]
    other: Turn
    name_end: str
    control: tuple[str, ...] = ()
    order: dict[str, dict[str, str]] = field(default_factory=dict)
    start: str = "start"
    final: tuple[str, ...] = ()

    def marks(self) -> list[str]:
        strings = {self.name_end, *self.control}
        for turn in (*self.turns.values(), self.other):
            strings |= {turn.open, turn.close}
        marks = sorted({s.strip() for s in strings}, key=lambda s: (-len(s), s))
        for mark in marks:
            if mark[0] not in "[<" or re.search(r"[\[<\\]", mark[1:]):
                raise ValueError(f"a mark begins with [ or < and has no such character later: {mark!r}")
        return marks


INSTRUCT = Template(
    turns={
        "system": Turn("[SYS] ", " [/SYS]", False),
        "user": Turn("[INST] ", " [/INST]", False),
        "assistant": Turn("[OUT] ", "</s>", True),
    },
    other=Turn("[ROLE] ", " [/ROLE]", False),
    name_end=" [TEXT] ",
    control=("<s>", "[/OUT]"),
    order={
        "start": {"system": "asked", "user": "answer"},
        "asked": {"user": "answer"},
        "answer": {"assistant": "next"},
        "next": {"user": "answer"},
    },
    final=("answer", "next"),
)


def _tails(template: Template) -> str:
    return "|".join(re.escape(mark[1:]) for mark in template.marks())


def escape(text: Column, template: Template) -> Column:
    """A backslash behind the first character of every control string; backslashes that stand there get one more."""
    return F.regexp_replace(text, rf"([\[<])(\\*)(?={_tails(template)})", r"$1$2\\")


def unescape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, rf"([\[<])(\\*)\\(?={_tails(template)})", "$1$2")


def _pick(role: Column, template: Template, value) -> Column:
    chosen = F.lit(value(template.other))
    for name, turn in template.turns.items():
        chosen = F.when(role == name, F.lit(value(turn))).otherwise(chosen)
    return chosen


def format_conversations(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conv_id: segments (array of text, loss), formatted (their concatenation) and valid.

    Turns are taken in order of turn (null first), then role, then text. Segments are the marks, which carry no
    loss, and the escaped texts, which carry their role's. `valid` tells whether the roles follow the template's
    order; a conversation that breaks it is formatted all the same, so that nothing is lost unseen.

    Null texts and null roles are ''. A row with a null conv_id belongs to no conversation that could be told: each is
    one of its own, of one turn, however many there are. Repeated rows are turns of their own. Other columns are
    dropped. A conversation becomes one value by definition, so one task holds it.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = role.isin(*template.turns)
    name = F.when(known, F.lit("")).otherwise(F.concat(escape(role, template), F.lit(template.name_end)))
    step = F.lit(template.start)
    rows = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            role.alias("role"),
            text.alias("text"),
            F.concat(_pick(role, template, lambda t: t.open), name).alias("open"),
            _pick(role, template, lambda t: t.close).alias("close"),
            _pick(role, template, lambda t: t.loss).alias("loss"),
        ).alias("t"),
    )
    grouped = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    grouped = grouped.unionByName(rows.where("conv_id IS NULL").select("conv_id", F.array("t").alias("turns")))
    moves = F.create_map(
        *[
            F.lit(part)
            for state, leads in template.order.items()
            for role_name, to in leads.items()
            for part in (f"{state}\n{role_name}", to)
        ]
    )
    end = F.aggregate(
        "turns", step, lambda state, t: F.coalesce(F.try_element_at(moves, F.concat(state, F.lit("\n"), t.role)), F.lit(""))
    )
    segment = lambda words, loss: F.struct(words.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                segment(t.open, F.lit(False)), segment(escape(t.text, template), t.loss), segment(t.close, F.lit(False))
            ),
        )
    )
    return grouped.select("conv_id", segments.alias("segments"), end.isin(*template.final).alias("valid")).select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s.text), "").alias("formatted"), "valid"
    )


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (array of role, text) that a formatted string stands for."""
    opens = "|".join(re.escape(t.open) for t in template.turns.values())
    closes = "|".join(re.escape(t.close) for t in (*template.turns.values(), template.other))
    named = f"{re.escape(template.other.open)}.*?{re.escape(template.name_end)}"
    turn = rf"(?s)({opens}|{named})(.*?)({closes})"
    part = lambda group: F.regexp_extract_all(formatted, F.lit(turn), F.lit(group))

    def role(mark: Column) -> Column:
        length = F.length(mark) - len(template.other.open) - len(template.name_end)
        found = unescape(F.substring(mark, F.lit(len(template.other.open) + 1), length), template)
        for name, kind in template.turns.items():
            found = F.when(mark == kind.open, F.lit(name)).otherwise(found)
        return found

    return F.transform(
        F.arrays_zip(part(1).alias("mark"), part(2).alias("body")),
        lambda t: F.struct(role(t.mark).alias("role"), unescape(t.body, template).alias("text")),
    )


def loss_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s.loss), lambda s: unescape(s.text, template)), "")


def digests(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Digests of what can be read back from the formatted conversations."""
    whole = F.array_join(F.transform("read", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return (
        formatted.withColumn("read", read_turns(F.col("formatted"), template))
        .withColumn("learned", loss_text(F.col("segments"), template))
        .select(
            "conv_id",
            F.size("read").cast("long").alias("n_turns"),
            F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
            F.length("learned").cast("long").alias("loss_chars"),
            F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts look like control strings, formatted and read back."""
    tricky = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(tricky).alias("text"),
    )
    given = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digests(format_conversations(given.unionByName(probe)))


# escaped strings get one character more, so SQL counts them by the same rule
ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER (PARTITION BY conv_id IS NULL) END AS lone,
    length(text) + len(regexp_extract_all(text,
      '[\[<]\\*(SYS\]|/SYS\]|INST\]|/INST\]|OUT\]|/OUT\]|/s>|s>|ROLE\]|/ROLE\]|TEXT\])'))
    + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
      ELSE 15 + length(role) + 8 + len(regexp_extract_all(role,
      '[\[<]\\*(SYS\]|/SYS\]|INST\]|/INST\]|OUT\]|/OUT\]|/s>|s>|ROLE\]|/ROLE\]|TEXT\])')) END AS chars
  FROM turns
), whole AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turned,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
    string_agg(substr(role, 1, 1), '' ORDER BY turn NULLS FIRST, role, text) AS letters,
    bool_and(role IN ('system', 'user', 'assistant')) AS known
  FROM sized GROUP BY conv_id, lone
)
SELECT conv_id, n_turns, sha256(turned) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  formatted_chars, known AND regexp_full_match(letters, 's?(ua)*u?') AND letters NOT IN ('', 's') AS valid
FROM whole
"""
