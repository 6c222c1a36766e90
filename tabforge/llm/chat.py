"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records of one table may hold conversations in different layouts: a prompt and a completion,
an instruction with an input, a list of messages under one of several names. The nested field
paths that a record fills are hashed; the hash selects a declarative mapping, which says from
which paths turns are taken. Turns are then written with a template whose control strings cannot
stand inside a text, and read back from the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: ``messages`` names a list with the fields ``role`` and ``text``; or ``turns``
    lists (role, path) for single fields, in order; those in ``optional`` may be missing.
    ``speakers`` are names in the role field that mean a canonical role."""

    name: str
    messages: str = ""
    role: str = ""
    text: str = ""
    turns: tuple[tuple[str, str], ...] = ()
    speakers: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()

    def paths(self) -> tuple[str, ...]:
        own = (f"{self.messages}[].{self.role}", f"{self.messages}[].{self.text}") if self.messages else ()
        return own + tuple(path for _, path in self.turns)

    def layouts(self) -> list[tuple[str, ...]]:
        """Every set of paths that a record of this layout may fill."""
        fixed = [p for p in self.paths() if p not in self.optional]
        return [tuple(sorted([*fixed, *some])) for n in range(len(self.optional) + 1) for some in combinations(self.optional, n)]


_SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
_SYSTEM = ("system", "system")

#: Common layouts; the first that a fingerprint belongs to is taken.
MAPPINGS = (
    Mapping("messages", "messages", "role", "content", (_SYSTEM,), optional=("system",)),
    Mapping("rows", "rows", "role", "text"),
    Mapping("conversations", "conversations", "from", "value", (_SYSTEM,), _SPEAKERS, ("system",)),
    Mapping("instruction", turns=(_SYSTEM, ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input")),
    Mapping("prompt", turns=(_SYSTEM, ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Mapping("response", turns=(_SYSTEM, ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("question", turns=(("user", "question"), ("assistant", "answer"))),
)


def field_paths(schema: DataType, prefix: str = "") -> list[str]:
    """All nested leaf paths, dots for fields and [] for list elements."""
    if isinstance(schema, StructType):
        return [p for f in schema.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(schema, ArrayType):
        return field_paths(schema.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint_of(paths: Sequence[Column] | Column) -> Column:
    return F.xxhash64(F.array_join(F.array_sort(paths), "\n"))


def _at(path: str) -> Column:
    column = F.col(f"`{path.split('.')[0]}`")
    for part in path.split(".")[1:]:
        column = column.getField(part)
    return column


def with_layout(df: DataFrame, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``df`` with ``fingerprint``, the hash of the known paths a record fills, and ``layout``.

    A single field is filled if it is not null, the fields of a list if the list is not null.
    Paths that no mapping knows do not count, so further columns change nothing. Records of no
    known layout have a null layout.
    """
    known = {p for m in mappings for p in m.paths()}
    own = [p for p in field_paths(df.schema) if p in known]
    filled = F.array_compact(F.array(*[F.when(_at(p.split("[]")[0]).isNotNull(), p) for p in own])) if own else F.array().cast("array<string>")
    names = {}
    for m in mappings:
        for layout in m.layouts():
            names.setdefault(layout, m.name)
    df = df.withColumn("fingerprint", fingerprint_of(filled))
    layout = F.coalesce(*[F.when(F.col("fingerprint") == fingerprint_of(F.array(*map(F.lit, paths))), name) for paths, name in names.items()])
    return df.withColumn("layout", layout)


def canonical_turns(df: DataFrame, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``df`` with ``fingerprint``, ``layout`` and ``turns``, a list of (role, text).

    Null roles and texts are empty. A record of no known layout has no turns.
    """
    df = with_layout(df, mappings)
    have = set(field_paths(df.schema))
    filled = lambda c: F.coalesce(c.cast("string"), F.lit(""))

    def each(m: Mapping) -> Callable[[Column], Column]:
        def turn(t: Column) -> Column:
            role = filled(t[m.role])
            named = F.coalesce(*[F.when(F.lower(role) == name, meant) for name, meant in m.speakers], role)
            return F.struct(named.alias("role"), filled(t[m.text]).alias("text"))

        return turn

    cases = []
    for m in mappings:
        if m.messages and not set(m.paths()[:2]) <= have:
            continue
        single = [F.when(_at(path).isNotNull(), F.array(F.struct(F.lit(role).alias("role"), filled(_at(path)).alias("text")))) for role, path in m.turns if path in have]
        parts = [F.coalesce(c, F.array().cast(TURNS)) for c in single]
        if m.messages:
            parts.append(F.transform(_at(m.messages), each(m)))
        if parts:
            cases.append(F.when(F.col("layout") == m.name, F.concat(*parts)))
    return df.withColumn("turns", F.coalesce(*cases, F.array().cast(TURNS)))


# ---- the template -----------------------------------------------------------

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"

#: Strings that no text may hold as they are: those of this template and of common others.
CONTROL = (TURN, SAYS, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")

#: Roles whose texts count for the loss.
LOSS_ROLES = ("assistant",)


def escaped(text: Column) -> Column:
    """Backslashes doubled, then one put behind the first character of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescaped(text: Column) -> Column:
    """The text before ``escaped``: of a backslash and what may be its twin only the twin stays."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(df: DataFrame, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``df`` with layout, turns, ``segments``, ``formatted`` and ``loss_runs``.

    ``formatted`` is all segments in a row; ``segments`` are (text, loss), where loss marks the
    texts of ``LOSS_ROLES`` without their markers, and ``loss_runs`` the same as code points of
    ``formatted``: (length, loss). A record without turns is formatted as an empty text. Repeated
    records are formatted alike; columns of these names are replaced, other columns stay.
    """

    def pieces(turn: Column) -> Column:
        segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            segment(F.concat(F.lit(TURN), escaped(turn["role"]), F.lit(SAYS)), F.lit(False)),
            segment(escaped(turn["text"]), turn["role"].isin(*LOSS_ROLES)),
            segment(F.lit(END), F.lit(False)),
        )

    df = canonical_turns(df, mappings).withColumn("segments", F.flatten(F.transform("turns", pieces)))
    df = df.withColumn("formatted", F.array_join(F.col("segments")["text"], ""))
    return df.withColumn("loss_runs", F.transform("segments", lambda s: F.struct(F.length(s["text"]).alias("length"), s["loss"].alias("loss"))))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    each = F.filter(F.split(formatted, F.lit(_quoted(END))), lambda p: F.startswith(p, F.lit(TURN)))
    role = lambda p: F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), SAYS, 1)
    text = lambda p: F.substring_index(p, SAYS, -1)
    return F.transform(each, lambda p: F.struct(unescaped(role(p)).alias("role"), unescaped(text(p)).alias("text")))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, as it was before formatting."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in text)


def conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Records (conv_id, rows) of a table with one row for each turn, ordered by turn, role and text.

    Turns of one conversation come together, as the formatted text is one value. Nulls come
    first; rows without an id are one conversation; a repeated row is a further turn.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return rows.groupBy(F.col(id_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("rows"))
