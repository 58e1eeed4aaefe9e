"""Chat formatting: a state machine over roles, and segments with loss flags from a declarative template.

A conversation's rows, in turn order, drive the machine; each turn becomes three segments (opening mark, text, closing
mark), and only the text of a role with loss is under the mask. Conversations that leave the
machine's order are formatted too and carry the first fault. Inside texts a backslash is doubled and each control
string gets a backslash after its first character, so no text holds one and `read_back` restores every text.

Rows are shuffled by conversation and sorted, then streamed: a task holds one turn at a time, however long
a conversation is.

Defined cases: null text and null role are empty strings; a role without a mark of its own is written inside the general
marks. Rows with equal or null turns are ordered by turn (nulls first), role, text. Null conv_ids are one
conversation. An empty table gives no rows. Repeated rows are repeated turns. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written


@dataclass(frozen=True)
class Template:
    """marks: role -> (before, after); other: (before the role, between, after) of any other role; loss: roles that are trained on;
    moves: (state, role) -> state from `start`; final: states that a conversation may end in."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str, str] = ("<<TURN>>", "<</TURN>>", "<<END>>")
    loss: frozenset[str] = frozenset({"assistant"})
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {("start", "system"): "told", ("start", "user"): "asked", ("told", "user"): "asked", ("asked", "assistant"): "answered", ("answered", "user"): "asked"}
    )
    final: frozenset[str] = frozenset({"answered"})

    def controls(self) -> list[str]:
        return sorted({x for pair in self.marks.values() for x in pair} | set(self.other), key=lambda x: (-len(x), x))

    def check(self) -> Template:
        """Raises if a text's end and a mark could read as another mark, or one mark holds another."""
        marks = self.controls()
        for x in marks:
            if len(x) < 2 or "\\" in x:
                raise ValueError(f"{x!r} can't be a mark")
            for y in marks:
                if x != y and x in y or any(y.startswith(x[n:]) or x[n:].startswith(y) for n in range(1, len(x)) if x[n:] and x != y and len(y) >= len(x[n:])):
                    raise ValueError(f"{x!r} and {y!r} can't be told apart")
        return self

    def control(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, self.controls())))

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        starts = re.compile("(.)(?<=(?=" + "|".join(map(re.escape, self.controls())) + ").)", re.S)
        return starts.sub(r"\1\\", text) if self.control().search(text) else text

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        before, after = self.marks.get(role) or (self.other[0] + self.escape(role) + self.other[1], self.other[2])
        return [(before, False), (self.escape(text), role in self.loss), (after, False)]

    def parse(self, formatted: str) -> tuple[str, str]:
        """(role, text) of one formatted turn."""
        cuts = list(self.control().finditer(formatted))
        got = [m[0] for m in cuts]
        if cuts and cuts[0].start() == 0 and cuts[-1].end() == len(formatted):
            if got == list(self.other):
                return self.unescape(formatted[cuts[0].end() : cuts[1].start()]), self.unescape(formatted[cuts[1].end() : cuts[2].start()])
            for role, pair in self.marks.items():
                if got == list(pair):
                    return role, self.unescape(formatted[cuts[0].end() : cuts[1].start()])
        raise ValueError("not a formatted turn")


_SEGMENT = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("segment", pa.int32()), ("text", pa.string()), ("loss", pa.bool_()), ("fault", pa.string())])


def _runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in columns))


def format_conversations(rows: DataFrame, template: Template | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn (counted from 0), segment (0 to 2), text, loss, fault (on a turn's first segment, if the machine can't take the turn; on
    the last turn's closing mark, if the conversation may not end there)."""
    template = (template or Template()).check()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        now, state, n = nothing, "start", 0
        out: list[tuple] = []

        def end() -> None:
            if now is not nothing and state not in template.final:
                out[-1] = (*out[-1][:5], out[-1][5] or f"ends {state}")

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEGMENT)], schema=_SEGMENT)

        size = 0
        for c, r, t in _runs(batches, "conv_id", "role", "text"):
            if c != now:
                end()
                now, state, n = c, "start", 0
            to = template.moves.get((state, r))
            fault = None if to else f"{r or 'no role'} after {state}"
            state = to or "astray"
            for k, (s, loss) in enumerate(template.segments(r, t)):
                out.append((c, n, k, s, loss, fault if k == 0 else None))
            n, size = n + 1, size + len(t)
            if len(out) > 6000 or size > 1 << 22:
                yield batch(out[:-1])  # the last one may still get a fault
                out, size = out[-1:], 0
        end()
        if out:
            yield batch(out)

    picked = rows.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = picked.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(run, "conv_id bigint, turn bigint, segment int, text string, loss boolean, fault string")


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation, from its segments alone: conv_id, n_turns, turns_sha256 (of role, line end, text, line end a turn), loss_chars and
    loss_sha256 (of the unescaped texts under the mask), formatted_chars, fault (the first)."""
    template = (template or Template()).check()
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, fault string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        done: dict[str, list] = {k: [] for k in names}
        nothing = object()
        now, turn, parts = nothing, None, []

        def end_turn() -> None:
            nonlocal parts
            if parts:
                role, text = template.parse("".join(parts))
                turns.update(f"{role}\n{text}\n".encode())
                parts = []

        def end() -> None:
            if now is not nothing:
                end_turn()
                for k, v in zip(names, (now, n, turns.hexdigest(), chars, masked.hexdigest(), total, fault)):
                    done[k].append(v)

        for c, t, s, loss, wrong in _runs(batches, "conv_id", "turn", "text", "loss", "fault"):
            if c != now:
                end()
                now, turn, n, chars, total, fault = c, None, 0, 0, 0, None
                turns, masked = hashlib.sha256(), hashlib.sha256()
            if t != turn:
                end_turn()
                turn, n = t, n + 1
            parts.append(s)
            total += len(s)
            fault = fault or wrong
            if loss:
                plain = template.unescape(s)
                chars += len(plain)
                masked.update(plain.encode())
        end()
        types = {"bigint": pa.int64(), "string": pa.string()}
        yield pa.RecordBatch.from_arrays([pa.array(done[k], types[x.split()[1]]) for k, x in zip(names, schema.split(", "))], names)

    ordered = segments.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "turn", "segment")
    return ordered.mapInArrow(run, schema)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return read_back(written(format_conversations(rows.unionByName(probe)), "segments"))


def _escaped_sql(text: str) -> str:
    out = rf"replace({text}, '\', '\\')"
    for x in Template().controls():
        out = f"replace({out}, '{x}', '{x[0]}\\{x[1:]}')"
    return out


ORACLE = f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, i, x, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS p(i, x)),
g AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, t) AS k, role, t,
  CASE role {' '.join(f"WHEN '{k}' THEN {len(a) + len(b)}" for k, (a, b) in Template().marks.items())} ELSE {sum(map(len, Template().other))} + length({_escaped_sql('role')}) END + length({_escaped_sql('t')}) AS n FROM r),
s AS (SELECT *, CASE WHEN role = 'system' AND k = 1 THEN 'told' WHEN role = 'user' THEN 'asked' ELSE 'answered' END AS state FROM g),
b AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY conv_id ORDER BY k), 'start') AS was FROM s),
f AS (SELECT conv_id, bool_or(NOT ((role = 'system' AND was = 'start') OR (role = 'user' AND was <> 'asked') OR (role = 'assistant' AND was = 'asked'))) AS bad,
  arg_max(state, k) AS last FROM b GROUP BY conv_id)
SELECT g.conv_id::BIGINT AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(t, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars, CASE WHEN any_value(bad) THEN 'x' WHEN any_value(last) <> 'answered' THEN 'ends ' || any_value(last) END AS fault
FROM g JOIN f ON f.conv_id = g.conv_id GROUP BY g.conv_id
"""
