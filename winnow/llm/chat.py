"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string. Rendering successive prefixes of a
conversation and comparing neighbouring outputs shows where each turn's text went: the output for
k turns must begin with that for k - 1, and what it adds is the k-th turn's span. A template that
breaks this rewrites history, and the conversation is flagged. Within a span, the turn's content is
found by rendering the same prefix with a placeholder as the last text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Strings that mark turns; inside a role or text a backslash stands before each of them, and before each backslash.
OPEN, CLOSE = "### ", "</turn>"
_CONTROL = re.compile(r"\\|### |</turn>|: ")
_ESCAPED = re.compile(r"\\(\\|### |</turn>|: )")
_PLACE = "\ue000\ue001"
#: Turns that are gathered before the prefixes that end with them are rendered. The result does not depend on it.
RUN = 512


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def plain_template(turns: list[Turn]) -> str:
    """`### Role: text</turn>` and a line's end for each turn."""
    return "".join([f"{OPEN}{escape(role)}: {escape(text)}{CLOSE}\n" for role, text in turns])


def read_turn(span: str) -> Turn:
    """The turn that plain_template wrote as this span."""
    if not (span.startswith(OPEN) and span.endswith(CLOSE + "\n")):
        raise ValueError("not a turn of this template")
    body = span[len(OPEN) : -len(CLOSE) - 1]
    m = re.match(r"((?:\\(?:\\|### |</turn>|: )|[^\\])*?): ", body, re.DOTALL)
    return unescape(m[1]), unescape(body[m.end() :])


class Rendering:
    """A conversation that grows: the output for all its turns, each turn's bounds, whether history is rewritten.

    Every prefix begins with the conversation's first turn, however the turns arrive. Bounds are
    those of the turn's span and of its content; spans of a template that rewrites history are
    where consecutive outputs part and the ends of the outputs.
    """

    def __init__(self, template: Template):
        self.template, self.turns = template, []
        self.out, self.spans, self.rewrites = "", [], False

    def extend(self, more: list[Turn]) -> None:
        turns, template = self.turns, self.template
        for turn in more:
            turns.append(turn)
            before, now = self.out, template(turns[:])
            if now.startswith(before):
                at = len(before)
            else:
                self.rewrites = True
                at = next((i for i, (a, b) in enumerate(zip(before, now, strict=False)) if a != b), min(len(before), len(now)))
            probe = template([*turns[:-1], (turn[0], _PLACE)])
            mark = probe.rfind(_PLACE)
            if mark < at:
                raise ValueError("the template does not show the turn's text")
            head, tail = probe[at:mark], probe[mark + len(_PLACE) :]
            self.spans.append((at, len(now), at + len(head), len(now) - len(tail)))
            self.out = now


def locate(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int]], bool]:
    """The output for all turns; for each turn the bounds of its span and of its content; whether history is rewritten."""
    r = Rendering(template)
    r.extend(turns)
    return r.out, r.spans, r.rewrites


def format_conversations(
    rows: DataFrame, template: Template = plain_template, read: Callable[[str], Turn] = read_turn, unescape: Callable[[str], str] = unescape, loss_role: str = "assistant", with_output: bool = False, run_turns: int = RUN
) -> DataFrame:
    """Format conversations of (conv_id, turn, role, text) rows; report what is read back from the output.

    Returns per conversation conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, rewrites_history and, if asked for, formatted (the output) and loss_spans
    (start and end of each stretch of the output under the loss mask).

    Turns are ordered by turn, ties by role and text; repeated rows are turns of their own. A null
    text or role is empty, null conv_ids form one conversation, an empty table gives an empty
    result; further columns are ignored. Rows are shuffled by conversation and sorted, and a task
    streams through them: it holds one conversation at a time. Every prefix is rendered from the
    conversation's true beginning, whatever its length, so time grows with the square of a
    conversation's length. Prefixes are rendered whenever run_turns turns have been gathered; the
    result does not depend on that number.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"] + ["formatted", "loss_spans"] * with_output
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()] + [pa.string(), pa.list_(pa.list_(pa.int64()))] * with_output

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None

        def flush(s: dict) -> None:
            s["rendering"].extend(s["turns"])
            s["turns"] = []

        def close(s: dict) -> list:
            flush(s)
            r, every, loss, loss_chars, marked = s["rendering"], hashlib.sha256(), hashlib.sha256(), 0, []
            for at, end, start, stop in r.spans:
                role, text = read(r.out[at:end])
                every.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if role == loss_role:
                    own = unescape(r.out[start:stop])
                    loss.update(own.encode("utf-8", "surrogatepass"))
                    loss_chars += len(own)
                    marked.append([start, stop])
            row = [s["id"], len(r.spans), every.hexdigest(), loss_chars, loss.hexdigest(), len(r.out), r.rewrites]
            return row + [r.out, marked] * with_output

        def begin(i: object) -> dict:
            return {"id": i, "turns": [], "rendering": Rendering(template)}

        kind = None

        def out(done: list) -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k or kind) for c, k in zip(cols, kinds, strict=True)], names=names)

        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            for i, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if state is None or state["id"] != i:
                    if state is not None:
                        done.append(close(state))
                    state = begin(i)
                state["turns"].append((role, text))
                if len(state["turns"]) >= run_turns:
                    flush(state)
            if done:
                yield out(done)
        if state is not None:
            yield out([close(state)])

    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewrites_history boolean" + ", formatted string, loss_spans array<array<bigint>>" * with_output
    turns = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, schema)


#: What the escapes add is counted in the text: one character for each control string and each backslash.
ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, n, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)
), sized AS (
  SELECT *, length(regexp_replace(text, '(\\|### |</turn>|: )', '\\\1', 'g')) + length(regexp_replace(role, '(\\|### |</turn>|: )', '\\\1', 'g')) + 14 AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       false AS rewrites_history
FROM sized GROUP BY conv_id
"""
