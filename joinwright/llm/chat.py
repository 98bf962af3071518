"""Chats rebuilt from event logs, and rendered with a mask of what a model learns to say.

A log has one row per event: conversation, message, sequence number, kind, role, text.

* ``open`` begins a message with its role and first text;
* ``delta`` appends a streamed piece;
* ``edit`` replaces the code points from ``start`` to ``stop``, or the whole text if null;
* ``regenerate`` takes the text back, and what is streamed after it is the new one;
* ``retract`` takes the message back; until it is opened again, nothing else bears on it.

Events are partitioned by range of conversation, message and sequence number, so the log of
a conversation or of a message that holds much of all rows is spread over tasks. Every task folds its
stretch; only messages that go on in the next stretch are folded once more from what is left.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import importable, staged

KINDS = ("open", "delta", "edit", "regenerate", "retract")
STEP = "struct<kind:string,role:string,start:long,stop:long,text:string>"
#: Rows and characters that are handed on at a time.
ROWS, CHARACTERS = 2048, 1 << 21


# ----------------------------------------------------------------------- folding


class Step(NamedTuple):
    kind: str
    role: str | None
    start: int | None
    stop: int | None
    text: str


class Folded:
    """What a stretch of a message's events does to what was before it.

    Steps are kept only as long as they depend on what came before; a text that is known is one
    ``open``, ``regenerate`` or whole ``edit`` step, and deltas in a row are one.
    """

    def __init__(self) -> None:
        self.steps: list[Step] = []
        self.parts: list[str] = []  # of the last step's text

    def _close(self) -> None:
        if self.parts:
            self.steps[-1] = self.steps[-1]._replace(text="".join(self.parts))
            self.parts = []

    def _put(self, step: Step) -> None:
        self.steps.append(step)
        self.parts = [step.text]

    def add(self, step: Step) -> None:
        if step.kind in ("open", "retract"):
            self.steps, self.parts = [], []
            opened = step._replace(start=None, stop=None)
            self._put(opened if step.kind == "open" else opened._replace(text="", role=None))
            return
        last = self.steps[-1] if self.steps else None
        if last and last.kind == "retract":
            return
        known = last is not None and last.kind != "delta" and last.start is None
        if step.kind == "delta":
            if known or last and last.kind == "delta":
                self.parts.append(step.text)
            else:
                self._close()
                self._put(step)
            return
        self._close()
        if step.kind == "regenerate" or step.start is None:
            # A new text of whatever was opened before.
            opened = self.steps[0] if self.steps and self.steps[0].kind == "open" else step
            self.steps = []
            self._put(opened._replace(start=None, stop=None, text=step.text))
        elif known:
            text, stop = self.steps[-1].text, step.stop if step.stop is not None else step.start
            text = text[: step.start] + step.text + text[max(stop, step.start) :]
            self.steps[-1] = self.steps[-1]._replace(text=text)
            self.parts = [text]
        else:
            self._put(step)

    def done(self) -> list[Step]:
        self._close()
        return self.steps

    def message(self) -> tuple[str | None, str] | None:
        """Role and text, if nothing is before this stretch; None for no message."""
        last = Folded()
        for step in [Step("open", None, None, None, ""), *self.done()]:
            last.add(step)
        at = last.done()[-1]
        return None if at.kind == "retract" else (at.role, at.text)


def step_of(row: dict) -> Step:
    start = row["start"]
    return Step(
        row["kind"], row["role"], None if start is None else max(0, start), row["stop"], row["text"] or ""
    )


def batched(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size; ``size`` of a row tells its characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row.pop("size")
        if len(held) >= ROWS or size >= CHARACTERS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield from batch.slice(start, ROWS).to_pylist()


def fold(events: DataFrame) -> DataFrame:
    """``conv_id, message, role, text`` of the messages that a log leaves.

    ``events`` has ``conv_id, message, seq, kind, role, start, stop, text``; conversation,
    message and number may be of any type that sorts. Other columns, whatever their names,
    are not read.

    Rows of one message and number are one event, delivered more than once; if they differ,
    the first in the order of kind, role, start, stop and text stands. Null conversations,
    messages and numbers count as one value each, before all others. A null text is empty. Events
    of no known kind do nothing; a message without ``open`` has the role null. An edit beyond the
    text's end appends, and one that ends before it starts inserts. A message all of whose events are unknown or that is retracted gives no row.
    An empty log gives no messages.
    """
    importable(events.sparkSession)
    keys = ["conv_id", "message"]
    order = [*keys, "seq", "kind", "role", "start", "stop", "text"]
    names = {c.lower(): c for c in events.columns}
    log = events.select(*(F.col(f"`{names[c]}`").alias(c) for c in order)).filter(
        F.col("kind").isin(*KINDS)
    ).withColumn("start", F.col("start").cast("long")).withColumn("stop", F.col("stop").cast("long"))
    dealt = log.repartitionByRange(*keys, "seq").sortWithinPartitions(*order)
    kinds = {f.name: f.dataType for f in log.schema.fields}
    stretch = T.StructType(
        [
            T.StructField("conv_id", kinds["conv_id"]),
            T.StructField("message", kinds["message"]),
            T.StructField("part", T.IntegerType()),
            T.StructField("steps", T._parse_datatype_string(f"array<{STEP}>")),
            T.StructField("edge", T.BooleanType()),
        ]
    )
    arrow = to_arrow_type(stretch)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def made() -> Iterator[dict]:
            first, key, number, folded = True, None, None, None

            def row(edge: bool) -> dict:
                steps = [s._asdict() for s in folded.done()]
                return {
                    "conv_id": key[0], "message": key[1], "part": part, "steps": steps, "edge": edge,
                    "size": sum(len(s["text"]) for s in steps),
                }

            for event in rows_of(batches):
                at = (event["conv_id"], event["message"])
                if folded is None or at != key:
                    if folded is not None:
                        yield row(edge=first)
                        first = False
                    key, folded = at, Folded()
                elif event["seq"] == number:
                    continue  # delivered again
                number = event["seq"]
                folded.add(step_of(event))
            if folded is not None:
                yield row(edge=True)

        yield from batched(made(), pa.schema(list(arrow)))

    pieces = staged(dealt.mapInArrow(stretches, stretch))
    done = T.StructType(
        [*stretch.fields[:2], T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    )
    done_arrow = pa.schema(list(to_arrow_type(done)))

    def finished(rows: list[dict]) -> list[dict]:
        folded = Folded()
        for piece in rows:
            for step in piece["steps"]:
                folded.add(Step(**step))
        message = folded.message()
        if message is None:
            return []
        own = {"conv_id": rows[0]["conv_id"], "message": rows[0]["message"]}
        return [own | {"role": message[0], "text": message[1], "size": len(message[1])}]

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched((r for row in rows_of(batches) for r in finished([row])), done_arrow)

    def across(table: pa.Table) -> pa.Table:
        rows = finished(sorted(table.to_pylist(), key=lambda r: r["part"]))
        return pa.Table.from_batches(batched(rows, done_arrow), done_arrow)

    # At most two stretches of a task are at its edges, so a group has no more rows than there are tasks.
    return pieces.filter("not edge").mapInArrow(inside, done).union(
        pieces.filter("edge").groupBy(*keys).applyInArrow(across, done)
    )


# --------------------------------------------------------------------- rendering


class Template(NamedTuple):
    """Marks before and after a turn, by role; ``other`` is for all others, which name theirs.

    Every mark holds one control string; a control string is ``[`` or ``<``, then characters
    that are neither, then ``]`` or ``>``.
    """

    roles: dict[str, tuple[str, str]]
    other: tuple[str, str, str]
    learned: frozenset[str]

    def controls(self) -> list[str]:
        marks = [m for pair in self.roles.values() for m in pair] + list(self.other)
        return sorted({c for m in marks for c in re.findall(r"[<\[][^<\[]*[>\]]", m)})

    def escapes(self) -> re.Pattern:
        """A control string, with any number of backslashes after its first character."""
        rests = "|".join(re.escape(c[1:]) for c in self.controls())
        return re.compile(rf"([<\[])(\\*)({rests})")


TEMPLATE = Template(
    {
        "system": ("[SYS] ", " [/SYS]\n"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": ("<s> ", " </s>\n"),
    },
    ("[ROLE] ", " [/ROLE] ", " [END]\n"),
    frozenset({"assistant"}),
)


def rendered(role: str | None, text: str, template: Template, escapes: re.Pattern) -> tuple[str, int, int]:
    """A turn with its marks, and where its text lies.

    In a text, a control string gets one more backslash after its first character, so a
    control string without any is a mark, and taking one away restores the text.
    """
    inside = escapes.sub(r"\1\2\\\3", text)
    if role in template.roles:
        before, after = template.roles[role]
    else:
        name, named, after = template.other
        before = name + escapes.sub(r"\1\2\\\3", role or "") + named
    return before + inside + after, len(before), len(before) + len(inside)


def unescaped(text: str, escapes: re.Pattern) -> str:
    return escapes.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def turns_of(formatted: str, template: Template, escapes: re.Pattern) -> Iterator[tuple[str, str]]:
    """Role and text of the turns, from nothing but the formatted text."""
    at = 0
    while at < len(formatted):
        for role, (before, after) in template.roles.items():
            if formatted.startswith(before, at):
                start = at + len(before)
                break
        else:
            name, named, after = template.other
            end = formatted.index(named, at + len(name))
            role = unescaped(formatted[at + len(name) : end], escapes)
            start = end + len(named)
        stop = formatted.index(after, start)
        yield role, unescaped(formatted[start:stop], escapes)
        at = stop + len(after)


def render(messages: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """``conv_id, message, formatted, loss_start, loss_stop`` of every message.

    The formatted texts of a conversation, in the order of ``message``, are the chat. From
    ``loss_start`` to ``loss_stop`` (code points, null for none) lies what a model learns to
    say: the text of a turn whose role is among the ``learned``, escaped as it is there.
    Nothing is shuffled, and a conversation may have any number of messages. A null text is
    empty; a null role is an empty one, and no role has marks of its own but those listed.
    """
    importable(messages.sparkSession)
    rows = messages.select("conv_id", "message", "role", F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType(
        [
            *rows.schema.fields[:2],
            T.StructField("formatted", T.StringType()),
            T.StructField("loss_start", T.LongType()),
            T.StructField("loss_stop", T.LongType()),
        ]
    )
    arrow = pa.schema(list(to_arrow_type(schema)))

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escapes = template.escapes()

        def made() -> Iterator[dict]:
            for row in rows_of(batches):
                text, start, stop = rendered(row["role"], row["text"], template, escapes)
                learned = row["role"] in template.learned
                yield {
                    "conv_id": row["conv_id"], "message": row["message"], "formatted": text,
                    "loss_start": start if learned else None, "loss_stop": stop if learned else None,
                    "size": len(text),
                }

        yield from batched(made(), arrow)

    return rows.mapInArrow(formatted, schema)


class Digest:
    """Sums of one conversation's chat, fed in the order of its turns."""

    def __init__(self, conv_id: Any):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars, "size": 64,
        }


def read_back(chats: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Digests of every conversation, from what ``render`` gave.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``: the first
    hash is that of role, line break, text and line break of every turn, the second that of
    all text under the mask, unescaped.

    A hash of a whole conversation takes its turns one after the other, so they are one
    task's work, however many; the task reads them as a stream and holds one at a time.
    """
    importable(chats.sparkSession)
    schema = T.StructType(
        [
            T.StructField("conv_id", chats.schema["conv_id"].dataType),
            *T._parse_datatype_string(
                "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
            ).fields,
        ]
    )
    arrow = pa.schema(list(to_arrow_type(schema)))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escapes = template.escapes()

        def made() -> Iterator[dict]:
            at: Digest | None = None
            for row in rows_of(batches):
                if at is None or row["conv_id"] != at.conv_id:
                    if at is not None:
                        yield at.row()
                    at = Digest(row["conv_id"])
                formatted = row["formatted"]
                for role, text in turns_of(formatted, template, escapes):
                    at.turns += 1
                    at.all.update(f"{role}\n{text}\n".encode())
                if row["loss_start"] is not None:
                    text = unescaped(formatted[row["loss_start"] : row["loss_stop"]], escapes)
                    at.loss_chars += len(text)
                    at.loss.update(text.encode())
                at.chars += len(formatted)
            if at is not None:
                yield at.row()

        yield from batched(made(), arrow)

    dealt = chats.repartition("conv_id").sortWithinPartitions("conv_id", "message")
    return dealt.mapInArrow(digested, schema)


# ------------------------------------------------------------------ logs of rows

#: Code points of a streamed piece, and the most pieces of a text; longer texts have longer ones.
PIECE, PIECES = 120, 64
#: Code points that a draft gets wrong.
DRAFT = 24


def log_of(turns: DataFrame) -> DataFrame:
    """The event log that leaves ``turns`` (``conv_id, turn, role, text``), as a chat service would write it.

    Every text is streamed in pieces. By a hash of conversation and turn, a quarter of the messages
    are regenerated after a wrong draft, a quarter have a wrong stretch that an edit mends, and a quarter have all
    events delivered twice, beside a message that is retracted.

    Messages are in the order of turn, role and a hash of the text, nulls first. Repeated rows
    are messages of their own. A null text is empty.
    """
    source = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    # The last field tells repeated rows apart; as they are alike, it does not matter which is which.
    key = "named_struct('turn', turn, 'role', role, 'hash', xxhash64(text), 'branch', {}, 'row', row)"
    step = "named_struct('kind', '{}', 'role', {}, 'start', {}, 'stop', {}, 'text', {})"

    def one(kind: str, role="CAST(NULL AS STRING)", start="CAST(NULL AS BIGINT)", stop="CAST(NULL AS BIGINT)", text="''"):
        return step.format(kind, role, start, stop, text)

    def streamed(text: str) -> str:
        """Steps for the pieces of a text; none for an empty one."""
        size = f"greatest({PIECE}, CAST(ceil(char_length({text}) / {PIECES}) AS INT))"
        piece = one("delta", text=f"substring({text}, i * {size} + 1, {size})")
        places = f"sequence(0, CAST(ceil(char_length({text}) / {size}) AS INT) - 1)"
        return f"CASE WHEN {text} = '' THEN array() ELSE transform({places}, i -> {piece}) END"

    opened = one("open", role="role")
    wrong_at = "CAST(char_length(text) / 3 AS BIGINT)"
    wrong = f"concat(substring(text, 1, CAST({wrong_at} AS INT)), 'wrong', substring(text, CAST({wrong_at} AS INT) + {DRAFT} + 1))"
    right = f"substring(text, CAST({wrong_at} AS INT) + 1, {DRAFT})"
    steps = {
        0: f"concat(array({opened}), {streamed('text')})",
        1: f"concat(array({opened}, {one('delta', text=f'reverse(substring(text, 1, {DRAFT}))')},"
        f" {one('regenerate')}), {streamed('text')})",
        2: f"concat(array({opened}), {streamed('wrong')},"
        f" array({one('edit', start=wrong_at, stop=f'{wrong_at} + 5', text=right)}))",
    }
    steps[3] = steps[0]
    retracted = f"array({opened}, {one('delta', text='reverse(role)')}, {one('retract')})"
    chosen = " ".join(f"WHEN {n} THEN {s}" for n, s in steps.items())
    main = f"named_struct('message', {key.format(0)}, 'steps', CASE way {chosen} END)"
    aside = f"named_struct('message', {key.format(1)}, 'steps', {retracted})"
    return (
        source.withColumn("row", F.monotonically_increasing_id())
        .withColumn("way", F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)).cast("int"))
        .withColumn("wrong", F.expr(wrong))
        .select("conv_id", "way", F.expr(f"inline(CASE WHEN way = 3 THEN array({main}, {aside}) ELSE array({main}) END)"))
        .select("conv_id", "way", "message", F.posexplode("steps").alias("seq", "step"))
        .select("conv_id", "message", "seq", "step.*", F.explode(F.sequence(F.lit(1), F.when(F.col("way") == 3, 2).otherwise(1))).alias("copy"))
        .drop("copy")
    )
