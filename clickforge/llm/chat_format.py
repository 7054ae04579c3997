"""Chat formatting by incremental black-box rendering.

A template is any object whose ``render(turns)`` makes one string of a list of
(role, text).  Nothing else of it is looked at: the prefixes of a conversation
are rendered one after the other and consecutive outputs compared.  What the
longer prefix adds is the new turn's piece; where the shorter output is not a
prefix of the longer one, the template rewrites history, and the turn is marked.
Where the text lies in its piece is found in the same way: the turn is rendered
with two different one-character texts, and what both outputs share before and
after is markup.

Long conversations are cut into blocks of turn numbers, so one conversation
with a third of all rows is rendered by many tasks; a block also gets the turns
whose number lies up to ``reach`` below it, as far as the template looks back.
What is left to one task per conversation is the digest of its turns, which
SHA-256 defines over the whole sequence; it is streamed and holds one turn.

Defined results: a null text or role is empty; a null conv_id is a conversation
like others; turns go by number (null first), then role, then text, and repeated
rows are turns of their own; an empty table gives no rows; texts of any length
are whole; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Turn numbers of a block.
BLOCK_TURNS = 32

# Control strings of the public chat formats.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
START, END = CONTROL[0], CONTROL[1]

PIECES = ("conv_id {conv}, turn {turn}, pos long, piece string, text_start long, text_end long, "
          "loss boolean, rewrites_from long")
DIGESTS = ("conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, rewriting_turns long")


class MarkedTemplate:
    """Every turn is ``<|im_start|>role``, a line break, the text, ``<|im_end|>``
    and a line break.  A control string inside a text gets a backslash after its
    first character, one that already has some gets one more, so nothing in a
    text can be taken for markup and ``unescape`` gives the text back.  Roles are
    percent-encoded."""

    opening = closing = ""
    # a first character and its backslashes, before the rest of a control string that starts with it
    _marked = "|".join(rf"{re.escape(c)}\\{{n}}(?={'|'.join(re.escape(x[1:]) for x in CONTROL if x[0] == c)})" for c in "<[")
    _plain = re.compile(_marked.replace("{n}", "*"))
    _escaped = re.compile(_marked.replace("{n}", "+"))

    def escape(self, text: str) -> str:
        return self._plain.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][:-1], text)

    def render(self, turns: list[tuple[str, str]]) -> str:
        return "".join([f"{START}{quote(role, safe='')}\n{self.escape(text)}{END}\n" for role, text in turns])

    def read(self, piece: str) -> tuple[str, str]:
        """(role, text) of one rendered turn."""
        role, _, rest = piece.removeprefix(START).partition("\n")
        return unquote(role), self.unescape(rest[:rest.index(END)])


def _shared_prefix(a: str, b: str) -> int:
    """Characters that two outputs share from the start."""
    return len(a) if b.startswith(a) else len(os.path.commonprefix([a, b]))


def frame_of(template) -> tuple[str, str]:
    """What the template puts before the first and after the last turn."""
    empty = template.render([])
    if not empty:
        return "", ""
    start = _shared_prefix(empty, template.render([("user", "\x01")]))
    return empty[:start], empty[start:]


def render_turns(template, turns, closing: str, seen: list[tuple[str, str]]):
    """For each (role, text) of ``turns``, after the turns ``seen``: its piece,
    the text's span inside it, and where the prefix before was rewritten, in
    characters before its end (None: nowhere)."""
    end = len(closing)
    before = template.render(seen)
    for turn in turns:
        prefix = [*seen, turn]
        out = template.render(prefix)
        body = before[:len(before) - end]
        common = _shared_prefix(body, out)
        one, two = (template.render([*seen, (turn[0], c)]) for c in "\x01\x02")
        first = _shared_prefix(one, two)
        # both probes hold one character there
        tail = len(one) - first - 1
        yield out[common:len(out) - end], first - common, len(out) - tail - common, (len(body) - common or None)
        seen.append(turn)
        before = out


def format_conversations(df: DataFrame, template, *, loss_roles: tuple[str, ...] = ("assistant",),
                         block_turns: int = BLOCK_TURNS, reach: int = 1) -> DataFrame:
    """One row per turn of ``df`` (conv_id, turn, role, text): its rendered
    ``piece``, the span of the text in it in characters, whether the span is
    under the loss mask, and ``rewrites_from``: how many characters before its
    end the output so far was changed by this turn (null: not changed).  A
    conversation's output is the template's opening, the pieces by (turn, pos)
    and its closing.

    ``reach``: how far below a turn's number the template looks back.  Turns
    more than that before a block are not rendered with it.
    """
    if not 0 <= reach <= block_turns:
        raise ValueError("reach must lie between 0 and block_turns")
    rows = df.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    block = F.floor(F.col("turn") / block_turns)
    near_end = F.pmod(F.col("turn"), F.lit(block_turns)) >= block_turns - reach
    rows = rows.withColumn("block", F.explode(F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block))))
    rows = rows.withColumn("own", block.eqNullSafe(F.col("block")))
    rows = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text")
    kinds = dict(df.select("conv_id", "turn").dtypes)
    schema = PIECES.format(conv=kinds["conv_id"], turn=kinds["turn"])
    roles, _, closing = set(loss_roles), *frame_of(template)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen, numbers, pos = None, [], [], 0
        for batch in batches:
            made: list[tuple] = []
            for conv, turn, role, text, b, own in zip(*(c.to_pylist() for c in batch.columns)):
                if at is None or at != (conv, b):
                    at, seen, numbers, pos = (conv, b), [], [], 0
                if len(seen) >= 2 * block_turns:
                    # many rows with the same few numbers: what is out of reach goes
                    first = next((i for i, t in enumerate(numbers) if t is not None and turn is not None and t >= turn - reach), len(numbers))
                    first = max(first, len(numbers) - block_turns)
                    del seen[:first], numbers[:first]
                numbers.append(turn)
                if not own:
                    seen.append((role, text))
                    continue
                piece, start, end, rewritten = next(render_turns(template, [(role, text)], closing, list(seen)))
                seen.append((role, text))
                made.append((conv, turn, pos, piece, start, end, role in roles, rewritten))
                pos += 1
            yield from _batches(made, batch, ("conv_id", "turn"))

    return ship(rows.select("conv_id", "turn", "role", "text", "block", "own")).mapInArrow(run, schema)


def _batches(made: list[tuple], like: pa.RecordBatch, keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    if made:
        conv, turn, pos, piece, start, end, loss, rewritten = zip(*made)
        kinds = [like.schema.field(k).type for k in keys]
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv, kinds[0]), pa.array(turn, kinds[1]), pa.array(pos, pa.int64()), pa.array(piece, pa.string()),
             pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(loss, pa.bool_()), pa.array(rewritten, pa.int64())],
            ["conv_id", "turn", "pos", "piece", "text_start", "text_end", "loss", "rewrites_from"])


def conversation_digests(pieces: DataFrame, template) -> DataFrame:
    """One row per conversation, read back from the rendered ``pieces`` alone:
    number of turns, digest of role, line break, text, line break of each turn,
    length and digest of the unescaped text under the loss mask, characters of
    the whole output, and the number of turns that rewrote history."""
    kinds = dict(pieces.dtypes)
    frame = sum(map(len, frame_of(template)))
    rows = pieces.select("conv_id", "turn", "pos", "piece", "text_start", "text_end", "loss", "rewrites_from")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, at, state = None, (), None
        done: list[tuple] = []

        def close() -> None:
            turns, loss, *counts = state
            done.append((at[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2] + frame, counts[3]))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done))
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewriting_turns"]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, _, _, piece, start, end, loss, rewritten in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (conv,):
                    if at:
                        close()
                    at, state = (conv,), [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0]
                role, text = template.read(piece)
                state[0].update(f"{role}\n{text}\n".encode())
                state[2] += 1
                if loss:
                    learnt = template.unescape(piece[start:end])
                    state[1].update(learnt.encode())
                    state[3] += len(learnt)
                state[4] += len(piece)
                state[5] += rewritten is not None
            if done:
                yield flush()
        if at:
            close()
            yield flush()

    return ship(rows).mapInArrow(run, DIGESTS.format(conv=kinds["conv_id"]))
