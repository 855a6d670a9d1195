"""Chat formatting by prefix-target expansion, and the way back."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: The template marks a turn as OPEN role BETWEEN text CLOSE.  Inside roles and
#: texts the characters that could begin a mark carry a backslash.
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"
#: Rows are handed back in batches of about so many characters.
BATCH_CHARS = 4_000_000

_TURN = re.compile(r"### ((?:[^\\:#]|\\.)*): ((?:[^\\<#]|\\.)*)</turn>\n", re.S)


def escape(text: str, marks: str = r"[\\#<]") -> str:
    return re.sub(marks, r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def turn_text(role: str | None, text: str | None) -> tuple[str, str]:
    """A turn's head (up to its text) and its escaped text."""
    return OPEN + escape(role or "", r"[\\#:]") + BETWEEN, escape(text or "")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text; raises when it is not wholly made of turns."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def examples(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Training examples (conv_id, part, text, loss_start, loss_end).

    Every assistant turn becomes an example of its own: all turns before it as
    context, then its reply, of which only the text between the character
    offsets ``loss_start`` and ``loss_end`` is trained on.  Turns behind the last
    reply come as one more row without loss (null offsets), so the output holds
    every turn.  ``part`` counts a conversation's rows from 0.

    Conversations are dealt by id and sorted by turn; a task reads them as a
    stream and holds one conversation's text, which its last example holds too.
    Nulls: a row with null id is a conversation of one turn and is dealt by its
    content; null turns come first; null roles and texts are empty.  Equal turn
    numbers are ordered by role, then text; repeated rows are turns each.  Other
    columns are not read.
    """
    t = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                     F.col(text_col).alias("text"))
    key = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")).otherwise(F.xxhash64("conv_id"))
    t = t.repartition(key).sortWithinPartitions("conv_id", "turn", "role", "text")
    id_type = t.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", id_type), StructField("part", LongType()), StructField("text", StringType()),
                         StructField("loss_start", LongType()), StructField("loss_end", LongType())])

    def expand(batches):
        rows, size, now, prefix, part, pending = [], 0, None, "", 0, False
        for b in batches:
            ids = b.column(0)
            for conv, role, text in zip(ids.to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if conv is None or conv != now:
                    if pending:
                        rows.append((now, part, prefix, None, None))
                        size += len(prefix)
                    now, prefix, part, pending = conv, "", 0, False
                head, body = turn_text(role, text)
                start = len(prefix) + len(head)
                prefix += head + body + CLOSE
                pending = role != ASSISTANT
                if not pending:
                    rows.append((now, part, prefix, start, start + len(body)))
                    size, part = size + len(prefix), part + 1
                if size >= BATCH_CHARS:
                    yield _batch(rows, ids.type)
                    rows, size = [], 0
        if pending:
            rows.append((now, part, prefix, None, None))
        if rows:
            yield _batch(rows, ids.type)

    def _batch(rows, kind):
        cols = zip(*rows)
        types = (kind, pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], names=schema.names)
    return t.mapInArrow(expand, schema)


def read_back(rows: DataFrame) -> DataFrame:
    """Digest of the output of ``examples`` as it stands (a conversation's rows
    follow each other), made from the formatted texts and masks alone: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples."""
    d = rows.select("conv_id", "part", "text", "loss_start", "loss_end")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]
    schema = StructType([d.schema["conv_id"], *(StructField(n, StringType() if n.endswith("sha256") else LongType()) for n in names[1:])])

    def digest(batches):
        conv, text, loss, chars, formatted, trained = None, None, None, 0, 0, 0

        def told():
            turns = read_turns(text)
            h = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode())
            return (conv, len(turns), h.hexdigest(), chars, loss.hexdigest(), formatted, trained)
        for b in batches:
            out = []
            for c, part, x, s, e in zip(*(col.to_pylist() for col in b.columns)):
                if part == 0:
                    if text is not None:
                        out.append(told())
                    conv, loss, chars, formatted, trained = c, hashlib.sha256(), 0, 0, 0
                text, formatted = x, formatted + len(x)
                if s is not None:
                    reply = unescape(x[s:e])
                    loss.update(reply.encode())
                    chars, trained = chars + len(reply), trained + 1
            if out:
                yield _table(out, b.column(0).type)
            kind = b.column(0).type
        if text is not None:
            yield _table([told()], kind)

    def _table(out, kind):
        types = [kind, *(pa.string() if n.endswith("sha256") else pa.int64() for n in names[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), types)], names=names)
    return d.mapInArrow(digest, schema)
