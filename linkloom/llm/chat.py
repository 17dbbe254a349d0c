"""Chat formatting with a loss mask aligned by offsets.

A conversation is rendered whole, encoded once with the offsets of its tokens, and the
sorted spans of its trained turns are intersected with the token spans by binary search.

The template of a turn is ``### role:`` LF text LF ``</turn>`` LF. In texts, ``###`` and
``</turn>`` get a backslash in front, after any that stand there already; reading
back takes one away. A control string is one that no backslash precedes, and the template puts
a line feed (or nothing) before its own.
"""

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

HEAD, TAIL = "### ", "</turn>"
TRAINED = ("assistant",)

CONTROL = re.compile(r"(\\*)(###|</turn>)")
ESCAPED = re.compile(r"\\(\\*)(###|</turn>)")
TURN = re.compile(r"### ((?:[^\n\\]|\\.)*):\n((?s:.*?))\n</turn>\n")
BATCH_ROWS = 256


def escape(text: str) -> str:
    """``text`` without control strings of the template; ``unescape`` undoes it."""
    return CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def _role_out(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _role_in(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text)


def render(turns, trained=TRAINED):
    """(text, spans): a conversation in the template, and the (from, to) of its trained texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{HEAD}{_role_out(role)}:\n", escape(text)
        if role in trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}\n{TAIL}\n")
        at += len(parts[-1])
    return "".join(parts), spans


def read_back(formatted: str):
    """The (role, text) turns of a rendered conversation."""
    return [(_role_in(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]


def tokens_in_spans(starts, ends, spans):
    """(first, last) token numbers, last excluded, of the tokens that meet each span.

    Token and turn spans are sorted. A span without characters meets none.
    """
    span = np.array(spans, np.int64).reshape(-1, 2)
    first = np.searchsorted(ends, span[:, 0], "right")
    last = np.searchsorted(starts, span[:, 1], "left")
    return first, np.where(span[:, 0] < span[:, 1], np.maximum(first, last), first)


def loss_pieces(formatted, starts, ends, mask, spans):
    """Texts under the mask, one per span, unescaped: its masked tokens, cut to the span."""
    pieces = []
    for (a, b), first, last in zip(spans, *tokens_in_spans(starts, ends, spans)):
        own = [i for i in range(first, last) if mask[i]]
        if not own:
            pieces.append("")
            continue
        pieces.append(unescape(formatted[max(a, starts[own[0]]) : min(b, ends[own[-1]])]))
    return pieces


def conversations(rows: DataFrame, id_col="conv_id") -> DataFrame:
    """(id, turns): one row per conversation, its turns in order of turn, role and text."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.groupBy(F.col(id_col).alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )


def format_chats(
    rows: DataFrame, tokenizer_file: str, trained=TRAINED, id_col: str = "conv_id"
) -> DataFrame:
    """Every conversation of ``rows`` (id, turn, role, text) rendered, encoded and masked.

    Returns id, formatted, token_ids, token_starts, token_ends (offsets in code
    points), loss_mask (per token) and spans (from and to of each trained text).
    ``tokenizer_file`` must lie at the same path on all machines.

    A token is under the mask if it meets a trained span; spans tell which of its
    characters count. NULL texts and roles are taken as empty; an empty trained
    text has an empty span. Turns with the same number are ordered by role and text, NULL numbers
    come first, repeated rows are repeated turns, and rows without id form one
    conversation. An empty table gives an empty one. Other columns are not read.
    A conversation is one row and must fit a task.
    """
    grouped = conversations(rows, id_col)
    id_type = grouped.schema["conv_id"].dataType.simpleString()

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(tokenizer_file)
        tokenizer.no_truncation()
        tokenizer.encode_special_tokens = True
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                made = [
                    render([(t["role"], t["text"]) for t in turns], trained)
                    for turns in part.column("turns").to_pylist()
                ]
                found = tokenizer.encode_batch([m[0] for m in made], add_special_tokens=False)
                out = [[] for _ in range(6)]
                for (text, spans), encoded in zip(made, found):
                    offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
                    mask = np.zeros(len(offsets), bool)
                    for first, last in zip(*tokens_in_spans(offsets[:, 0], offsets[:, 1], spans)):
                        mask[first:last] = True
                    values = (text, encoded.ids, offsets[:, 0], offsets[:, 1], mask)
                    for column, value in zip(out, values):
                        column.append(value)
                    out[5].append([{"from": a, "to": b} for a, b in spans])
                whole, bits = pa.list_(pa.int32()), pa.list_(pa.bool_())
                span = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
                kinds = [pa.string(), whole, whole, whole, bits, span]
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                    ["conv_id", "formatted", "token_ids", "token_starts", "token_ends", "loss_mask", "spans"],
                )

    return grouped.mapInArrow(
        run,
        f"conv_id {id_type}, formatted string, token_ids array<int>, token_starts array<int>, "
        "token_ends array<int>, loss_mask array<boolean>, spans array<struct<from:int,to:int>>",
    ).withColumnRenamed("conv_id", id_col)
