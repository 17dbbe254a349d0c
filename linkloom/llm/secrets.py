"""Secrets in texts: three patterns, and strings that a tokenizer finds hard.

A vocabulary of byte pairs has long pieces for words, names and code, and few for random strings, of which it makes
many short tokens. Runs of the characters of keys that hold letters and digits and give few characters per token
are therefore taken as secrets, unless they have the form of a known kind of digest or of an identifier. The patterns'
spans stay as they are; a random string that meets one of them is not reported again.
"""

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.runs import byte_table, find_runs, text_bytes
from linkloom.llm.words import slices

# In the order in which spans that start together are listed.
ASSIGN, ACCESS, HEX, RANDOM = KINDS = ("assign", "access", "hex", "random")
# The patterns and the least sizes of what they find.
ASSIGNED = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGNED_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
ACCESS_HEAD = b"AKIA"
# Every assignment has one of these, lowered.
MARKS = (b"passw", b"secret", b"token", b"api")

# Random strings: least size, and characters per token from which a string is no longer one.
RANDOM_CHARS, MAX_RATIO = 16, 2.2
# Sizes of usual digests in hex digits.
DIGEST_SIZES = (32, 40, 48, 56, 64, 96, 128)
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
# Parts of an identifier: words with a vowel, in one case or with a capital, words of two letters that stand alone, short numbers.
WORD_PART = re.compile(
    r"[A-Z]?[a-z]{3,}|[A-Z]{3,}(?![a-z])|(?<![A-Za-z0-9])[a-z]{2}(?![A-Za-z0-9])|(?<![0-9])[0-9]{1,4}(?![0-9])"
)
VOWEL = re.compile(r"[aeiouyAEIOUY0-9]")
WORD_SHARE = 0.7
HELD_RATIOS = 20_000
SLICE_BYTES = 1 << 22

IS_HEX = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 102)
IS_ACCESS = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90)
IS_KEY = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b in b"+/_-")


def load_encoding(ranks_file: str, pattern: str):
    """A tiktoken encoding from a file of ranks."""
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def known_form(text: str) -> bool:
    """Whether ``text`` looks like a digest, a UUID or an identifier made of words and short numbers."""
    if UUID.fullmatch(text) or (len(text) in DIGEST_SIZES and DIGEST.fullmatch(text)):
        return True
    letters = sum(c.isalnum() for c in text)
    in_words = sum(len(m[0]) for m in WORD_PART.finditer(text) if VOWEL.search(m[0]))
    return in_words >= WORD_SHARE * letters


def is_random(text: str, encoding, max_ratio: float = MAX_RATIO) -> bool:
    """Whether ``text`` has letters and digits, few characters per token and no known form."""
    mixed = any(c.isdigit() for c in text) and any(c.isalpha() for c in text)
    if not mixed or known_form(text):
        return False
    return len(text) < max_ratio * len(encoding.encode_ordinary(text))


def assignments(text: str):
    """(start, end) of the assignments of long enough values."""
    return [m.span() for m in ASSIGNED.finditer(text) if len(m[2]) >= ASSIGNED_CHARS]


def long_runs(inside, offsets, least):
    starts, ends, owner = find_runs(inside, offsets)
    long_enough = ends - starts >= least
    return starts[long_enough], ends[long_enough], owner[long_enough]


def text_spans(column, judge):
    """(kind, start, end) lists, one per text of the Arrow column; ``judge`` tells random strings."""
    data, offsets = text_bytes(column)
    spans = [[] for _ in range(len(column))]
    # Number of characters before each byte.
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])

    def add(kind, text, start, end):
        first = chars[offsets[text]]
        spans[text].append((kind, int(chars[start] - first), int(chars[end] - first)))

    for text, whole in enumerate(column.to_pylist()):
        if whole:
            lowered = data[offsets[text] : offsets[text + 1]].tobytes().lower()
            if any(mark in lowered for mark in MARKS):
                spans[text] += [(0, *span) for span in assignments(whole)]
    for start, end, text in zip(*long_runs(IS_ACCESS[data], offsets, ACCESS_CHARS)):
        at = data[start:end].tobytes().find(ACCESS_HEAD)
        if at >= 0 and end - start - at >= ACCESS_CHARS:
            add(1, text, start + at, end)
    for start, end, text in zip(*long_runs(IS_HEX[data], offsets, HEX_CHARS)):
        add(2, text, start, end)
    for start, end, text in zip(*long_runs(IS_KEY[data], offsets, RANDOM_CHARS)):
        a, b = (int(chars[i] - chars[offsets[text]]) for i in (start, end))
        if any(a < to and since < b for kind, since, to in spans[text] if kind < 3):
            continue
        if judge(data[start:end].tobytes().decode()):
            add(3, text, start, end)
    return [sorted(((k, a, b) for k, a, b in found), key=lambda s: (s[1], s[0])) for found in spans]


def find_secrets(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    max_ratio: float = MAX_RATIO,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Spans of possible secrets in every whole text.

    Returns id and spans, an array of (kind, start, end) in code points, end exclusive, by start and then in the
    order of ``KINDS``: ``assign`` (a named secret with a value of 12 characters or more), ``access`` (AKIA and 14 or more
    capitals and digits), ``hex`` (16 or more lower-case hex digits) and ``random`` (runs of 16 or more key characters
    that meet none of those, with less than ``max_ratio`` characters per token). ``ranks_file`` and ``pattern``
    make up the tiktoken vocabulary; the file must lie at the same path on all machines.

    NULL and empty texts have no spans. Each row is judged on its own, whether ids repeat or are NULL. An empty table
    gives an empty one. Other columns are not read. Nothing is shuffled.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = own.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        encoding, known = None, {}

        def judge(text):
            nonlocal encoding
            if text not in known:
                encoding = encoding or load_encoding(ranks_file, pattern)
                if len(known) >= HELD_RATIOS:
                    known.clear()
                known[text] = is_random(text, encoding, max_ratio)
            return known[text]

        for part in slices(batches, limit=SLICE_BYTES):
            found = [
                [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]
                for spans in text_spans(part.column("text"), judge)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "spans"]
            )

    return own.mapInArrow(
        run, f"doc_id {id_type}, spans array<struct<kind:string,start:int,end:int>>"
    ).withColumnRenamed("doc_id", id_col)
