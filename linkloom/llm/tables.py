"""Small helpers around stored tables and joins whose sides may or may not be small."""

import math

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.words import slices

# Most rows of a side that is sent to every executor: short rows, a few MB.
BROADCAST_ROWS = 200_000
# At least about so many parts make up the excerpt of a long text.
PARTS = 8

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def lower_ascii(text):
    """``text`` with A-Z in lower case and everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def small_or_shuffled(frame: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``frame`` marked for broadcast if its counted ``rows`` are at most ``limit``.

    Beyond that the join shuffles both sides, with the same result.
    """
    return F.broadcast(frame) if rows <= limit else frame


def excerpt(text: str, most: int) -> str:
    """``text`` if it has at most ``most`` characters, else parts of it that have no more in all.

    Parts are runs of whole lines, or of words of a longer line, from all over the text: those with the
    least hash, in their order. A text with words gives one with words.
    """
    if len(text) <= most:
        return text
    size, parts, start = max(1, most // PARTS - 1), [], 0
    while start < len(text):
        end = start + size
        if end < len(text):
            end = text.rfind("\n", start, end) + 1 or text.rfind(" ", start, end) + 1 or end
        parts.append(text[start:end])
        start = end
    data = [part.encode() for part in parts]
    filled = [i for i, part in enumerate(data) if part.split()]
    chosen, total = [], 0
    for i in sorted(filled, key=lambda i: (xxhash.xxh64_intdigest(data[i], i), i)):
        if total + len(parts[i]) + 1 > most and chosen:
            break
        chosen.append(i)
        total += len(parts[i]) + 1
    chosen.sort()
    apart = [not parts[i].endswith("\n") and j != i + 1 for i, j in zip(chosen, chosen[1:])] + [False]
    return "".join(parts[i] + "\n" * gap for i, gap in zip(chosen, apart))


def sample_texts(frame: DataFrame, rows: int, max_chars: int, *extra: str, mark=None) -> list[dict]:
    """At most ``rows`` rows of ``frame`` (doc_id, text) on the driver: text, ``extra`` columns and mark.

    Taken are the rows with the least hash of id and text among those whose text has words, so the
    sample depends on neither order nor partitions, and is as large as it may be if there are enough of them. Of
    a text with more than ``max_chars`` characters it has an ``excerpt``; ``mark`` is a function of the whole text
    that gives an integer. Only rows below a hash that about twice as many rows reach are
    sorted, however many there are.
    """
    filled = frame.where(F.col("text").rlike(r"[^ \t\n\x0B\f\r]")).select(
        "text", *extra, F.xxhash64("doc_id", "text").alias("__order")
    )
    kinds = ", ".join(f"{c} {filled.schema[c].dataType.simpleString()}" for c in (*extra, "__order"))

    def run(batches):
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            marks = pa.array([mark(t) if mark else None for t in texts], pa.int64())
            cut = pa.array([excerpt(t, max_chars) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays(
                [cut, *map(part.column, (*extra, "__order")), marks], ["text", *extra, "__order", "mark"]
            )

    def least(some):
        made = some.mapInArrow(run, f"text string, {kinds}, mark bigint")
        return made.orderBy("__order", "text", *extra).limit(rows).drop("__order").toArrow().to_pylist()

    n = filled.count()
    share = min(1.0, (2 * rows + 100) / max(1, n))
    if share == 1:
        return least(filled)
    found = least(filled.where(F.col("__order") < math.floor(-(2**63) + share * 2**64)))
    # Rows that repeat often share a hash, so fewer than expected may lie below.
    return found if len(found) == rows else least(filled)
