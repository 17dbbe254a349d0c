"""Spelling variants: words one edit apart, and the more frequent form that each leads to.

The vocabulary lies in a sorted list, once forwards and once with its words reversed. A word is looked up by
running down the list with the rows of a banded edit matrix: a row is kept for every letter of the prefix that
an entry shares with the one before it, so only the rest of an entry takes new rows, and once a row exceeds one
edit, all entries that share the prefix so far are skipped. If two words are one edit apart, they share the first or
the last half of the shorter one; so a word need only be held against the entries of the forward list that begin
with its first half, and of the reversed list that begin with its reversed last half.

The list is stored sorted and cut into blocks of bounded size. A word goes to the blocks its half may begin an
entry of, unless the prefix that a whole block shares already exceeds one edit; the same scan finds these blocks.
Words that go to one block travel together in rows of bounded size.
"""

from bisect import bisect_left
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.runs import LOWERED, byte_table, crc_matrices, cut_out, find_runs, text_bytes
from linkloom.llm.words import slices
from linkloom.sources.workspace import Workspace

MIN_LETTERS, MIN_COUNT = 5, 3
# Entries of a block, a power of two, and words in one row that is sent to a block.
BLOCK, BATCH = 4_096, 2_048
# At most about so many blocks: beyond that blocks grow, as the bounds of all blocks go to every task.
MOST_BLOCKS = 100_000
# Letters of a bound that are kept. A cut bound lets more words through to a block and loses none.
BOUND_LETTERS = 64
SLICE_BYTES = 1 << 22
# Distinct words that a task counts before it sends the counts on.
HELD_WORDS = 300_000
LAST = chr(0x10FFFF)

# --- words

ASCII_LETTER = byte_table(lambda b: 65 <= b <= 90 or 97 <= b <= 122)
# U+00C0 to U+00FF are this byte and one of 0x80 to 0xBF.
LEAD = 0xC3


def letter_runs(column):
    """(runs, owner, letters): lower-cased runs of letters of the texts, their text and their sizes."""
    data, offsets = text_bytes(column)
    inside = ASCII_LETTER[data]
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == LEAD) & (data[1:] >= 0x80) & (data[1:] <= 0xBF)
    inside = inside | second
    inside[:-1] |= second[1:]
    data = LOWERED[data]
    starts, ends, owner = find_runs(inside, offsets)
    seen = np.concatenate([[0], np.cumsum(second)])
    letters = ends - starts - (seen[ends] - seen[starts])
    long_enough = letters >= MIN_LETTERS
    starts, ends = starts[long_enough], ends[long_enough]
    return cut_out(data, starts, ends), owner[long_enough], letters[long_enough]


def word_counts(docs: DataFrame, drop_every: int | None) -> DataFrame:
    """(word, n) over all texts of ``docs`` (doc_id, text), words of at least ``MIN_LETTERS`` letters.

    Where ``drop_every`` divides the CRC-32 of id and run, the run loses the letter at CRC modulo length.
    """

    def run(batches):
        held = {}

        def sent():
            out = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
            )
            held.clear()
            return out

        for part in slices(batches, limit=SLICE_BYTES):
            found, owner, letters = letter_runs(part.column("text"))
            if not len(found):
                continue
            coded = found.dictionary_encode()
            code, size = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            total = np.bincount(code, minlength=size)
            if drop_every:
                # All runs of one document that are the same change in the same way.
                place, pairs = pd.factorize(owner * size + code)
                document, word = np.divmod(pairs, size)
                heads = [f"{i if i is not None else ''}:".encode() for i in part.column("doc_id").to_pylist()]
                before = crc_matrices(pa.array(heads, pa.large_binary()))
                h = crc_matrices(coded.dictionary.take(pa.array(word)), before[document])
                changed = np.flatnonzero(h % np.uint32(drop_every) == 0)
                times = np.bincount(place, minlength=len(pairs))[changed]
                np.subtract.at(total, word[changed], times)
                whole = coded.dictionary.take(pa.array(word[changed])).cast(pa.large_string()).to_pylist()
                for text, crc, n in zip(whole, h[changed].tolist(), times.tolist()):
                    at = crc % len(text)
                    if len(text) > MIN_LETTERS:
                        text = text[:at] + text[at + 1 :]
                        held[text] = held.get(text, 0) + n
            for text, n in zip(coded.dictionary.cast(pa.large_string()).to_pylist(), total.tolist()):
                if n:
                    held[text] = held.get(text, 0) + n
            if len(held) >= HELD_WORDS:
                yield sent()
        yield sent()

    counted = docs.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# --- banded rows of the edit matrix

# A row holds, for one prefix of an entry, the edits to the three prefixes of the word whose length differs by
# one at most, as digits 0, 1, and 2 for more. Rows are numbered 0 to 26.
DEAD = 26


def _next_rows():
    """The row after each row, by which of the word's three letters the entry's next letter equals."""
    out = []
    for row in range(27):
        a, b, c = row // 9, row // 3 % 3, row % 3
        for same in range(8):
            x = min(a + (not same & 1), b + 1, 2)
            y = min(b + (not same & 2), c + 1, x + 1, 2)
            z = min(c + (not same & 4), y + 1, 2)
            out.append(x * 9 + y * 3 + z)
    return out


NEXT = _next_rows()
START = 2 * 9 + 0 * 3 + 1


class SortedList(NamedTuple):
    """Entries, ``lcp`` letters that each shares with the one before, and ``jump``: the next entry that shares less."""

    entries: list
    lcp: list
    jump: list


def sorted_list(entries) -> SortedList:
    lcp = [0] * len(entries)
    for i in range(1, len(entries)):
        a, b = entries[i - 1], entries[i]
        n, most = 0, min(len(a), len(b))
        while n < most and a[n] == b[n]:
            n += 1
        lcp[i] = n
    jump = [len(entries)] * len(entries)
    for i in range(len(entries) - 2, -1, -1):
        j = i + 1
        while j < len(entries) and lcp[j] >= lcp[i]:
            j = jump[j]
        jump[i] = j
    return SortedList(entries, lcp, jump)


def scan(word, found: SortedList, start: int, end: int):
    """(entry number, row after its last letter) of the entries from ``start`` on whose row is alive to the end.

    The digit of a row for a prefix of the word of the same length comes second. Entries need not be unique.
    """
    entries, lcp, jump = found
    size = len(word)
    rows = [START]
    i, known = start, 0
    while i < end:
        entry = entries[i]
        del rows[known + 1 :]
        row = rows[known]
        depth, length = known, len(entry)
        while depth < length and row != DEAD:
            letter = entry[depth]
            same = 0
            if depth < size:
                if word[depth] == letter:
                    same = 2
                if depth + 1 < size and word[depth + 1] == letter:
                    same += 4
            if 0 < depth <= size and word[depth - 1] == letter:
                same += 1
            row = NEXT[row * 8 + same]
            rows.append(row)
            depth += 1
        if row != DEAD:
            yield i, row
        i += 1
        if row == DEAD:
            while i < end and lcp[i] >= depth:
                i = jump[i]
        if i < end:
            known = min(lcp[i], len(rows) - 1)


def one_edit(word, entry, row):
    """Whether ``row``, the last of ``entry``, says that it is exactly one edit from ``word``."""
    by = len(word) - len(entry)
    return -1 <= by <= 1 and row // (9, 3, 1)[by + 1] % 3 == 1


def half(word):
    """What ``word`` (with its direction in front) shares with a word one edit away, in one direction or the other."""
    return word[: 1 + (len(word) - 2) // 2]


def near_entries(word, found: SortedList):
    """Numbers of the entries one edit away that begin with the first half of ``word``."""
    head = half(word)
    start = bisect_left(found.entries, head)
    end = bisect_left(found.entries, head + LAST)
    return [i for i, row in scan(word, found, start, end) if one_edit(word, found.entries[i], row)]


# --- blocks


class Blocks(NamedTuple):
    numbers: list
    lows: list
    highs: list
    shared: SortedList


def block_bounds(listed: DataFrame, block) -> Blocks:
    """Cut bounds and shared prefix of every block, on the driver: at most about ``MOST_BLOCKS`` short rows."""
    cut = F.substring("entry", 1, BOUND_LETTERS)
    found = (
        listed.groupBy(block.alias("block"))
        .agg(F.min(cut).alias("low"), F.max(cut).alias("high"))
        .orderBy("block")
        .collect()
    )
    shared = []
    for r in found:
        n = 0
        while n < min(len(r["low"]), len(r["high"])) and r["low"][n] == r["high"][n]:
            n += 1
        shared.append(r["low"][:n])
    return Blocks(
        [r["block"] for r in found],
        [r["low"] for r in found],
        [r["high"] for r in found],
        sorted_list(shared),
    )


def blocks_for(word, blocks: Blocks):
    """Numbers of the blocks that may hold an entry which begins with the half of ``word`` and is one edit away."""
    head = half(word)[:BOUND_LETTERS]
    start, end = bisect_left(blocks.highs, head), bisect_left(blocks.lows, head + LAST)
    if end - start == 1:
        return blocks.numbers[start:end]
    return [blocks.numbers[i] for i, _ in scan(word, blocks.shared, start, end)]


def near_words(vocabulary: DataFrame, work: Workspace) -> DataFrame:
    """(word, n_near, near, near_n) of the words of ``vocabulary`` (word, n) that have near words.

    ``near`` is the near word of largest n, the smaller one on ties. The sorted list is stored in ``work``.
    """
    both = vocabulary.select(
        F.inline(
            F.array(
                F.struct(F.concat(F.lit("<"), "word").alias("entry"), "n"),
                F.struct(F.concat(F.lit(">"), F.reverse("word")).alias("entry"), "n"),
            )
        )
    )
    listed, seen = work.store(
        both.orderBy("entry").withColumn("place", F.monotonically_increasing_id()),
        "listed",
        rows=F.count("*"),
    )
    size = BLOCK
    while (seen["rows"] or 0) > size * MOST_BLOCKS:
        size *= 2
    block = F.shiftright("place", size.bit_length() - 1)
    blocks = block_bounds(listed, block)

    def route(batches):
        for batch in batches:
            waiting = {}
            for entry in batch.column("entry").to_pylist():
                for number in blocks_for(entry, blocks):
                    waiting.setdefault(number, []).append(entry)
            rows = [
                (number, entries[i : i + BATCH])
                for number, entries in waiting.items()
                for i in range(0, len(entries), BATCH)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.string()))],
                ["block", "looked_up"],
            )

    def look_up(batches):
        held = None
        for batch in batches:
            out = [[], [], [], []]
            # Row by row, as each holds a whole block.
            for at in range(batch.num_rows):
                number = batch.column("block")[at].as_py()
                if number != held:
                    pairs = batch.column("entries")[at].values
                    pairs = sorted(zip(pairs.field("entry").to_pylist(), pairs.field("n").to_pylist()))
                    found, counts = sorted_list([e for e, _ in pairs]), [n for _, n in pairs]
                    held = number
                for entry in batch.column("looked_up")[at].as_py():
                    turned = entry[0] == ">"
                    head, n_near, best = half(entry[0] + entry[:0:-1]), 0, None
                    for i in near_entries(entry, found):
                        other = found.entries[i]
                        # What shares the first half was found in the forward list already.
                        if turned and other[:0:-1].startswith(head[1:]):
                            continue
                        n_near += 1
                        rank = (-counts[i], other[:0:-1] if turned else other[1:])
                        best = rank if best is None or rank < best else best
                    if n_near:
                        out[0].append(entry[:0:-1] if turned else entry[1:])
                        out[1].append(n_near)
                        out[2].append(best[1])
                        out[3].append(-best[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.string(), pa.int64(), pa.string(), pa.int64()))],
                ["word", "n_near", "near", "near_n"],
            )

    lists = listed.groupBy(block.alias("block")).agg(F.collect_list(F.struct("entry", "n")).alias("entries"))
    routed = listed.select("entry").mapInArrow(route, "block bigint, looked_up array<string>")
    found = lists.join(routed, "block").select("block", "entries", "looked_up").mapInArrow(
        look_up, "word string, n_near bigint, near string, near_n bigint"
    )
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.order")).alias("near_n"))
    )


# --- forms and roots


def follow(forms: DataFrame, work: Workspace) -> DataFrame:
    """(word, root) for every row of ``forms`` (word, form): the end of its chain of forms.

    Each round replaces the end known so far by that one's end, so chains halve. Counts at least double from form
    to form, so a chain has at most 63 links, and six rounds and one that changes nothing are enough.
    """
    ends, seen = work.store(forms.select("word", F.col("form").alias("root")), "ends-0", n=F.count("*"))
    moved, number = seen["n"], 0
    while moved:
        after = ends.select(F.col("word").alias("at"), F.col("root").alias("further"))
        stepped = ends.join(after, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        number += 1
        ends, seen = work.store(stepped, f"ends-{number}", moved=F.count_if("moved"))
        ends, moved = ends.drop("moved"), seen["moved"]
        work.drop(f"ends-{number - 1}")
    return ends


def group_variants(
    docs: DataFrame,
    drop_every: int | None = None,
    min_count: int = MIN_COUNT,
    factor: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Words of all texts with the more frequent spelling that each leads to.

    Words are the lower-cased (A-Z only) runs ``[A-Za-z\\u00C0-\\u00FF]+`` with at least five letters that occur ``min_count``
    times or more. Two are near if one inserted, deleted or replaced letter makes one of the other. The form of a word
    is its near word of largest n, the smaller one on ties, if that n is at least ``factor`` times (two or more) its
    own; its root is where the chain of forms ends. ``drop_every`` plants typing errors: it deletes one letter of the runs
    whose CRC-32 with the id it divides.

    Returns word, form, root, n, n_near and form_n, one row per word; form and form_n are NULL where there is none.
    NULL texts have no words; NULL ids count as empty, and rows that share an id change equal runs alike. Repeated rows count each. An
    empty table gives an empty one. Other columns are not read. The result reads stored tables.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2, or chains of forms might not end")
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    work = Workspace(docs.sparkSession)
    vocabulary, _ = work.store(
        word_counts(own, drop_every).where(F.col("n") >= min_count), "vocabulary"
    )
    near, _ = work.store(near_words(vocabulary, work), "near")
    work.drop("listed")
    has_form = F.col("near_n") >= factor * F.col("n")
    words, _ = work.store(
        vocabulary.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("near")).alias("form"),
            F.when(has_form, F.col("near_n")).alias("form_n"),
        ),
        "words",
    )
    work.drop("vocabulary", "near")
    roots = follow(words.where(F.col("form").isNotNull()), work)
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
