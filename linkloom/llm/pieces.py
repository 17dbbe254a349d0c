"""SentencePiece encoding and decoding through tables of distinct chunks.

With the models taken here white space becomes a marker that only opens a piece, so no
piece spans the place before a marker, and none spans a line feed, which only bytes
can spell. Texts are cut at these places. Each task takes its texts in
blocks of bounded size and keeps a table of the distinct chunks it has met, each with its
pieces and the text they decode to, segmented once. Ids and decoded text come back
to the chunk's places by number.

The table is a task's own and bounded, so nothing is shuffled, and a lost executor costs the
tasks it had at work. One table for the whole corpus would have to bring every block's
chunks, and the blocks themselves, together by key: more than twice the input.
"""

import hashlib
import os
import re
from contextlib import contextmanager
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.runs import text_bytes
from linkloom.llm.words import run_hashes, slices

MARK = "▁"
LINE_FEED = "\n"
# Bytes of text that are cut at a time; a longer text comes alone.
BLOCK_BYTES = 2 << 20
# A task's table starts anew after the block with which it reaches this many chunks (about 40 MB).
MOST_CHUNKS = 200_000
# The same for a table that keeps hashes (about 50 bytes a chunk).
MOST_HASHED = 500_000
# Chunks that the library is given at a time, as lines of one text.
LINES = 64

# Kinds of bytes: spaces, line feeds and all others.
OTHER, SPACE, FEED = range(3)
KIND = np.zeros(256, np.uint8)
KIND[ord(" ")], KIND[ord(LINE_FEED)] = SPACE, FEED


def load(model_file: str) -> sentencepiece.SentencePieceProcessor:
    """The model, after a check that its pieces cannot cross the places where texts are cut."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_file, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
        raise ValueError("texts are taken as they are: the model must not normalize them")
    if not (rules.escape_whitespaces and rules.add_dummy_prefix):
        raise ValueError("the model must mark white space and open texts with a marker")
    if not model.trainer_spec.byte_fallback:
        raise ValueError("the model must spell a line feed as a byte")
    # Normal and user-defined pieces; the others match no text.
    spelled = [p.piece for p in model.pieces if p.type in (1, 4)]
    if any(re.search(f"[^{MARK}]{MARK}|{LINE_FEED}", piece) for piece in spelled):
        raise ValueError("a piece crosses a white space marker or a line feed")
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def cut_chunks(column):
    """(chunks, counts): the chunks of all texts of an Arrow column in a row, and how many each text has.

    Joined they are the text behind the space that its marker stands for. A chunk is a run of spaces with the
    run of other characters behind it, either alone, or a run of line feeds. A marker in the text is a space to the
    model, and is one here: most chunks are ASCII then. NULL is the empty text, which has none.
    """
    text = pc.replace_substring(pc.fill_null(column, ""), MARK, " ")
    empty, space = pa.scalar("", text.type), pa.scalar(" ", text.type)
    text = pc.if_else(pc.equal(text, empty), empty, pc.binary_join_element_wise(empty, text, space))
    data, offsets = text_bytes(text)
    kind = KIND[data]
    starts = np.zeros(len(data) + 1, bool)
    starts[1:-1] = (kind[1:] != kind[:-1]) & ~((kind[:-1] == SPACE) & (kind[1:] == OTHER))
    starts[offsets] = True
    at = np.flatnonzero(starts)
    found = pa.Array.from_buffers(
        pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]
    )
    return found, np.diff(np.searchsorted(at, offsets))


def chunks(text: str) -> list[str]:
    """Chunks of one text."""
    return cut_chunks(pa.array([text], pa.string()))[0].to_pylist()


class Numbers(dict):
    """Numbers for new keys in the order in which they are asked for, from 2 on."""

    def __missing__(self, key):
        self[key] = number = len(self) + 2
        return number


class ChunkTable:
    """Distinct chunks by number, with pieces and decoded text once segmented.

    Number 0 is the begin id and number 1 the end id; neither decodes to anything.
    """

    def __init__(self, model, decode=True):
        self.model = model
        self.numbers = Numbers()
        self.segmented = 0
        self.ids = np.array([model.bos_id(), model.eos_id()], np.uint32)
        self.first, self.size = np.array([0, 1]), np.array([1, 1])
        self.decoded = ["", ""] if decode else None
        # A text of its own would open with a marker, so each chunk follows a line feed,
        # which no piece joins to it.
        *self.opening, self.feed = model.encode(LINE_FEED)

    def places(self, column):
        """(numbers, sizes): the numbers of all texts' chunks in a row, with begin and end, and how many each text has.

        Each distinct chunk of the column is looked up once.
        """
        found, counts = cut_chunks(column)
        numbers, sizes = self.number_chunks(found), counts + 2
        ends = np.cumsum(sizes)
        places = np.empty(sizes.sum(), np.int64)
        inner = np.ones(len(places), bool)
        inner[ends - sizes] = inner[ends - 1] = False
        places[ends - sizes], places[ends - 1] = 0, 1
        places[inner] = numbers
        return places, sizes

    def number_chunks(self, found):
        """The number of each chunk of an Arrow array."""
        coded = found.dictionary_encode()
        number = np.fromiter(
            map(self.numbers.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary)
        )
        return number[coded.indices.to_numpy()]

    def fresh(self):
        """(feeds, lines, chunks) of the chunks that came since this was last asked, in the order of their numbers.

        ``feeds`` has the length of those that are line feeds, else 0; ``lines`` are texts of ``LINES`` of the others.
        """
        found = list(islice(self.numbers, self.segmented, None))
        self.segmented = len(self.numbers)
        feeds = np.fromiter((len(c) if c[0] == LINE_FEED else 0 for c in found), np.int64, len(found))
        others = [c for c in found if c[0] != LINE_FEED]
        parts = [others[i : i + LINES] for i in range(0, len(others), LINES)]
        return feeds, ["".join(LINE_FEED + c for c in part) for part in parts], found

    def segment(self):
        """Bring ``ids``, ``first`` and ``size`` (where each chunk's pieces are) and ``decoded`` up to date."""
        feeds, lines, fresh = self.fresh()
        found = self.model.encode(lines, num_threads=1)
        flat = np.fromiter(chain.from_iterable(i[len(self.opening) :] for i in found), np.uint32)
        before = np.flatnonzero(flat == self.feed)
        first = np.full(len(feeds), len(self.ids) + len(flat))
        first[feeds == 0] = len(self.ids) + before + 1
        size = feeds.copy()
        size[feeds == 0] = np.diff(before, append=len(flat)) - 1
        run = np.full(feeds.max(initial=0), self.feed, np.uint32)
        self.ids = np.concatenate([self.ids, flat, run])
        self.first, self.size = np.concatenate([self.first, first]), np.concatenate([self.size, size])
        if self.decoded is not None:
            texts = self.model.decode(found, num_threads=1) if found else []
            said = chain.from_iterable(t.split(LINE_FEED)[1:] for t in texts)
            self.decoded.extend(c if c[0] == LINE_FEED else next(said) for c in fresh)

    def lay_out(self, places):
        """Ids of a list of places."""
        sizes = self.size[places]
        starts = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(self.first[places] - starts, sizes) + np.arange(sizes.sum())]

    def texts_ids(self, places, sizes):
        """The ids of each text, from what ``places`` gives; ``segment`` comes before."""
        if not len(sizes):
            return []
        n = np.add.reduceat(self.size[places], np.cumsum(sizes) - sizes)
        return np.split(self.lay_out(places), np.cumsum(n)[:-1])

    def renewed(self):
        """This table, or an empty one if this has grown to its bound."""
        if len(self.numbers) < MOST_CHUNKS:
            return self
        return ChunkTable(self.model, self.decoded is not None)


class HashedChunkTable(ChunkTable):
    """A table that knows chunks by a 64-bit hash: those with one hash are taken as the same.

    It keeps no text of a chunk, so it may have more of them, and looks up all chunks of a column at once. What it
    gives does not depend on what it has met before, so tasks may hand it on.
    """

    def __init__(self, model):
        super().__init__(model, decode=False)
        self.keys, self.key_numbers, self.waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def number_chunks(self, found):
        data, offsets = text_bytes(found)
        kinds, back = np.unique(run_hashes(data, offsets[:-1], offsets[1:]), return_inverse=True)
        # Some place of each kind.
        example = np.empty(len(kinds), np.int64)
        example[back] = np.arange(len(back))
        at = np.searchsorted(self.keys, kinds)
        known = np.zeros(len(kinds), bool)
        inside = np.flatnonzero(at < len(self.keys))
        known[inside] = self.keys[at[inside]] == kinds[inside]
        number = np.empty(len(kinds), np.int64)
        number[known] = self.key_numbers[at[known]]
        new = np.arange(len(kinds) - np.count_nonzero(known)) + len(self.keys) + 2
        number[~known] = new
        self.waiting.append(found.take(pa.array(example[~known])))
        self.keys = np.insert(self.keys, at[~known], kinds[~known])
        self.key_numbers = np.insert(self.key_numbers, at[~known], new)
        return number[back]

    def fresh(self):
        found, self.waiting = pa.chunked_array(self.waiting, pa.large_string()).combine_chunks(), []
        data, offsets = text_bytes(found)
        is_feed = data[offsets[:-1]] == ord(LINE_FEED)
        others = found.filter(pa.array(~is_feed))
        at = pa.array([*range(0, len(others), LINES), len(others)], pa.int32())
        lines = pc.binary_join(pa.ListArray.from_arrays(at, others.cast(pa.string())), LINE_FEED).to_pylist()
        return np.where(is_feed, np.diff(offsets), 0), [LINE_FEED + line for line in lines], None

    def renewed(self):
        return self if len(self.keys) < MOST_HASHED else HashedChunkTable(self.model)


# The table that the last task of this process left, by its model file.
_left: dict[tuple, HashedChunkTable] = {}


@contextmanager
def kept_table(model_file: str):
    """A list with the table to go on with: that of the last task of this Python process, else a new one.

    What the list has at the end is left to the next task; a task that fails leaves none.
    """
    found = os.stat(model_file)
    name = (model_file, found.st_mtime_ns, found.st_size)
    table = _left.pop(name, None)
    held = [table or HashedChunkTable(load(model_file))]
    yield held
    _left.clear()
    _left[name] = held[0]


def encode_block(texts, table):
    """(ids, decoded text) of each text of an Arrow column or list, through a table of distinct chunks."""
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    places, sizes = table.places(column)
    table.segment()
    decoded, at = table.decoded, 0
    for ids, size in zip(table.texts_ids(places, sizes), sizes.tolist()):
        joined = "".join([decoded[p] for p in places[at : at + size].tolist()])
        at += size
        yield ids, joined.removeprefix(" ")


def encode_and_decode(
    docs: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    with_ids: bool = False,
    with_text: bool = False,
) -> DataFrame:
    """Ids of every text, with begin and end ids, and the text that they decode to.

    Returns id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit numbers) and
    decoded_sha256 (of the decoded text as UTF-8), and if asked token_ids and decoded. ``model_file`` must lie at the same path on all machines.

    NULL is taken as the empty text, which has the begin and end ids only and decodes to
    nothing. Every row gives a row, rows with the same id or without one too. An empty
    table gives an empty one. Other columns are not read.
    """
    own = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    id_type = own.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    fields += ", token_ids array<int>" * with_ids + ", decoded string" * with_text
    names = [f.strip().split(" ")[0] for f in fields.split(",")]

    def run(batches):
        table = ChunkTable(load(model_file))
        for part in slices(batches, limit=block_bytes):
            table = table.renewed()
            counts, id_marks, text_marks, ids_kept, texts_kept = [], [], [], [], []
            for ids, decoded in encode_block(part.column("text"), table):
                counts.append(len(ids))
                id_marks.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_marks.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    ids_kept.append(ids.astype(np.int32))
                if with_text:
                    texts_kept.append(decoded)
            columns = [
                part.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(id_marks, pa.string()),
                pa.array(text_marks, pa.string()),
            ]
            if with_ids:
                columns.append(pa.array(ids_kept, pa.list_(pa.int32())))
            if with_text:
                columns.append(pa.array(texts_kept, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    return own.mapInArrow(run, fields).withColumnRenamed("doc_id", id_col)
