"""Runs of bytes in a column of texts, cut out and checksummed in bulk with numpy and Arrow."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
# Byte strings longer than this are too few per length to fill a matrix.
LONG_BYTES = 512
MATRIX_BYTES = 1 << 21


LOWERED = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def byte_table(inside):
    """Which byte values belong to a run."""
    return np.array([bool(inside(v)) for v in range(256)])


def text_bytes(column):
    """(bytes, offsets) of an Arrow column of texts; NULL is the empty text."""
    filled = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def find_runs(inside, offsets):
    """(starts, ends, owner) of the maximal runs of True; no run goes from one text into the next."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def cut_out(data, starts, ends, inside=None):
    """The byte strings from ``starts`` to ``ends``, which do not overlap, as an Arrow array.

    ``inside`` tells their bytes, where it is known already.
    """
    if inside is None:
        marks = np.zeros(len(data) + 1, np.int8)
        # A run may end where the next one starts.
        np.add.at(marks, starts, 1)
        np.add.at(marks, ends, -1)
        inside = np.cumsum(marks[:-1], dtype=np.int8) > 0
    kept = np.ascontiguousarray(data[inside])
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
    )


def crc_table():
    """CRC-32 of each byte value, without the inversions at both ends."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> np.uint32(1) ^ np.uint32(POLYNOMIAL), table >> np.uint32(1))
    return table


CRC_TABLE = crc_table()


def crc_matrices(strings, before=None):
    """CRC-32 of each byte string of an Arrow large_binary array.

    Strings of one length form a matrix of bytes, one column each; all their checksums go on by one
    byte at a time, and then back to the places of their strings. ``before`` is the CRC-32 of
    what is to be thought in front of each string.
    """
    data, offsets = text_bytes(strings)
    sizes = np.diff(offsets)
    register = np.full(len(sizes), 0xFFFFFFFF, np.uint32) if before is None else ~before.astype(np.uint32)
    order = np.argsort(sizes, kind="stable")
    lengths, first = np.unique(sizes[order], return_index=True)
    for length, at, end in zip(lengths, first, [*first[1:], len(order)]):
        if length > LONG_BYTES:
            for i in order[at:end]:
                whole = data[offsets[i] : offsets[i + 1]].tobytes()
                register[i] = zlib.crc32(whole, int(register[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
            continue
        rows = max(1, MATRIX_BYTES // max(1, int(length)))
        for block in range(at, end, rows):
            bucket = order[block : min(end, block + rows)]
            matrix = data[offsets[bucket] + np.arange(length)[:, None]] if length else ()
            crc = register[bucket]
            for column in matrix:
                crc = CRC_TABLE[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
            register[bucket] = crc
    return ~register
