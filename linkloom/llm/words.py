"""Words of whole texts, for tasks that work on Arrow batches."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes of text that a task holds as Python words at a time; longer texts come alone.
SLICE_BYTES = 1 << 20
# Runs with more bytes than this are hashed one by one.
LONG_RUN = 512
# Fixed value: 2**64 over the golden ratio.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
# The first bytes, by number, of eight read as one value.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def slices(batches, column="text", limit=SLICE_BYTES):
    """Arrow batches cut so that each has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        # Workers live on between tasks: what a batch took goes back.
        pa.default_memory_pool().release_unused()


def words(text, lower=False):
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``lower`` lowers A-Z only. NULL has none."""
    if not text:
        return []
    data = text.encode()
    return (data.lower() if lower else data).split()


def flat_words(texts, lower=False):
    """All words of the texts in one list, and the number in each text."""
    per_text = [words(t, lower) for t in texts]
    counts = np.fromiter(map(len, per_text), np.int64, len(per_text))
    return [w for ws in per_text for w in ws], counts


def hash_words(flat):
    """64-bit hash of each word."""
    if not flat:
        return np.zeros(0, np.uint64)
    column = np.empty(len(flat), dtype=object)
    column[:] = flat
    return pd.util.hash_array(column, categorize=False)


def mix(values):
    """Scramble 64-bit values (the finalizer of SplitMix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def run_hashes(data, starts, ends):
    """64-bit hash of the bytes of each run of ``data``, eight bytes of all runs at a time."""
    padded = np.zeros((len(data) + 7) // 8 * 8 + 16, np.uint8)
    padded[: len(data)] = data
    eights = padded.view("<u8")
    sizes = ends - starts
    found = sizes.astype(np.uint64)
    own = np.flatnonzero((sizes > 0) & (sizes <= LONG_RUN))
    at, left = starts[own], sizes[own]
    while len(own):
        place, shift = at >> 3, (at.astype(np.uint64) & np.uint64(7)) << np.uint64(3)
        # Two shifts, as one by 64 bits is not defined.
        high = (eights[place + 1] << (np.uint64(56) - shift)) << np.uint64(8)
        value = ((eights[place] >> shift) | high) & FIRST_BYTES[np.minimum(left, 8)]
        found[own] = mix(found[own] * GOLDEN + value)
        more = left > 8
        own, at, left = own[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes > LONG_RUN):
        found[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return found


def gram_hashes(hashes, k):
    """Hash of the ``k`` consecutive hashes that start at each position."""
    n = max(0, len(hashes) - k + 1)
    grams = np.full(n, k, np.uint64)
    for i in range(k):
        grams = mix(grams * GOLDEN + hashes[i : i + n])
    return grams
