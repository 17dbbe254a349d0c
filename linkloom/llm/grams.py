"""Hashed byte n-grams of whole texts, counted and scored in bulk."""

import numpy as np

GRAM = 3


def gram_codes(texts, buckets, prepare=None):
    """Bucket of each byte trigram of the texts in a row, and how many each text has.

    Texts are framed by spaces, so every text, also an empty one, has at least one trigram.
    ``prepare`` maps the bytes of a text before.
    """
    datas = [(t or "").encode() for t in texts]
    if prepare:
        datas = [prepare(d) for d in datas]
    counts = np.fromiter((len(d) + 1 for d in datas), np.int64, len(datas))
    # One more byte follows each text's trigrams' starts: " " + text + "  " per text.
    line = np.frombuffer(b"".join(b" " + d + b"  " for d in datas), np.uint8).astype(np.uint32)
    code = line[:-2] | line[1:-1] << np.uint32(8) | line[2:] << np.uint32(16)
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - (buckets - 1).bit_length())
    # Trigrams that start in the last two bytes of a text's frame run into the next text.
    starts = np.cumsum(counts + 2) - (counts + 2)
    keep = np.ones(len(line), bool)
    keep[starts + counts] = False
    keep[starts + counts + 1] = False
    return code[keep[: len(code)]], counts


def gram_means(codes, counts, weights):
    """Mean weight row of each text's trigrams; ``weights`` is (buckets, columns)."""
    out = np.empty((len(counts), weights.shape[1]))
    starts = np.cumsum(counts) - counts
    for column in range(weights.shape[1]):
        own = np.ascontiguousarray(weights[:, column], np.float32)
        out[:, column] = np.add.reduceat(own[codes], starts, dtype=np.float64) / counts
    return out
