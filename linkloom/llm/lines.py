"""Quality rules on whole texts, and a linear-chain CRF that labels their lines.

The CRF has two labels, content and boilerplate, binary features of each line and
weights for neighbouring labels. It is trained on a bounded sample of documents with weak
labels: rules that are sure of a line fix its label, all other lines stay open,
and the likelihood sums over them. The Viterbi path then marks every line of every document, and
the share of words in content lines decides.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.tables import sample_texts
from linkloom.llm.words import flat_words, gram_hashes, hash_words, mix, slices

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
# The training sample: documents with the least hash, long ones by runs of their lines.
TRAIN_DOCS = 600
TRAIN_CHARS = 12_000
TRAIN_ROUNDS = 80
RATE, RIDGE = 2.0, 1e-3

WHITE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))

CONTENT, BOILERPLATE, OPEN = 0, 1, -1
FEATURES = (
    "bias",
    "short",
    "medium",
    "long",
    "symbols",
    "many symbols",
    "shouting",
    "digits",
    "few letters",
    "sentence end",
    "no sentence end",
    "seen before",
    "one word over and over",
    "first",
    "last",
)


def _count(data, kinds):
    return len(data) - len(data.translate(None, kinds))


def line_features(lines):
    """Binary features of each line of a text, as rows; lines without words count too."""
    rows = np.zeros((len(lines), len(FEATURES)), bool)
    seen = set()
    for i, line in enumerate(lines):
        data = line.encode()
        ws = data.split()
        letters, size = _count(data, LETTERS), max(1, len(data))
        upper, symbols = _count(data, UPPER), _count(data, SYMBOLS)
        ended = data.rstrip()[-1:] in (b".", b"!", b"?", b":", b";", b'"', b")")
        rows[i] = (
            True,
            len(ws) < 4,
            4 <= len(ws) < 10,
            len(ws) >= 10,
            symbols > 0,
            symbols * 20 > size,
            upper * 2 > letters and len(ws) > 2,
            _count(data, DIGITS) * 5 > size,
            letters * 2 < size,
            ended,
            not ended,
            bool(ws) and line in seen,
            len(ws) > 3 and len(set(ws)) * 3 < len(ws),
            i == 0,
            i == len(lines) - 1,
        )
        seen.add(line)
    return rows


def weak_labels(features):
    """Label of each line that a rule is sure of, else ``OPEN``."""
    f = dict(zip(FEATURES, features.T))
    bad = f["many symbols"] | f["shouting"] | f["few letters"] | f["seen before"]
    bad |= f["one word over and over"] | f["digits"]
    good = f["long"] & f["sentence end"] & ~f["symbols"] & ~bad
    return np.where(bad, BOILERPLATE, np.where(good, CONTENT, OPEN))


def _log_sums(scores, step, lengths):
    """Forward and backward log sums of padded sequences: (docs, lines, labels)."""
    n, size, _ = scores.shape
    ahead, back = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, size):
        ahead[:, t] = scores[:, t] + np.logaddexp.reduce(ahead[:, t - 1, :, None] + step, axis=1)
    for t in range(size - 2, -1, -1):
        following = np.logaddexp.reduce(step + (scores[:, t + 1] + back[:, t + 1])[:, None], axis=2)
        back[:, t] = np.where((t + 1 < lengths)[:, None], following, 0)
    total = np.logaddexp.reduce(ahead[np.arange(n), lengths - 1], axis=1)
    return ahead, back, total


def _expected(x, scores, step, lengths):
    """Expected feature and transition counts under the sequence model."""
    ahead, back, total = _log_sums(scores, step, lengths)
    inside = np.arange(scores.shape[1]) < lengths[:, None]
    each = np.where(inside[..., None], np.exp(ahead + back - total[:, None, None]), 0)
    pair = ahead[:, :-1, :, None] + step + (scores[:, 1:] + back[:, 1:])[:, :, None, :]
    pair = np.where(inside[:, 1:, None, None], np.exp(pair - total[:, None, None, None]), 0)
    features = x.reshape(-1, x.shape[2]).T @ each.reshape(-1, each.shape[2])
    return features, pair.sum(axis=(0, 1))


def train_crf(sequences, rounds=TRAIN_ROUNDS):
    """(weights, step) from feature rows of documents, with weak labels on some lines."""
    weights, step = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    sequences = [s for s in sequences if len(s)]
    if not sequences:
        return weights, step
    lengths = np.array(list(map(len, sequences)))
    x = np.zeros((len(sequences), lengths.max(), len(FEATURES)))
    ruled_out = np.zeros((len(sequences), lengths.max(), 2))
    for d, features in enumerate(sequences):
        labels = weak_labels(features)
        x[d, : len(features)] = features
        ruled_out[d, : len(features), CONTENT][labels == BOILERPLATE] = -1e6
        ruled_out[d, : len(features), BOILERPLATE][labels == CONTENT] = -1e6
    n = lengths.sum()
    speed = [np.full_like(weights, 1e-8), np.full_like(step, 1e-8)]
    for _ in range(rounds):
        scores = x @ weights
        free = _expected(x, scores, step, lengths)
        fixed = _expected(x, scores + ruled_out, step, lengths)
        for value, a, b, s in zip((weights, step), fixed, free, speed):
            slope = (a - b) / n - RIDGE * value
            s += slope**2
            value += RATE / 10 * slope / np.sqrt(s)
    return weights, step


def viterbi(scores, counts, step):
    """Best label of each line; ``scores`` (lines, labels) of texts in a row, ``counts`` lines each."""
    first = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    best = scores.copy()
    came = np.zeros(scores.shape, np.int8)
    for t in range(1, int(counts.max(initial=0))):
        active = order[: np.searchsorted(-counts[order], -t, "left")]
        at = first[active] + t
        options = best[at - 1][:, :, None] + step
        came[at] = options.argmax(axis=1)
        best[at] += options.max(axis=1)
    labels = np.zeros(len(scores), np.int8)
    ends = first + counts - 1
    filled = counts > 0
    labels[ends[filled]] = best[ends[filled]].argmax(axis=1)
    for t in range(int(counts.max(initial=0)) - 2, -1, -1):
        active = order[: np.searchsorted(-counts[order], -(t + 1), "left")]
        at = first[active] + t
        labels[at] = came[at + 1, labels[at + 1]]
    return labels


def base_counts(texts):
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    flat, n_words = flat_words(texts)
    chars, symbols, repeated_lines = [], [], []
    for text in texts:
        data = (text or "").encode()
        chars.append(len(text or "") - _count(data, WHITE))
        symbols.append(_count(data, SYMBOLS))
        seen, again = set(), 0
        for line in data.split(b"\n"):
            if line in seen:
                again += 1
            elif line.strip(WHITE):
                seen.add(line)
        repeated_lines.append(again)
    return n_words, np.array(chars), np.array(symbols), np.array(repeated_lines), _repeat_words(flat, n_words)


def _repeat_words(flat, counts):
    """Words of each text in three-word windows that the text has twice or more."""
    text_of = np.repeat(np.arange(len(counts)), counts)
    grams = gram_hashes(hash_words(flat), 3)
    inside = text_of[: len(grams)] == text_of[2:][: len(grams)]
    keys = mix(grams + mix(text_of[: len(grams)].astype(np.uint64)))[inside]
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(flat), bool)
    for i in range(3):
        covered[np.flatnonzero(inside)[twice] + i] = True
    return np.bincount(text_of[covered], minlength=len(counts))


def training_sample(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> list:
    """Feature rows of at most ``train_docs`` documents, of at most ``TRAIN_CHARS`` characters of each."""
    found = sample_texts(docs, train_docs, TRAIN_CHARS)
    return [line_features(r["text"].split("\n")) for r in found if r["text"]]


def judge_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_docs: int = TRAIN_DOCS,
    min_share: float = MIN_CONTENT_SHARE,
) -> DataFrame:
    """Counts, content share and verdict for every document.

    Returns id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
    (too few words, or too many in repeated three-word windows), content_share (words in
    lines marked as content) and kept (not base_failed, and a share of ``min_share`` or more).

    NULL is taken as the empty text, which has no words and fails. Rows that share an id, or have none, are judged each
    on its own. An empty table gives an empty one, and then nothing is trained. Other
    columns are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = own.schema["doc_id"].dataType.simpleString()
    weights, step = train_crf(training_sample(own, train_docs))

    def run(batches):
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            n_words, *counts = base_counts(texts)
            lines = [t.split("\n") for t in texts]
            features = np.concatenate([line_features(ls) for ls in lines])
            n_lines = np.array(list(map(len, lines)))
            labels = viterbi(features @ weights, n_lines, step)
            sizes = np.array([len(line.encode().split()) for ls in lines for line in ls])
            first = np.cumsum(n_lines) - n_lines
            content = np.add.reduceat(np.where(labels == CONTENT, sizes, 0), first)
            share = content / np.maximum(n_words, 1)
            failed = (n_words < MIN_WORDS) | (100 * counts[3] > MAX_REPEAT_PERCENT * n_words)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *(pa.array(c.astype(np.int64)) for c in (n_words, *counts)),
                    pa.array(failed),
                    pa.array(share),
                    pa.array(~failed & (share >= min_share)),
                ],
                [
                    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "content_share", "kept",
                ],
            )

    return own.mapInArrow(
        run,
        f"doc_id {id_type}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, content_share double, kept boolean",
    ).withColumnRenamed("doc_id", id_col)
