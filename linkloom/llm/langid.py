"""Language identification by error-correcting output codes.

Every language has a codeword of bits. One linear classifier over hashed byte
trigrams predicts each bit; its weights are the log odds of a trigram between the languages that have
the bit and those that do not, from counts over all training documents. A
text gets the language whose codeword costs least: the losses of its bits, each
weighted by how reliable the bit's classifier was on training documents.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.grams import gram_codes, gram_means
from linkloom.llm.tables import sample_texts
from linkloom.llm.words import slices

BUCKETS = 1 << 14
UNKNOWN = "und"
# Training documents on which the bits' reliability is measured, by hash of their id.
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 20_000
# A text is ambiguous if the runner-up is at least this likely.
AMBIGUOUS = 0.25

# ASCII without letters becomes space, A-Z lower case; other bytes stay.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def prepare(data):
    """Letters only, words one space apart."""
    return b" ".join(data.translate(PLAIN).split())


def codewords(k, seed=1):
    """A row of bits (-1, 1) per language: all splits in two for few, else the best of random codes."""
    if k <= 1:
        return np.ones((k, 0))
    if k <= 5:
        columns = np.arange(1, 1 << (k - 1))
        return np.where(columns[None, :] >> np.arange(k)[:, None] & 1, 1.0, -1.0)
    random = np.random.default_rng(seed)
    length = 12 * int(np.ceil(np.log2(k)))
    best, best_gap = None, -1
    for _ in range(40):
        code = random.choice([-1.0, 1.0], size=(k, length))
        gap = ((length - code @ code.T) / 2 + length * np.eye(k)).min()
        mixed = (np.abs(code.sum(axis=0)) < k).all()
        if mixed and gap > best_gap:
            best, best_gap = code, gap
    return best


def bit_weights(counts, code):
    """(buckets, bits) log odds; every language counts alike on its side of a bit."""
    shares = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    weights = np.empty((counts.shape[1], code.shape[1]))
    for bit in range(code.shape[1]):
        side = code[:, bit] > 0
        weights[:, bit] = np.log(shares[side].mean(axis=0)) - np.log(shares[~side].mean(axis=0))
    return weights


class Codebook:
    """Languages, their codewords, and the classifiers of the bits."""

    def __init__(self, languages, counts):
        self.languages = languages
        self.code = codewords(len(languages))
        self.weights = bit_weights(counts, self.code).astype(np.float32)
        self.reliability = np.ones(self.code.shape[1])

    def margins(self, texts):
        """Outputs of the classifiers, one column per bit: evidence grows with the text, to a bound."""
        codes, counts = gram_codes(texts, len(self.weights), prepare)
        return gram_means(codes, counts, self.weights) * np.minimum(counts, 100)[:, None] ** 0.5

    def weigh(self, texts, languages):
        """Measure each bit's reliability on labelled texts."""
        if not texts or not self.code.shape[1]:
            return
        truth = self.code[[self.languages.index(x) for x in languages]]
        right = (self.margins(texts) * truth > 0).mean(axis=0)
        self.reliability = np.clip(2 * right - 1, 0.01, 1)

    def decode(self, texts):
        """(language number, probability, whether ambiguous) of each text."""
        losses = np.logaddexp(0, -self.margins(texts)[:, None, :] * self.code[None])
        cost = losses @ self.reliability
        chance = np.exp(cost.min(axis=1, keepdims=True) - cost)
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        score = chance.max(axis=1)
        second = np.sort(chance, axis=1)[:, -2] if len(self.languages) > 1 else 0 * score
        return best, score, second >= AMBIGUOUS


def has_letter(text):
    return bool(text) and any(map(str.isalpha, text))


def _counts(train: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all training texts, summed up in each task first."""

    def run(batches):
        sums = {}
        for part in slices(batches):
            texts, langs = part.column("text").to_pylist(), part.column("lang").to_pylist()
            for lang in set(langs):
                codes, _ = gram_codes(
                    [t for t, own in zip(texts, langs) if own == lang], BUCKETS, prepare
                )
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums[lang] += np.bincount(codes, minlength=BUCKETS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(own[at])],
                ["lang", "bucket", "n"],
            )

    return (
        train.mapInArrow(run, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def train_codebook(train: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Codebook:
    """Learn from ``train`` (doc_id, text, lang). The driver gets ``BUCKETS`` sums per
    language, and at most ``sample_docs`` texts of at most ``SAMPLE_CHARS`` characters.
    """
    table = _counts(train.select("text", "lang")).toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    counts = np.zeros((len(languages), BUCKETS))
    rows = np.array([languages.index(x) for x in table["lang"].to_pylist()], np.int64)
    counts[rows, table["bucket"].to_numpy()] = table["n"].to_numpy()
    book = Codebook(languages, counts)
    sample = [r for r in sample_texts(train, sample_docs, SAMPLE_CHARS, "lang") if r["text"]]
    book.weigh([r["text"] for r in sample], [r["lang"] for r in sample])
    return book


def identify(
    docs: DataFrame, book: Codebook, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Language of every document by its text alone: id, lang_pred, score (0 to 1), ambiguous.

    ``und`` with score 0, and ambiguous, if the text is NULL or has no letter, or if no language was learned.
    A tie goes to the first language by name. Rows that share an id, or have none, each get a
    row. An empty table gives an empty one. Other columns are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = own.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(book)

    def run(batches):
        book = shared.value
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            known = np.array([bool(book.languages) and has_letter(t) for t in texts])
            found = [UNKNOWN] * len(texts)
            score, doubt = np.zeros(len(texts)), np.ones(len(texts), bool)
            if known.any():
                at = np.flatnonzero(known)
                best, score[at], doubt[at] = book.decode([texts[i] for i in at])
                for i, language in zip(at, best):
                    found[i] = book.languages[language]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found), pa.array(score), pa.array(doubt)],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return own.mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double, ambiguous boolean"
    ).withColumnRenamed("doc_id", id_col)
