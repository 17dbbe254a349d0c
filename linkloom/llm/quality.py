"""Quality classifier from weak labels.

Overlapping heuristics vote on every document: good, bad, or nothing. Expectation
maximisation over the table of vote patterns, counted over all documents, estimates how often each
heuristic says good, bad or nothing about good documents and about bad ones, and from that how likely each
pattern is good. Heuristics that nearly always say the same share one vote between them, as the estimate takes
votes as independent. These posteriors are the labels on which a linear scorer over hashed features is
trained; its score decides, so documents are told apart by more than the votes.
"""

import re
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.grams import gram_codes, gram_means
from linkloom.llm.tables import sample_texts
from linkloom.llm.words import slices

GOOD, BAD, NONE = 1, 0, 2
# Most of them look for one kind of junk and say nothing else.
LABELLERS = (
    "symbols",
    "marked words",
    "capitals",
    "shouts",
    "few words over and over",
    "word after word",
    "separators",
    "separated lines",
    "plain words",
    "lower case",
    "sentences",
)
BUCKETS = 1 << 12
STATS = 8
# Shares of trigrams in a text with few of them are drawn towards nothing.
FEW = 60
EM_ROUNDS = 200
# A vote is at least so many times as likely about a document of its kind as about another: just above chance.
LEAST_ODDS = 1.05
# Labellers that agree on this share of the documents on which either votes share one vote.
SAME_VOTE = 0.8
# The scorer's training sample: documents with the least hash, long ones by parts of them.
TRAIN_DOCS = 3_000
TRAIN_CHARS = 50_000
TRAIN_ROUNDS = 300
RATE, RIDGE = 0.3, 1e-4
THRESHOLD = 0.5

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123)) + bytes(range(128, 256))
SYMBOLS = b"#*$%&<>{}[]\\^~="
PLAIN = re.compile(rb"[A-Za-z'\x80-\xff-]+[.,;:?!]?")


def _share(data, kinds, size):
    return (len(data) - len(data.translate(None, kinds))) / max(1, size)


def statistics(text):
    """Numbers between 0 and 1 about a text, and the votes on it."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    some, many = n >= 5, n >= 20
    each = Counter(words)
    letters = _share(data, UPPER + LOWER, 1)
    symbols = _share(data, SYMBOLS, len(data))
    capitals = _share(data, UPPER, letters)
    lower = _share(data, LOWER, letters)
    shouts = min(1, data.count(b"!!") / max(1, n))
    repeated = 1 - len(each) / max(1, n)
    stuttered = sum(map(eq, words, words[1:])) / max(1, n)
    single = each[b"|"] / max(1, n)
    lines = [x for x in data.split(b"\n") if x.strip()]
    separated = sum(b" | " in x for x in lines) / max(1, len(lines))
    marked = sum(k for w, k in each.items() if w[-1] in SYMBOLS) / max(1, n)
    plain = sum(k for w, k in each.items() if PLAIN.fullmatch(w)) / max(1, n)
    ends = data.count(b". ") + data.count(b".\n") + data.count(b"? ") + data.rstrip().endswith(b".")
    bad = lambda found: BAD if found else NONE
    votes = (
        bad(symbols >= 0.02),
        bad(some and marked >= 0.1),
        bad(some and capitals >= 0.5),
        bad(shouts >= 0.1),
        # Longer texts repeat more words.
        bad(many and repeated >= 0.9),
        bad(many and stuttered >= 0.2),
        bad(single >= 0.02),
        bad(separated >= 0.3),
        GOOD if plain >= 0.9 and capitals < 0.5 and stuttered < 0.1 else bad(some and plain <= 0.6),
        bad(some and lower <= 0.4),
        GOOD if ends and n <= 60 * ends and repeated < 0.9 and stuttered < 0.1 else NONE,
    )
    return (symbols, capitals, shouts, repeated, stuttered, single, marked, 1 - plain), votes


def pattern_of(votes):
    """A vote pattern as one number."""
    return sum(vote * 3**i for i, vote in enumerate(votes))


def votes_of(patterns):
    """(patterns, labellers) array of votes."""
    return np.asarray(patterns)[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def vote_shares(votes, weight):
    """What each labeller's vote counts: 1, or the part of it that is left to one of several alike."""
    cast = votes != NONE
    group = np.arange(votes.shape[1])
    for i in range(len(group)):
        for j in range(i):
            either = weight @ (cast[:, i] | cast[:, j])
            both = weight @ (cast[:, i] & (votes[:, i] == votes[:, j]))
            if either and both >= SAME_VOTE * either:
                group[group == group[i]] = group[j]
    return 1 / (group[:, None] == group).sum(axis=1)


def expectation_maximisation(patterns, counts, rounds=EM_ROUNDS):
    """(posterior of good for each pattern, rates of each labeller).

    ``rates[label, labeller, vote]`` is how often a labeller votes so on documents of a label; silence is a
    vote of its own kind. The only thing taken for granted is the sense of votes: a vote for good is at least ``LEAST_ODDS``
    times as likely about a good document as about a bad one, and the other way round.
    """
    votes = votes_of(patterns)
    weight = np.asarray(counts, float)
    share = vote_shares(votes, weight)
    one = np.stack([votes == kind for kind in (BAD, GOOD, NONE)], axis=2).astype(float)
    # Start from the sum of votes, most documents being good.
    good = 1 / (1 + np.exp(-np.log(4) - 2 * ((one[:, :, GOOD] - one[:, :, BAD]) @ share)))
    rates = np.full((2, votes.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        prior = np.clip((weight @ good + 4) / (weight.sum() + 5), 0.01, 0.99)
        for label, chance in ((BAD, 1 - good), (GOOD, good)):
            seen = np.einsum("p,plv->lv", weight * chance, one) + (0.5, 0.5, 1)
            rates[label] = seen / seen.sum(axis=1, keepdims=True)
        odds = np.log(rates[GOOD] / rates[BAD])
        odds[:, GOOD] = np.maximum(odds[:, GOOD], np.log(LEAST_ODDS))
        odds[:, BAD] = np.minimum(odds[:, BAD], -np.log(LEAST_ODDS))
        before = good
        logs = np.log(prior / (1 - prior)) + np.einsum("plv,lv,l->p", one, odds, share)
        good = 1 / (1 + np.exp(-np.clip(logs, -500, 500)))
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    return good, rates


def features(texts, stats):
    """Hashed feature columns: shares of trigrams, and bins of the statistics in own buckets."""
    codes, counts = gram_codes(texts, BUCKETS)
    rows = np.repeat(np.arange(len(texts)), counts)
    sums = np.bincount(rows * BUCKETS + codes, minlength=len(texts) * BUCKETS)
    shares = sums.reshape(len(texts), BUCKETS) / (counts + FEW)[:, None]
    return np.hstack([shares, stats])


def train_scorer(x, target, rounds=TRAIN_ROUNDS):
    """Logistic regression on soft labels: (weights, scale of each column); the last is the bias."""
    scale = x.std(axis=0) + 1e-3 * (x.std(axis=0).max(initial=0) + 1e-9)
    z = np.hstack([x / scale, np.ones((len(x), 1))]).astype(np.float32)
    weights = np.zeros(z.shape[1], np.float32)
    speed = np.full(z.shape[1], 1e-6, np.float32)
    # Both labels weigh alike, whichever is rarer.
    balance = np.where(target > 0.5, 0.5 / max(target.mean(), 1e-3), 0.5 / max(1 - target.mean(), 1e-3))
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = (balance * (target - chance)).astype(np.float32) @ z / len(z) - RIDGE * weights
        speed += slope**2
        weights += RATE / 10 * slope / np.sqrt(speed)
    weights = weights.astype(float)
    weights[:-1] /= scale
    return weights


class Scorer:
    """Pattern posteriors and the trained linear scorer."""

    def __init__(self, posterior, rates, weights):
        self.posterior, self.rates, self.weights = posterior, rates, weights

    def score(self, texts, stats):
        codes, counts = gram_codes(texts, BUCKETS)
        total = gram_means(codes, counts, self.weights[:BUCKETS, None])[:, 0]
        total *= counts / (counts + FEW)
        total += stats @ self.weights[BUCKETS:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _vote_counts(own: DataFrame) -> DataFrame:
    """(pattern, n) over all documents: at most 3 ** labellers rows."""

    def run(batches):
        for part in slices(batches):
            found = [pattern_of(statistics(t)[1]) for t in part.column("text").to_pylist()]
            kinds, counts = np.unique(np.array(found, np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(counts)], ["pattern", "n"])

    return (
        own.select("text").mapInArrow(run, "pattern int, n bigint")
        .groupBy("pattern")
        .agg(F.sum("n").alias("n"))
    )


def train(own: DataFrame, train_docs: int = TRAIN_DOCS) -> Scorer | None:
    """Votes of all of ``own`` (doc_id, text), then the scorer on at most ``train_docs`` texts, on
    at most ``TRAIN_CHARS`` characters of each. None if there is no document.
    """
    table = _vote_counts(own).orderBy("pattern").toArrow()
    if not table.num_rows:
        return None
    patterns = table["pattern"].to_numpy()
    good, rates = expectation_maximisation(patterns, table["n"].to_numpy())
    posterior = dict(zip(patterns.tolist(), good.tolist()))
    # Labels come from the votes on whole texts.
    found = sample_texts(own, train_docs, TRAIN_CHARS, mark=lambda text: pattern_of(statistics(text)[1]))
    if not found:
        return Scorer(posterior, rates, np.zeros(BUCKETS + STATS + 1))
    texts = [r["text"] for r in found]
    stats = [statistics(t)[0] for t in texts]
    blocks = [
        features(texts[i : i + 100], np.array(stats[i : i + 100])).astype(np.float32)
        for i in range(0, len(texts), 100)
    ]
    target = np.array([posterior[r["mark"]] for r in found])
    return Scorer(posterior, rates, train_scorer(np.vstack(blocks), target))


def _judge(texts, scorer):
    """Pattern, weak label and score of each text; a text without words scores 0."""
    stats, votes = zip(*map(statistics, texts))
    patterns = [pattern_of(v) for v in votes]
    filled = np.array([bool(t and t.encode().split()) for t in texts])
    score = np.where(filled, scorer.score(texts, np.array(stats)), 0.0)
    return patterns, [scorer.posterior.get(p, 0.5) for p in patterns], score


def classify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_docs: int = TRAIN_DOCS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Verdict on every document: id, pattern (of votes), weak_label (its posterior), score, kept.

    ``kept`` is a score of ``threshold`` or more. NULL texts and texts without words
    score 0 and are not kept. Rows that share an id, or have none, each get
    a row. An empty table gives an empty one. Other columns are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = own.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(train(own, train_docs))

    def run(batches):
        for part in slices(batches):
            patterns, weak, score = _judge(part.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(patterns, pa.int32()),
                    pa.array(weak),
                    pa.array(score),
                    pa.array(score >= threshold),
                ],
                ["doc_id", "pattern", "weak_label", "score", "kept"],
            )

    return own.mapInArrow(
        run, f"doc_id {id_type}, pattern int, weak_label double, score double, kept boolean"
    ).withColumnRenamed("doc_id", id_col)


def keep_good(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_docs: int = TRAIN_DOCS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs``, with all columns, that ``classify`` keeps."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(train(own, train_docs))

    def run(batches):
        for part in slices(batches, text_col):
            _, _, score = _judge(part.column(text_col).to_pylist(), shared.value)
            yield part.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
