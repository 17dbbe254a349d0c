"""Language-model scores by a small causal self-attention model over subword ids.

The model sees windows of ``WINDOW`` ids. Windows overlap by half: a window scores the ids
after its second half (the first one of a text after both), so each id is scored once, with half a
window before it or all there is. One attention head with a causal mask mixes
the window's embeddings; the result gives a distribution over classes of ids, and
an id's share of its class comes from its count in all training texts. Classes are runs of
the sorted vocabulary of about equal count. Training starts on a sample and then takes steps
along gradients summed up in tasks, in which every id of every training text counts once.

The unigram base needs the count of every word. Counts are summed up in tasks, then
by word hash. The most frequent words, a bounded number, go to all tasks, which
score them on the spot; the others are looked up in the table of counts by a join.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from linkloom.llm.pieces import HashedChunkTable, kept_table, load
from linkloom.llm.runs import LOWERED, byte_table, find_runs, text_bytes
from linkloom.llm.tables import sample_texts
from linkloom.llm.words import run_hashes, slices
from linkloom.sources.workspace import Workspace

WINDOW, STEP = 32, 16
WIDTH, CLASSES = 16, 32
# What the model starts from: texts with the least hash, long ones by parts of them.
TRAIN_DOCS, TRAIN_CHARS = 400, 8_000
TRAIN_ROUNDS, TRAIN_WINDOWS, RATE = 300, 128, 0.01
# Then it learns from all texts: each belongs to one round, a step along the slopes summed over its texts.
ALL_ROUNDS, ALL_RATE = 8, 0.03
# Numbers in a row of slopes.
SLOPE_BLOCK = 1_024
# Words whose counts go to every task: 5 MB.
FREQUENT = 300_000
BLOCK_BYTES = 1 << 20
# Windows scored at a time, so that their numbers stay in a processor's cache.
SCORE_WINDOWS = 192
# Bytes of packed ids that are taken at a time; a longer text comes alone.
PACKED_BYTES = 1 << 19
# Blocks of slopes in a batch.
ROWS_PER_PASS = 100
# Word hashes that a task gathers before it counts them: 16 MB.
HELD_WORDS = 2_000_000
END = np.uint64(0)

IN_WORD = byte_table(lambda b: b != 32 and not 9 <= b <= 13)


def lower(column):
    """An Arrow column of texts with A-Z lowered; '' for NULL."""
    data, offsets = text_bytes(column)
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(LOWERED[data])]
    return pa.Array.from_buffers(pa.large_string(), len(column), buffers)


def hashed_words(column):
    """(hashes, counts): hash of each lowered word of all texts in a row, and how many each text has."""
    data, offsets = text_bytes(column)
    inside = IN_WORD[data]
    starts, ends, owner = find_runs(inside, offsets)
    return run_hashes(LOWERED[data], starts, ends), np.bincount(owner, minlength=len(column))


def subword_ids(texts, table):
    """Ids of each text, lowered, with begin and end ids, through a table of distinct chunks."""
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    places, sizes = table.places(lower(column))
    table.segment()
    return [ids.astype(np.int64) for ids in table.texts_ids(places, sizes)]


def id_classes(counts, pieces, classes=CLASSES):
    """Class of every id, and the log10 share of each id in its class (one is added to all counts)."""
    order = sorted(range(len(pieces)), key=lambda i: pieces[i])
    mass = np.cumsum(counts[order] + 1)
    kinds = np.empty(len(pieces), np.int64)
    kinds[order] = np.minimum(classes - 1, (mass - 1) * classes // mass[-1]).astype(np.int64)
    totals = np.bincount(kinds, counts + 1, classes)
    return kinds, np.log10((counts + 1) / totals[kinds])


def add_by_id(table, ids, rows):
    """Add each row to the row of ``table`` that its id names. Two columns make one complex number."""
    pairs = table.view(np.complex128)
    at = ids[:, None] * pairs.shape[1] + np.arange(pairs.shape[1])
    np.add.at(pairs.ravel(), at.ravel(), rows.ravel().view(np.complex64).astype(np.complex128))


class Room(dict):
    """Large arrays by name, kept between calls: fresh memory for each costs more than the arithmetic."""

    def space(self, name, *shape):
        if name not in self or self[name].shape != shape:
            self[name] = np.empty(shape, np.float32)
        return self[name]


class Attention:
    """Embeddings, one causal attention head and class weights; trained by Adam."""

    def __init__(self, size, classes=CLASSES, width=WIDTH, window=WINDOW, seed=7):
        random = np.random.default_rng(seed)
        shapes = {
            "ids": (size, width),
            "spots": (window, width),
            "query": (width, width),
            "key": (width, width),
            "value": (width, width),
            "out": (width, classes),
            "bias": (classes,),
        }
        self.p = {
            k: (random.standard_normal(s) * (0.3 if k != "bias" else 0)).astype(np.float32)
            for k, s in shapes.items()
        }
        self.late = np.triu(np.full((window, window), -1e9, np.float32), 1)
        self.seen = np.tril(np.ones((window, window), np.float32))

    def forward(self, ids, first=0):
        """Log chances (windows, places from ``first`` on, classes) of what comes after each place."""
        p, n = self.p, ids.shape[1]
        x = p["ids"][ids] + p["spots"][:n]
        q = x[:, first:] @ p["query"]
        k, v = x @ p["key"], x @ p["value"]
        weights = q @ k.transpose(0, 2, 1) * np.float32(WIDTH**-0.5) + self.late[first:n, :n]
        np.exp(weights - weights.max(axis=2, keepdims=True), out=weights)
        weights /= weights.sum(axis=2, keepdims=True)
        hidden = x[:, first:] + weights @ v
        logits = hidden @ p["out"] + p["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        logs = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
        return logs, (x, q, k, v, weights, hidden)

    def log_chances(self, ids, first, targets, room=None):
        """Log chance of the target class after each place from ``first`` on: (windows, places).

        The same numbers as ``forward`` gives, with fewer passes: one product for all
        projections, sums as products with ones, and only the targets' logits kept.
        """
        p, (count, n) = self.p, ids.shape
        space, own_n = (Room() if room is None else room).space, n - first
        x = np.take(p["ids"], ids.ravel(), axis=0, out=space("x", count * n, WIDTH), mode="clip")
        x.reshape(count, n, WIDTH)[:] += p["spots"][:n]
        kv = np.matmul(x, np.hstack([p["key"], p["value"]]), out=space("kv", count * n, 2 * WIDTH))
        kv = kv.reshape(count, n, 2 * WIDTH)
        own = space("own", count * own_n, WIDTH)
        own.reshape(count, own_n, WIDTH)[:] = x.reshape(count, n, WIDTH)[:, first:]
        q = np.matmul(own, p["query"] * np.float32(WIDTH**-0.5), out=space("q", count * own_n, WIDTH))
        # Products of small matrices go faster with the second one as it is than turned.
        keys = space("keys", count, WIDTH, n)
        keys[:] = kv[:, :, :WIDTH].transpose(0, 2, 1)
        weights = np.matmul(q.reshape(count, own_n, WIDTH), keys, out=space("weights", count, own_n, n))
        np.exp(np.minimum(weights, 80, out=weights), out=weights)
        weights *= self.seen[first:n, :n]
        mixed = np.matmul(weights, kv[:, :, WIDTH:], out=space("mixed", count, own_n, WIDTH)).reshape(-1, WIDTH)
        mixed /= (weights.reshape(-1, n) @ np.ones(n, np.float32))[:, None]
        mixed += own
        logits = np.matmul(mixed, p["out"], out=space("logits", count * own_n, p["out"].shape[1]))
        logits += p["bias"]
        found = logits[np.arange(len(logits)), targets.ravel()]
        np.exp(np.minimum(logits, 80, out=logits), out=logits)
        found -= np.log(logits @ np.ones(logits.shape[1], np.float32))
        return found.reshape(count, own_n)

    def slope_sums(self, ids, targets, used, room=None):
        """Gradient of the summed log loss over the used places of full windows.

        Of the embeddings one row per place, as ``places``, which stays until the next call with this ``room``.
        """
        p, (count, n) = self.p, ids.shape
        flat, scale = ids.ravel(), np.float32(WIDTH**-0.5)
        used, space = used.ravel().astype(np.float32), (Room() if room is None else room).space
        ones = np.ones(max(n, p["out"].shape[1], count * n), np.float32)
        x = np.take(p["ids"], flat, axis=0, out=space("x", count * n, WIDTH), mode="clip")
        x.reshape(count, n, WIDTH)[:] += p["spots"][:n]
        projections = np.hstack([p["query"] * scale, p["key"], p["value"]])
        parts = (slice(0, WIDTH), slice(WIDTH, 2 * WIDTH), slice(2 * WIDTH, 3 * WIDTH))
        qkv = np.matmul(x, projections, out=space("qkv", count * n, 3 * WIDTH)).reshape(count, n, 3 * WIDTH)
        q, k, v = (qkv[:, :, part] for part in parts)
        # Products of small matrices go faster with the second one as it is than turned.
        keys, values = space("keys", count, WIDTH, n), space("values", count, WIDTH, n)
        keys[:], values[:] = k.transpose(0, 2, 1), v.transpose(0, 2, 1)
        # Weights stay without their sums: what has a row's share is divided, which is half as wide.
        weights = np.matmul(q, keys, out=space("weights", count, n, n))
        np.exp(np.minimum(weights, 80, out=weights), out=weights)
        weights *= self.seen[:n, :n]
        sums = (weights.reshape(-1, n) @ ones[:n])[:, None]
        mixed = np.matmul(weights, v, out=space("mixed", count, n, WIDTH)).reshape(-1, WIDTH)
        mixed /= sums
        hidden = np.add(mixed, x, out=space("hidden", count * n, WIDTH))
        slopes = np.matmul(hidden, p["out"], out=space("slopes", count * n, p["out"].shape[1]))
        slopes += p["bias"]
        np.exp(np.minimum(slopes, 80, out=slopes), out=slopes)
        slopes *= (used / (slopes @ ones[: slopes.shape[1]]))[:, None]
        slopes[np.arange(len(slopes)), targets.ravel()] -= used
        d_hidden = np.matmul(slopes, p["out"].T, out=space("d_hidden", count * n, WIDTH))
        d_mixed = np.divide(d_hidden, sums, out=space("d_mixed", count * n, WIDTH))
        level = np.einsum("ij,ij->i", d_mixed, mixed).reshape(count, n, 1)
        d_mixed = d_mixed.reshape(count, n, WIDTH)
        d_scores = np.matmul(d_mixed, values, out=space("d_scores", count, n, n))
        d_scores -= level
        d_scores *= weights
        d_qkv = space("d_qkv", count, n, 3 * WIDTH)
        np.matmul(d_scores, k, out=d_qkv[:, :, parts[0]])
        np.matmul(d_scores.transpose(0, 2, 1), q, out=d_qkv[:, :, parts[1]])
        np.matmul(weights.transpose(0, 2, 1), d_mixed, out=d_qkv[:, :, parts[2]])
        d_qkv = d_qkv.reshape(-1, 3 * WIDTH)
        d_x = np.matmul(d_qkv, projections.T, out=space("d_x", count * n, WIDTH))
        d_x += d_hidden
        d_projections = x.T @ d_qkv
        return {
            "places": d_x,
            "spots": d_x.reshape(count, n, WIDTH).sum(axis=0),
            "query": d_projections[:, parts[0]] * scale,
            "key": d_projections[:, parts[1]],
            "value": d_projections[:, parts[2]],
            "out": hidden.T @ slopes,
            "bias": ones[: len(slopes)] @ slopes,
        }

    def gradients(self, ids, targets, used):
        """Gradient of the mean log loss over the used places of full windows."""
        sums = self.slope_sums(ids, targets, used)
        d_ids = np.zeros(self.p["ids"].shape)
        add_by_id(d_ids, ids.ravel(), sums.pop("places"))
        return {k: s / used.sum() for k, s in (sums | {"ids": d_ids}).items()}

    def text_slopes(self, texts, kinds, sums):
        """Add to ``sums`` the slopes of all ids of the texts after the first, each id once."""
        sizes = np.array(list(map(len, texts)), np.int64)
        line = np.concatenate([*texts, np.zeros(WINDOW + 1, np.int64)])
        begin = np.cumsum(sizes) - sizes
        number = np.maximum(0, -(-(sizes - 1) // WINDOW))
        owner = np.repeat(np.arange(len(sizes)), number)
        starts = begin[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)) * WINDOW
        ends = (begin + sizes)[owner]
        room = Room()
        for i in range(0, len(starts), TRAIN_WINDOWS):
            at = starts[i : i + TRAIN_WINDOWS, None] + np.arange(WINDOW)
            used = (at + 1 < ends[i : i + TRAIN_WINDOWS, None]).astype(np.float32)
            seen = line[at]
            found = self.slope_sums(seen, kinds[line[at + 1]], used, room)
            add_by_id(sums["ids"], seen.ravel(), found.pop("places"))
            for name, slope in found.items():
                sums[name] += slope
            sums["used"] += used.sum()

    def train(self, texts, kinds, rounds=TRAIN_ROUNDS, seed=11):
        """Fit on id lists: windows drawn from random places, all of them full or padded by the end id."""
        random = np.random.default_rng(seed)
        texts = [t for t in texts if len(t) > 1]
        if not texts:
            return self
        # Texts one after the other; a window may start in any of them and ends with it.
        line = np.concatenate([*texts, np.zeros(WINDOW, np.int64)])
        owner = np.concatenate([np.repeat(np.arange(len(texts)), list(map(len, texts))), np.full(WINDOW, -1)])
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        inside = inside[owner[inside] >= 0]
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps = np.arange(WINDOW)
        for t in range(1, rounds + 1):
            at = random.choice(inside, TRAIN_WINDOWS)[:, None] + steps
            at = np.minimum(at, len(line) - 2)
            used = (owner[at + 1] == owner[at[:, :1]]).astype(np.float32)
            slopes = self.gradients(line[at], kinds[line[at + 1]], used)
            for name, slope in slopes.items():
                first[name] += 0.1 * (slope - first[name])
                second[name] += 0.01 * (slope**2 - second[name])
                move = first[name] / (1 - 0.9**t) / (np.sqrt(second[name] / (1 - 0.99**t)) + 1e-8)
                self.p[name] -= np.float32(RATE) * move
        return self


class Scorer:
    """The trained model with classes and shares of ids."""

    def __init__(self, model, kinds, shares):
        self.model, self.kinds, self.shares = model, kinds, shares

    def _windows(self, line, starts, first, sums, owners, ends):
        """Add up what windows at ``starts`` of ``line`` score from their place ``first`` on."""
        per_pass, room = SCORE_WINDOWS, Room()
        for i in range(0, len(starts), per_pass):
            at = starts[i : i + per_pass, None] + np.arange(WINDOW)
            own, stop = owners[i : i + per_pass], ends[i : i + per_pass]
            target = at[:, first:] + 1
            real = target < stop[:, None]
            ids = line[np.minimum(target, len(line) - 1)]
            seen = line[np.minimum(at, len(line) - 1)]
            found = self.model.log_chances(seen, first, self.kinds[ids], room)
            found = np.where(real, found / np.log(10) + self.shares[ids], 0)
            sums += np.bincount(own, found.sum(axis=1), len(sums))

    def score(self, texts):
        """log10 chance of each id list after its first id."""
        sizes = np.array(list(map(len, texts)), np.int64)
        line = np.concatenate(texts)
        begin = np.cumsum(sizes) - sizes
        sums = np.zeros(len(texts))
        everyone = np.arange(len(texts))
        self._windows(line, begin, 0, sums, everyone, begin + sizes)
        # After the first window, each further one scores STEP more ids.
        more = np.maximum(0, -(-(sizes - 1 - WINDOW) // STEP))
        owners = np.repeat(everyone, more)
        number = np.arange(len(owners)) - np.repeat(np.cumsum(more) - more, more) + 1
        starts = begin[owners] + number * STEP + (WINDOW - 2 * STEP)
        self._windows(line, starts, WINDOW - STEP, sums, owners, (begin + sizes)[owners])
        return sums


def _long(values):
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _word_counts(train: DataFrame) -> DataFrame:
    """(word, n) over all training texts, ends included; words as hashes."""

    def counted(held):
        kinds, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([_long(kinds), pa.array(n.astype(np.int64))], ["word", "n"])

    def run(batches):
        held = []
        for part in slices(batches, limit=BLOCK_BYTES):
            hashes, counts = hashed_words(part.column("text"))
            held += [hashes, np.full(len(counts), END)]
            if sum(map(len, held)) >= HELD_WORDS:
                yield counted(held)
                held = []
        if held:
            yield counted(held)

    return (
        train.select("text").mapInArrow(run, "word bigint, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def _frequent_from(counts: DataFrame, most: int) -> int:
    """Least count from which on there are at most ``most`` words, to an eighth of a power of two."""
    step = F.floor(F.log2("n") * 8).alias("step")
    sizes = {r.step: r["count"] for r in counts.groupBy(step).count().collect()}
    least, total = max(sizes, default=0) + 1, 0
    for step in sorted(sizes, reverse=True):
        total += sizes[step]
        if total > most:
            break
        least = step
    return int(np.ceil(2 ** (least / 8)))


def pack_ids(ids):
    """Ids as two bytes each."""
    return np.asarray(ids).astype("<u2").tobytes()


def unpack_ids(data):
    return np.frombuffer(data, "<u2").astype(np.int64)


def _round(rounds: int) -> Column:
    """The round in which a text is learnt from; -1 for texts not to learn from."""
    own = F.pmod(F.xxhash64("doc_id", "tag"), F.lit(rounds)).cast("int")
    return F.when(F.col("learn"), own).otherwise(F.lit(-1))


def _subwords(own: DataFrame, model_file: str, id_type: str) -> DataFrame:
    """(doc_id, tag, learn, ids) of every text; ids are packed."""

    def run(batches):
        with kept_table(model_file) as held:
            for part in slices(batches, limit=BLOCK_BYTES):
                held[0] = held[0].renewed()
                packed = [pack_ids(ids) for ids in subword_ids(part.column("text"), held[0])]
                columns = [part.column(c) for c in ("doc_id", "tag", "learn")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(packed, pa.binary())], ["doc_id", "tag", "learn", "ids"]
                )

    return own.mapInArrow(run, f"doc_id {id_type}, tag bigint, learn boolean, ids binary")


def _slopes_of_all(subwords: DataFrame, model: Attention, kinds) -> dict:
    """Sums of slopes over all texts of ``subwords``, and the number of ids in ``used``.

    Tasks send blocks of their sums, which are added up by block; the driver gets each block once.
    """
    shapes = {k: v.shape for k, v in model.p.items()} | {"used": (1,)}
    ends = np.cumsum([0, *(np.prod(s) for s in shapes.values())])
    shared = subwords.sparkSession.sparkContext.broadcast((model, kinds))

    def zeros():
        whole = np.zeros(ends[-1])
        return whole, {k: whole[a:b].reshape(s) for (k, s), a, b in zip(shapes.items(), ends, ends[1:])}

    def rows(blocks):
        for at in range(0, len(blocks), ROWS_PER_PASS):
            part = blocks[at : at + ROWS_PER_PASS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in part], pa.int64()), pa.array([v.tobytes() for _, v in part], pa.binary())],
                ["block", "slopes"],
            )

    def run(batches):
        model, kinds = shared.value
        whole, sums = zeros()
        for part in slices(batches, "ids", PACKED_BYTES):
            model.text_slopes([unpack_ids(p) for p in part.column("ids").to_pylist()], kinds, sums)
        if sums["used"][0]:
            cut = [whole[i : i + SLOPE_BLOCK] for i in range(0, len(whole), SLOPE_BLOCK)]
            yield from rows([(i, c) for i, c in enumerate(cut) if c.any()])

    def add(batches):
        found = {}
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("slopes")):
                slopes = np.frombuffer(packed.as_buffer())
                found[block] = found[block] + slopes if block in found else slopes.copy()
        yield from rows(sorted(found.items()))

    kind = "block bigint, slopes binary"
    table = subwords.select("ids").mapInArrow(run, kind).repartition("block").mapInArrow(add, kind).toArrow()
    whole, sums = zeros()
    for block, packed in zip(table["block"].to_pylist(), table["slopes"].to_pylist()):
        whole[block * SLOPE_BLOCK :][:SLOPE_BLOCK] = np.frombuffer(packed)
    shared.destroy()
    return sums


def learn_from_all(model: Attention, subwords: DataFrame, kinds, rounds: int = ALL_ROUNDS) -> int:
    """Steps of Adam from round to round, each over the whole texts that belong to it; the ids learnt from."""
    first = {k: np.zeros(v.shape) for k, v in model.p.items()}
    second = {k: np.zeros(v.shape) for k, v in model.p.items()}
    # Stored by round, the texts of the other rounds are not read.
    if "round" not in subwords.columns:
        subwords = subwords.withColumn("round", _round(rounds))
    total, t = 0, 0
    for number in range(rounds):
        sums = _slopes_of_all(subwords.where(F.col("round") == number), model, kinds)
        used = sums.pop("used")[0]
        if not used:
            continue
        total, t = total + int(used), t + 1
        for name, slope in sums.items():
            first[name] += 0.3 * (slope / used - first[name])
            second[name] += 0.1 * ((slope / used) ** 2 - second[name])
            move = first[name] / (1 - 0.7**t) / (np.sqrt(second[name] / (1 - 0.9**t)) + 1e-8)
            model.p[name] -= (ALL_RATE * move).astype(np.float32)
    return total


def _id_counts(subwords: DataFrame, size: int) -> np.ndarray:
    """Count of every subword id over all training texts: one row per id."""

    def run(batches):
        sums = np.zeros(size, np.int64)
        for batch in batches:
            sums += np.bincount(unpack_ids(b"".join(batch.column("ids").to_pylist())), minlength=size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["id", "n"])

    table = (
        subwords.where("learn").select("ids").mapInArrow(run, "id bigint, n bigint")
        .groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(size)
    counts[table["id"].to_numpy()] = table["n"].to_numpy()
    return counts


def train_model(own: DataFrame, subwords: DataFrame, model_file: str, train_docs: int = TRAIN_DOCS) -> Scorer:
    """Classes and attention from the ids of all texts to learn from; a sample gives the start."""
    model = load(model_file)
    counts = _id_counts(subwords, model.get_piece_size())
    kinds, shares = id_classes(counts, [model.id_to_piece(i) for i in range(len(counts))])
    texts = [r["text"] for r in sample_texts(own.where("learn"), train_docs, TRAIN_CHARS)]
    attention = Attention(len(counts))
    table = HashedChunkTable(model)
    attention.train(subword_ids(texts, table), kinds)
    learn_from_all(attention, subwords, kinds)
    return Scorer(attention, kinds, shares)


def score_texts(
    docs: DataFrame,
    learn: Column,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """Base and model score of every document.

    ``learn`` is true for the rows of ``docs`` to learn from. Returns id, tag (hash of the text), n_tokens (words
    and an end), n_known (tokens that training texts have), train_tokens, base_score (log10, words with one added
    to their counts) and score (the model's log10 chance of the lowered text and its end).

    NULL is taken as the empty text: one token, its end. Rows that share an id each get a row.
    Without training texts every id and word is as likely as any other. An empty
    table gives an empty one. Other columns are not read.
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    own = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    ).withColumn("tag", F.xxhash64("text"))
    id_type = own.schema["doc_id"].dataType.simpleString()
    if load(model_file).get_piece_size() > 1 << 16:
        raise ValueError("ids are stored in two bytes")
    packed = _subwords(own, model_file, id_type).withColumn("round", _round(ALL_ROUNDS))
    subwords, _ = work.store(packed, "subwords", partition_by="round")
    counts, seen = work.store(
        _word_counts(own.where("learn")), "words", tokens=F.coalesce(F.sum("n"), F.lit(0)), kinds=F.count("*")
    )
    n_all, n_kinds = seen["tokens"], seen["kinds"]
    is_end = F.col("word") == int(END)
    top = counts.where(is_end | (F.col("n") >= _frequent_from(counts, frequent))).toArrow()
    words = top["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    context = spark.sparkContext
    common = context.broadcast((words[order], top["n"].to_numpy()[order]))
    scorer = context.broadcast(train_model(own, subwords, model_file))

    def log_share(n):
        return np.log10((n + 1) / (n_all + n_kinds + 1))

    def split(hashes):
        """Counts of words, and which of them are among the frequent."""
        words, numbers = common.value
        if not len(words):
            return np.zeros(len(hashes)), np.zeros(len(hashes), bool)
        kinds, places = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(words, kinds), len(words) - 1)
        found = words[at] == kinds
        return np.where(found, numbers[at], 0)[places], found[places]

    def by_model(batches):
        for part in slices(batches, "ids", PACKED_BYTES):
            ids = [unpack_ids(packed) for packed in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("tag"), pa.array(scorer.value.score(ids))],
                ["doc_id", "tag", "score"],
            )

    def by_words(batches):
        """Sums over the frequent words of each text, and a row for each other word."""
        end, _ = split(np.array([END]))
        for part in slices(batches, limit=BLOCK_BYTES):
            hashes, sizes = hashed_words(part.column("text"))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            n, found = split(hashes)
            base = np.bincount(owner[found], log_share(n[found]), len(sizes)) + log_share(end[0])
            known = np.bincount(owner[found], minlength=len(sizes)) + int(end[0] > 0)
            rare = owner[~found]
            rows = pa.array(np.concatenate([np.arange(len(sizes)), rare]))
            pad = pa.nulls(len(rare), pa.int64())
            whole = [pa.array(sizes + 1), pa.array(known), pa.array(base)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(rows),
                    part.column("tag").take(rows),
                    pa.concat_arrays([pa.nulls(len(sizes), pa.int64()), _long(hashes[~found])]),
                    *(pa.concat_arrays([w, pad.cast(w.type)]) for w in whole),
                ],
                ["doc_id", "tag", "word", "n_tokens", "n_known", "base"],
            )

    scored, _ = work.store(
        subwords.mapInArrow(by_model, f"doc_id {id_type}, tag bigint, score double"), "scored"
    )
    work.drop("subwords")
    parts = own.mapInArrow(
        by_words,
        f"doc_id {id_type}, tag bigint, word bigint, n_tokens bigint, n_known bigint, base double",
    )
    n = F.coalesce("n", F.lit(0))
    spread = F.coalesce("word", F.xxhash64("doc_id", "tag"))
    looked_up = parts.join(
        counts.withColumnRenamed("word", "__word"),
        (spread == F.col("__word")) & F.col("word").isNotNull(),
        "left",
    )
    rare = F.col("word").isNotNull()
    summed = looked_up.groupBy(F.col("doc_id").alias("__doc"), F.col("tag").alias("__tag")).agg(
        F.count_if(~rare).alias("copies"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.when(rare, (n > 0).cast("long")).otherwise(F.col("n_known"))).alias("n_known"),
        F.sum(
            F.when(rare, F.log10((n + 1) / F.lit(float(n_all + n_kinds + 1)))).otherwise(F.col("base"))
        ).alias("base"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("tag") == F.col("__tag"))
    # Rows that share id and text are in one sum, each with the same part.
    return scored.join(summed, same).select(
        F.col("doc_id").alias(id_col),
        "tag",
        "n_tokens",
        F.expr("n_known div copies").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"),
        "score",
    )
