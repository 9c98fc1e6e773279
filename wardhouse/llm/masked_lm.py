"""Masked pseudo-likelihood: every word predicted from the words on both sides."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import slices, without, written

#: The least network: so many classes of so many tokens. Both grow with the fourth root of the number
#: of words in the corpus, the tokens with its square root.
CLASSES, MEMBERS = 32, 32
TOKENS = CLASSES * MEMBERS
#: One of so many tokens is shared by the words that have none of their own and end alike.
SHARED = 8
#: Words on either side, numbers for each word, and hidden units.
SIDE, WIDTH, HIDDEN = 2, 12, 32
#: Every position is masked in one of the rounds.
ROUNDS = 2
BATCH, RATE = 4096, 2.0
#: Positions that are scored at once, and about how many of them lie in the processor's cache.
STEP, PART = 16_384, 768
#: Weights in a row of the shuffle, and the most bytes of coded texts handled at once inside a task.
BLOCK, CODED_BYTES = 16_384, 4_000_000
#: Tasks know the counts of so many frequent words (or of all that are tokens); others are joined.
KNOWN = 262_144
#: Scores up to this are summed as powers of e without taking their largest off first.
LARGEST = 60
#: The hyperbolic tangent of this is 1.
ALWAYS = 30.0
#: The count of a word that the counted texts do not have.
UNSEEN = 1e-3


class Tokens(dict):
    """The token of each word (bytes): its own, or from ``first`` on one of ``shared`` by its ending."""

    def __init__(self, words: list[bytes], shared: int):
        super().__init__(zip(words, range(len(words)), strict=True))
        self.first, self.shared = 0, shared

    def __missing__(self, word: bytes) -> int:
        return self.by_ending(word[-3:])

    def by_ending(self, ending: bytes) -> int:
        return self.first + zlib.crc32(ending) % self.shared

    def __reduce__(self):
        return _tokens, (list(self), self.first, self.shared)


def _tokens(words: list[bytes], first: int, shared: int) -> Tokens:
    out = Tokens(words, shared)
    out.first = first
    return out


class Shares(dict):
    """What a word's log-probability has beside its token's: 0 for a token of its own, else minus the
    log of the shared token's count; the log of the word's own count is added by a join."""

    def __init__(self, token: Tokens, held: np.ndarray):
        super().__init__()
        self.token, self.logs = token, np.log(held)

    def __missing__(self, word: bytes) -> float:
        return 0.0 if word in self.token else -float(self.logs[self.token[word]])


@dataclass(frozen=True)
class MaskedModel:
    """Tokens and shares of words, the network, the exact (word, n) of all texts as a table, of it the
    most frequent words that share a token with the logs of their counts, and the coded texts of the
    column of the frame it was fitted on."""

    token: Tokens
    own: Shares
    weights: dict[str, np.ndarray]
    counts: DataFrame
    others: pa.Array
    logs: np.ndarray
    fitted: tuple[DataFrame, str]
    coded: DataFrame


def buckets(text: str | None) -> list[bytes]:
    """The words of a text."""
    return (text or "").encode().split()


def fresh_weights(shares: np.ndarray) -> dict[str, np.ndarray]:
    """First weights: small and the same everywhere; the offsets give the tokens' shares."""
    rng = np.random.default_rng(7)
    side = math.isqrt(len(shares))
    table = np.log(shares.reshape(side, side))
    top = np.logaddexp.reduce(table, axis=1)
    return {
        "words": rng.normal(0, 0.1, (len(shares) + 1, WIDTH)).astype(np.float32),
        "hidden": rng.normal(0, 0.2, (2 * SIDE * WIDTH, HIDDEN)).astype(np.float32),
        "shift": np.zeros(HIDDEN, np.float32),
        "classes": np.zeros((HIDDEN, side), np.float32),
        "class_shift": top.astype(np.float32),
        "members": np.zeros((side, HIDDEN, side), np.float32),
        "member_shift": (table - top[:, None]).astype(np.float32),
    }


def contexts(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The words around each position; ``tokens`` has SIDE marks of an edge (the number of tokens) at
    either end and between texts."""
    steps = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])
    return tokens[at[:, None] + steps[None, :]]


def _tame(z: np.ndarray, axis: int) -> np.ndarray:
    """Scores, in place, whose powers of e can be summed along the axis: large ones less the largest."""
    if max(z.max(), -z.min()) > LARGEST:
        z -= z.max(axis, keepdims=True)
    return z


def joined(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """A copy of the weights with each shift as the last row of its matrix, for a hidden unit that is always 1."""
    return {
        "words": w["words"].copy(),
        "hidden": np.pad(w["hidden"], ((0, 0), (0, 1))),
        "shift": np.append(w["shift"], w["shift"].dtype.type(ALWAYS)),
        "classes": np.vstack([w["classes"], w["class_shift"]]),
        "members": np.concatenate([w["members"], w["member_shift"][:, None]], axis=1),
    }


def parted(v: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The weights that were joined."""
    return {
        "words": v["words"],
        "hidden": v["hidden"][:, :-1],
        "shift": v["shift"][:-1],
        "classes": v["classes"][:-1],
        "class_shift": v["classes"][-1],
        "members": v["members"][:, :-1],
        "member_shift": v["members"][:, -1],
    }


def _forward(v: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = v["words"].take(around.ravel(), 0).reshape(len(around), -1)
    h = x @ v["hidden"]
    h += v["shift"]
    np.tanh(h, out=h)
    return x, h, v["classes"].T @ h.T


def forward(w: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden values and scores of the classes for each context: a column of the last is one context."""
    x, h, tops = _forward(joined(w), around)
    return x, h[:, :-1], tops


def _by_class(group: np.ndarray, most: int) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
    """Rows in the order of their classes, and (class, begin, end) of each that has some, a class being
    whole: in parts of about ``most`` rows, whose scores stay in the processor's cache."""
    order = np.argsort(group.astype(np.uint16), kind="stable")
    ends = np.bincount(group).cumsum().tolist()
    parts, rows = [], most
    for c, (a, b) in enumerate(zip([0, *ends], ends)):
        if a < b:
            if rows >= most:
                parts.append([])
                rows = 0
            parts[-1].append((c, a, b))
            rows += b - a
    return order, parts


def _within(v: dict[str, np.ndarray], h: np.ndarray, classes: list[tuple[int, int, int]]) -> np.ndarray:
    """Scores within its class for each context, a row; contexts are in the order of their classes."""
    z, first = np.empty((len(h), v["members"].shape[2]), h.dtype), classes[0][1]
    for c, a, b in classes:
        np.dot(h[a - first : b - first], v["members"][c], out=z[a - first : b - first])
    return z


def log_probability(w: dict[str, np.ndarray], around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of each target token: of its class, and of it within the class."""
    return _log_probability(joined(w), around, target)


def _log_probability(v: dict[str, np.ndarray], around: np.ndarray, target: np.ndarray) -> np.ndarray:
    group, member = np.divmod(target, v["members"].shape[2])
    order, parts = _by_class(group, PART)
    around, group, member = around[order], group[order], member[order]
    sums = np.empty(len(target), v["words"].dtype)
    for classes in parts:
        rows = slice(classes[0][1], classes[-1][2])
        each = np.arange(rows.stop - rows.start)
        _, h, tops = _forward(v, around[rows])
        score = _tame(tops, 0)[group[rows], each]
        np.exp(tops, out=tops)
        score -= np.log(np.ones(len(tops), tops.dtype) @ tops)
        z = _tame(_within(v, h, classes), 1)
        score += z[each, member[rows]]
        np.exp(z, out=z)
        score -= np.log(z @ np.ones(z.shape[1], z.dtype))
        sums[order[rows]] = score
    return sums


def train_step(w: dict[str, np.ndarray], around: np.ndarray, target: np.ndarray, rate: float) -> None:
    """One step down the gradient of the mean loss, in place."""
    v = joined(w)
    _step(v, around, target, rate)
    for name, new in parted(v).items():
        w[name][...] = new


def _step(v: dict[str, np.ndarray], around: np.ndarray, target: np.ndarray, rate: float) -> None:
    """A step on joined weights.

    Powers of e stay as they are: not they but the narrow hidden values are divided by their sums.
    A class's members change at once, since one part has all of its rows; what all rows share
    changes at the end.
    """
    rate /= len(target)
    group, member = np.divmod(target, v["members"].shape[2])
    order, parts = _by_class(group, PART)
    around, group, member = around[order], group[order], member[order]
    down = {k: np.zeros_like(v[k]) for k in ("classes", "hidden", "shift")}
    d_x = np.empty((len(v["hidden"]), len(target)), v["hidden"].dtype)
    for classes in parts:
        rows = slice(classes[0][1], classes[-1][2])
        each = np.arange(rows.stop - rows.start)
        x, h, tops = _forward(v, around[rows])
        np.exp(_tame(tops, 0), out=tops)
        total = np.ones(len(tops), tops.dtype) @ tops
        tops[group[rows], each] -= total
        share = (1 / total)[:, None]
        d_h = tops.T @ v["classes"].T
        d_h *= share
        down["classes"] += (tops @ (h * share)).T
        z = _tame(_within(v, h, classes), 1)
        np.exp(z, out=z)
        total = z @ np.ones(z.shape[1], z.dtype)
        z[each, member[rows]] -= total
        share = (1 / total)[:, None]
        sides, d_sides, first = h * (share * rate), np.empty_like(h), rows.start
        for c, a, b in classes:
            own, inner = v["members"][c], z[a - first : b - first]
            np.dot(inner, own.T, out=d_sides[a - first : b - first])
            own -= np.dot(sides[a - first : b - first].T, inner)
        d_sides *= share
        d_h += d_sides
        h *= h
        np.subtract(1, h, out=h)  # 0 for the unit that is always 1
        d_h *= h
        np.matmul(v["hidden"], d_h.T, out=d_x[:, rows])
        down["hidden"] += x.T @ d_h
        down["shift"] += d_h.sum(0)
    for name, step in down.items():
        v[name] -= rate * step
    # Only the words that occur change; a number's steps lie one after the other.
    there = np.zeros(len(v["words"]), bool)
    there[around] = True
    used, place = np.flatnonzero(there), np.empty(len(there), np.int64)
    place[used] = np.arange(len(used))
    place, d_x = place[around.T.ravel()], d_x.reshape(around.shape[1], WIDTH, -1)
    step = np.zeros((WIDTH, len(used)), d_x.dtype)
    for k in range(WIDTH):
        np.add.at(step[k], place, d_x[:, k].ravel())
    v["words"][used] -= rate * step.T


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, one after the other, and how many each text has: as ``buckets``."""
    parts = pc.ascii_split_whitespace(texts)
    words = parts.flatten().cast(pa.binary())
    some = pc.greater(pc.binary_length(words), 0)
    before = np.zeros(len(words) + 1, np.int64)
    np.cumsum(some.to_numpy(zero_copy_only=False), out=before[1:])
    ends = pc.list_value_length(parts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    return words.filter(some), np.diff(before[ends], prepend=0)


def tokens_of(token: Tokens, own: pa.Array, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The tokens of words, and which of them share theirs; ``own`` has the words that do not."""
    found = pc.index_in(words, value_set=own)
    rare = found.is_null()
    ends = pc.binary_slice(words.filter(rare), -3).dictionary_encode()
    shared = np.array([token.by_ending(e) for e in ends.dictionary.to_pylist()], np.int32)
    ids = found.fill_null(0).to_numpy().copy()
    ids[rare.to_numpy(zero_copy_only=False)] = shared[ends.indices.to_numpy()]
    return ids, rare


def coded(texts: DataFrame, token: Tokens, others: pa.Array, logs: np.ndarray) -> DataFrame:
    """(key, ids, known, words, times) of texts (key, text): the tokens of a text's words, the sum of
    the logs of the counts of the ``others`` in it, and its words of neither kind, each once."""
    kind = _kind(token)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.array(list(token), pa.binary())
        for batch in slices(batches, "text"):
            words, counts = words_of(batch.column(1))
            ids, rare = tokens_of(token, own, words)
            starts = np.concatenate([[0], counts.cumsum()])
            owner = np.repeat(np.arange(len(counts)), counts)[rare.to_numpy(zero_copy_only=False)]
            words = words.filter(rare)
            place = pc.index_in(words, value_set=others).fill_null(-1).to_numpy()
            known = np.bincount(owner[place >= 0], logs[place[place >= 0]], len(counts)).astype(float)
            owner, words = owner[place < 0], words.filter(pa.array(place < 0)).dictionary_encode()
            most = max(1, len(words.dictionary))
            pairs, times = np.unique(owner * most + words.indices.to_numpy(), return_counts=True)
            owner, word = np.divmod(pairs, most)
            rows = pa.array(np.searchsorted(owner, np.arange(len(counts) + 1)), pa.int32())
            bounds = pa.py_buffer((starts * kind.itemsize).astype(np.int32))
            columns = [
                batch.column(0),
                pa.Array.from_buffers(pa.binary(), len(counts), [None, bounds, pa.py_buffer(ids.astype(kind))]),
                pa.array(known),
                pa.ListArray.from_arrays(rows, words.dictionary.take(pa.array(word))),
                pa.ListArray.from_arrays(rows, pa.array(times)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "known", "words", "times"])

    return texts.mapInArrow(code, "key binary, ids binary, known double, words array<binary>, times array<long>")


def _kind(token: Tokens) -> np.dtype:
    return np.dtype(np.uint16 if token.first + token.shared < 1 << 16 else np.uint32)


def _decoded(token: Tokens, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of some coded texts, one after the other, and how many each text has."""
    kind = _kind(token)
    return np.frombuffer(b"".join(column.to_pylist()), kind), pc.binary_length(column).to_numpy() // kind.itemsize


def laid_out(ids: np.ndarray, counts: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of several texts with edge marks around each, and where the words lie."""
    at = np.arange(len(ids)) + SIDE * np.repeat(np.arange(1, len(counts) + 1), counts)
    tokens = np.full(len(ids) + SIDE * (len(counts) + 1), edge, np.int32)
    tokens[at] = ids
    return tokens, at


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): every distinct word of the column text, counted exactly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = words_of(batch.column(0))[0].value_counts()
            yield pa.RecordBatch.from_arrays(found.flatten(), ["word", "n"])

    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, sizes: pd.DataFrame, most: int) -> pa.Table:
    """The ``most`` most frequent words with their counts; ``sizes`` has how many words (words) have
    each count (n). Less frequent ones are left out before any are sorted."""
    sizes = sizes.sort_values("n", ascending=False)
    last = int(np.searchsorted(sizes.words.cumsum(), most))
    least = int(sizes.n.iloc[min(last, len(sizes) - 1)]) if len(sizes) else 0
    return counts.select("word", "n").where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most).toArrow()


def fit(docs: DataFrame, text_col: str = "text") -> MaskedModel:
    """Count all words exactly, then train the network on every position of all texts.

    Of N words, about sqrt(N) tokens (TOKENS at least): the most frequent words
    have their own, the others share one of SHARED by their ending and are told
    apart by their counts. In each of ROUNDS rounds every task goes through its
    rows from the same weights, masking its share of the positions, and the
    tasks' weights are averaged, by the positions they saw, in a shuffle. The
    driver gets the frequent words and one set of weights; the counts stay a table.
    """
    texts = _texts(docs, text_col)
    counts = written(word_counts(texts.select("text")), "word-counts")
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).toPandas()
    side = max(MEMBERS, math.isqrt(math.isqrt(int((sizes.n * sizes.words).sum()))) + 1)
    tokens = side * side
    shared = tokens // SHARED
    top = most_frequent(counts, sizes, max(tokens - shared, KNOWN))
    words, n = top["word"].combine_chunks(), top["n"].to_numpy()
    own, others, logs = words[: tokens - shared], words[tokens - shared :], np.log(n[tokens - shared :])
    token = _tokens(own.to_pylist(), tokens - shared, shared)
    held = np.full(tokens, UNSEEN)
    held[: len(own)] += n[: len(own)]

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(tokens, np.int64)
        for batch in batches:
            ids, _ = tokens_of(token, own, batch.column(0))
            rare = ids >= token.first
            np.add.at(total, ids[rare], batch.column(1).to_numpy()[rare])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["token", "n"])

    sums = counts.select("word", "n").mapInArrow(rest, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    held[sums.token.to_numpy(int)] += sums.n.to_numpy(float)
    weights = fresh_weights(held / held.sum())
    texts = written(coded(texts, token, others, logs), "coded-texts")
    for step in range(ROUNDS):
        weights = _trained(texts, token, weights, step)
    return MaskedModel(token, Shares(token, held), weights, counts, others, logs, (docs, text_col), texts)


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(key, text) of the texts there are."""
    return docs.select(_key(text_col).alias("key"), F.col(f"`{text_col}`").alias("text")).where("text is not null")


def _key(text_col: str) -> Column:
    return F.unhex(F.md5(F.col(f"`{text_col}`")))


def _trained(texts: DataFrame, token: Tokens, weights: dict[str, np.ndarray], step: int) -> dict[str, np.ndarray]:
    edge = len(weights["words"]) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = joined(weights)
        seen = 0
        for batch in slices(batches, "ids", CODED_BYTES):
            ids, counts = _decoded(token, batch.column(0))
            tokens, at = laid_out(ids, counts, edge)
            at = at[(np.arange(len(at)) - np.repeat(counts.cumsum() - counts, counts)) % ROUNDS == step]
            for begin in range(0, len(at), BATCH):
                part = at[begin : begin + BATCH]
                _step(mine, contexts(tokens, part), tokens[part], RATE * len(part) / BATCH)
            seen += len(at)
        if seen:
            flat = np.concatenate([v.ravel() for v in parted(mine).values()])
            for block, begin in enumerate(range(0, len(flat), BLOCK)):
                part = flat[begin : begin + BLOCK].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([seen]), pa.array([part])], ["block", "seen", "part"])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            for block, seen, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                old, before = total.get(block, (0.0, 0))
                total[block] = old + np.frombuffer(part, np.float32).astype(float) * seen, before + seen
        parts = [(s / n).astype(np.float32).tobytes() for s, n in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(parts, pa.binary())], ["block", "part"])

    rows = texts.select("ids").mapInArrow(run, "block int, seen long, part binary").repartition("block")
    means = rows.mapInArrow(mean, "block int, part binary").toPandas().sort_values("block")
    if not len(means):
        return weights
    flat, out, start = np.frombuffer(b"".join(means["part"]), np.float32), {}, 0
    for name, old in weights.items():
        out[name] = flat[start : start + old.size].reshape(old.shape)
        start += old.size
    return out


def word_scores(v: dict[str, np.ndarray], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-probability of the token of every word of some texts, one after the other."""
    tokens, at = laid_out(ids, counts, len(v["words"]) - 1)
    out = np.empty(len(at))
    for begin in range(0, len(at), STEP):
        part = at[begin : begin + STEP]
        out[begin : begin + STEP] = _log_probability(v, contexts(tokens, part), tokens[part])
    return out


def text_scores(texts: DataFrame, model: MaskedModel) -> DataFrame:
    """(key, n_words, score) for each distinct coded text: its log-likelihood without the logs of the
    counts that tasks do not know."""
    token, weights = model.token, model.weights
    logs = np.where(np.arange(len(model.own.logs)) < token.first, 0.0, model.own.logs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = joined(weights)
        for batch in slices(batches, "ids", CODED_BYTES):
            ids, counts = _decoded(token, batch.column(1))
            owner = np.repeat(np.arange(len(counts)), counts)
            sums = np.bincount(owner, word_scores(v, ids, counts) - logs[ids], len(counts)) + batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(sums)], ["key", "n_words", "score"])

    rows = texts.select("key", "ids", "known").mapInArrow(score, "key binary, n_words long, score double")
    # Copies of a text have the same score but for rounding.
    return rows.groupBy("key").agg(F.max("n_words").alias("n_words"), F.max("score").alias("score"))


def shared_counts(texts: DataFrame, model: MaskedModel) -> DataFrame:
    """(key, logs): for each distinct coded text, the sum of the logs of the counts that tasks do not know."""
    rows = texts.select("key", F.size("words").alias("each"), F.explode(F.arrays_zip("words", "times")).alias("w"))
    rows = rows.select("key", "each", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    known = rows.join(model.counts, "word", "left")
    logs = F.col("times") * F.log(F.coalesce(F.col("n").cast("double"), F.lit(UNSEEN)))
    # Copies of a text have a key in common and give their rows once each.
    return known.groupBy("key").agg((F.sum(logs) * F.max("each") / F.count("*")).alias("logs"))


def pseudo_likelihood(docs: DataFrame, model: MaskedModel, text_col: str = "text") -> DataFrame:
    """Adds n_words, log_likelihood (the sum over all words) and per_word of every whole text.

    A null text or one without words has 0 words, log_likelihood 0 and per_word
    null. Columns with these names are replaced; repeated rows are each kept;
    an empty table gives an empty result. The frame the model was fitted on is
    not coded again.
    """
    if docs is model.fitted[0] and text_col == model.fitted[1]:
        texts = model.coded
    else:
        texts = written(coded(_texts(docs, text_col), model.token, model.others, model.logs), "coded-texts")
    docs = without(docs, ["n_words", "log_likelihood", "per_word"])
    found = text_scores(texts, model).join(shared_counts(texts, model), "key", "left")
    found = found.select(*[F.col(c).alias(f"__lm_{c}") for c in ("key", "n_words", "score", "logs")])
    scored = docs.withColumn("__lm_key", _key(text_col)).join(found, "__lm_key", "left")
    # A text that is there has its row in the coded ones; null must not hide one that is missing.
    empty = F.col("__lm_key").isNull()
    n = F.when(empty, F.lit(0).cast("long")).otherwise(F.col("__lm_n_words"))
    total = F.when(empty, F.lit(0.0)).otherwise(F.col("__lm_score") + F.coalesce("__lm_logs", F.lit(0.0)))
    return scored.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        n.alias("n_words"),
        total.alias("log_likelihood"),
        F.when(n > 0, total / n).alias("per_word"),
    )
