"""Spelling variants: words one edit apart, each led to its most frequent form.

Two words are near if they differ by one inserted, deleted or replaced code
point. The shorter (or either, at equal length) is cut into two disjoint chunks,
its halves. The edit leaves one of them whole, and the other word holds it as a
positional gram: the first half at its own place, the second at its own place or
one further on. Grams that no single edit can align are not made. Words meet by a
hash of (length, half, chunk) and every pair is verified.

Where so many words share a chunk that their pairs would be too many, they do not
meet by it alone: what is left of each word is cut into halves again, and so on
until the groups are small or all but one code point is shared, when every pair
is a result or one of few. No group is left out or cut short.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import slices, written
from wardhouse.operators.joins import join_dimension

#: Least code points and least occurrences of a word.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form occurs at least so many times as often as the word that it stands for.
RATIO = 2
#: Pairs that a group may have before what is left of its words is cut again.
PAIRS = 4096
#: Up to so many keys of larger groups are broadcast; more are joined by shuffle.
FEW_KEYS = 500_000
#: Words that a task counts before it gives them out.
HELD = 400_000

#: Latin-1 bytes of A-Z in lower case, a-z and U+00C0 to U+00FF; blanks for all others.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def runs(text: str) -> list[bytes]:
    """The letter runs of a text, A-Z lower-cased, in Latin-1 (a byte is a code point)."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _slipped(word: bytes, doc: int, every: int) -> bytes:
    code = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), doc)
    if code % every:
        return word
    at = code % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame,
    slip: int | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n) of every letter run of the whole texts that is long and frequent enough.

    With ``slip``, a run loses one code point where slip divides the crc32 of
    ``<id>:<run>`` (a null id is written as nothing). A null text has no runs.
    Runs are counted in each document, then in each task, then by shuffle.
    """
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_pydict(
            {"word": pa.array(words, pa.string()), "n": pa.array(counts.values(), pa.int64())}
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches, "text"):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc = zlib.crc32(f"{key}:".encode())
                for word, n in Counter(runs(text)).items():
                    if len(word) >= least_length:
                        if slip:
                            word = _slipped(word, doc, slip)
                            if len(word) < least_length:
                                continue
                        counts[word] += n
                if len(counts) >= HELD:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    counted = texts.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _left() -> Column:
    """Code points of the chunk word between what is already shared."""
    return F.col("b") - F.col("a") - F.col("shift")


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: once as having its first half left whole by the edit, once its second.

    A row is a word with the code points [a, b) that may hold the edit; ``shift``
    is 1 where the other word is one shorter.
    """
    half = F.floor(_left() / 2).cast("int")
    behind = F.col("a") + half + F.col("shift")
    first = F.substring("word", F.col("a") + 1, half)
    second = F.substring("word", behind + 1, F.col("b") - behind)
    sides = F.array(
        F.struct(
            F.xxhash64("key", F.lit(1), first).alias("key"),
            (F.col("a") + half).alias("a"),
            F.col("b").alias("b"),
        ),
        F.struct(F.xxhash64("key", F.lit(2), second).alias("key"), F.col("a").alias("a"), behind.alias("b")),
    )
    return rows.select("word", "n", "shift", F.inline(sides))


def _met(rows: DataFrame) -> DataFrame:
    """(a, an, b, bn): the near words among those of one key, each pair once for every shared key."""
    chunk = rows.where("shift = 0").select("key", F.col("word").alias("a"), F.col("n").alias("an"))
    gram = rows.select("key", "shift", F.col("word").alias("b"), F.col("n").alias("bn"))
    return (
        chunk.join(gram, "key")
        .where((F.col("shift") == 1) | (F.col("a") < F.col("b")))
        .where(F.levenshtein("a", "b", 1) == 1)
        .select("a", "an", "b", "bn")
    )


def near_words(words: DataFrame) -> DataFrame:
    """(a, an, b, bn) of every pair of near words, once, of distinct words (word, n).

    The words should be a written table. Rounds go on while some group has more
    than PAIRS pairs and more than one code point that is not shared, so there are
    at most about as many as the binary logarithm of the longest word.
    """
    start = words.select(
        "word",
        "n",
        F.explode(F.array(F.lit(0), F.lit(1))).alias("shift"),
        F.lit(0).alias("a"),
        F.length("word").alias("b"),
    ).withColumn("key", _left().cast("long"))
    rows, found = _halved(start.where(_left() > 0)), []
    while True:
        large = (
            rows.where(_left() > 1)
            .groupBy("key")
            .agg(F.count_if(F.col("shift") == 0).alias("chunks"), F.count("*").alias("grams"))
            .where(F.col("chunks") * F.col("grams") > PAIRS)
        )
        large = written(large.select("key", F.lit(True).alias("large")), "large-groups")
        number = large.count()
        if not number:
            found.append(written(_met(rows), "near-words"))
            break
        if number <= FEW_KEYS:
            marked = rows.join(F.broadcast(large), "key", "left")
        else:
            marked = join_dimension(rows, large, ["key"], "left", spread_by=["word", "shift"])
        again = F.col("large").isNotNull() & (_left() > 1)
        found.append(written(_met(marked.where(~again)), "near-words"))
        rows = written(_halved(marked.where(again)), "halved")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word that has a form, by doubling the steps taken.

    Counts at least double at every step, so a chain has at most about 60 of
    them, and six rounds reach its end.
    """
    now = written(forms, "forms")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = join_dimension(now, onward, ["root"], "left", spread_by=["word"])
        moved = written(step.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if not moved.where("next is not null").limit(1).count():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    slip: int | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    A word's form is its most frequent near word, the first in code-point order
    at a tie, if that occurs at least ``ratio`` (2 or more) times as often as the
    word; else null. The root is what the forms lead to in the end, the word
    itself without a form. Null texts and texts without words add nothing,
    repeated rows count each time, an empty table gives no rows, and other columns
    are not read.
    """
    if ratio < 2:
        raise ValueError("forms may lead round in a circle below a ratio of 2")
    words = written(
        word_counts(docs, slip, least_length, least_count, id_col, text_col), "words"
    )
    pairs = near_words(words)
    both = pairs.select(F.col("a").alias("word"), "an", "b", "bn").union(pairs.select("b", "bn", "a", "an"))
    near = (
        both.groupBy("word", F.col("an").alias("n"))
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("bn")).alias("less"), "b")).alias("best"))
        .select("word", "n_near", F.col("best.b").alias("form"), (-F.col("best.less")).alias("form_n"), "n")
    )
    led = F.col("form_n") >= ratio * F.col("n")
    near = written(
        near.select(
            "word", "n_near", F.when(led, F.col("form")).alias("form"), F.when(led, F.col("form_n")).alias("form_n")
        ),
        "near-counts",
    )
    roots = _roots(near.where("form is not null").select("word", F.col("form").alias("root")))
    return words.join(near.join(roots, "word", "left"), "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        "form_n",
    )
