"""Near-duplicates: bottom-k sketches of one hash, inverted lists, union estimates, exact Jaccard."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import give_back_memory, slices, written
from wardhouse.llm.components import connected

#: Values of a sketch.
K = 64
#: A list up to this length is joined with itself; a longer one is compared in blocks.
SHORT = 256
BLOCK = 1024
#: Shingles whose holders are multiplied at once inside a block.
COLUMNS = 4096
#: Text bytes that a task takes apart at once.
TEXT_BYTES = 2_000_000
#: Up to so many texts are picked out by a broadcast of their 16-byte keys, more by a shuffle.
FEW_TEXTS = 500_000
#: Chance that a pair at the threshold is missed by the sketches.
MISS = 1e-8

_ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A to Z in lower case (bytes.lower changes no other character)."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """63-bit hashes of the distinct shingles in rising order; few words are one shingle."""
    if not words:
        return np.empty(0, np.int64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    mixed = np.full(n, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _ODD[0] + codes[k : k + n]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[1]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD[0]
    return np.unique((mixed >> np.uint64(1)).view(np.int64))


def least_shared(percent: int, k: int = K) -> int:
    """Values that the k least of two sets' union have in both, at least, but for MISS."""
    p, tail = percent / 100, 0.0
    for shared in range(k + 1):
        tail += math.comb(k, shared) * p**shared * (1 - p) ** (k - shared)
        if tail > MISS:
            return shared
    return k


def _needed(n: Column, percent: int) -> Column:
    """Values that a set of n shingles shares, in the sketches, with any set similar enough."""
    whole = F.ceil(n * percent / 100)
    return F.when(n * 100 <= K * percent, whole).otherwise(F.lit(least_shared(percent))).cast("int")


def sketches(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, n, print, sketch) of every row; print stands for the whole set."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("text_key"),
        F.col(text_col).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back_memory()
        for piece in slices(batches, "text", TEXT_BYTES):
            out = []
            for text in piece.column(2).to_pylist():
                hashes = shingle_hashes(words_of(text), size)
                mark = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
                out.append((len(hashes), mark, hashes[:K].copy()))  # a view would keep the whole set
            n, marks, values = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    piece.column(1),
                    pa.array(n, pa.int64()),
                    pa.array(marks, pa.binary()),
                    pa.array(values, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n", "print", "sketch"],
            )
        give_back_memory()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key binary, n long, print binary, sketch array<long>")


def rare_entries(classes: DataFrame, percent: int) -> DataFrame:
    """(value, node, n): the inverted lists that any similar pair meets in.

    Two similar sets share at least ``_needed`` values. With every sketch
    ordered by how many sketches hold a value, rarest first, such a pair has a
    common value among the first (size - needed + 1) of each. So the values that
    many hold are only used for sets that hardly have others.
    """
    values = classes.select("node", "n", F.explode("sketch").alias("value"))
    known = values.groupBy("value").agg(F.count("*").alias("holders")).where("holders > 1")
    common = (
        values.join(known, "value")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "value"))).alias("common"))
    )
    held = F.least(F.col("n"), F.lit(K))
    alone = held - F.size("common")
    first = F.greatest(held - _needed(F.col("n"), percent) + 1 - alone, F.lit(0)).cast("int")
    return common.select(F.explode(F.slice("common", 1, first)).alias("c"), "node", "n").select(
        F.col("c.value").alias("value"), "node", "n"
    )


def _alike(percent: int) -> Column:
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return small * 100 >= large * percent


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, a_n, b_n) whose sketches allow the similarity.

    Their sketches must share the values needed, and of the K least values of
    the sketches' union (the union's own sketch) enough must lie in both.
    """
    side = classes.select("node", "sketch")
    joined = pairs.join(side.select(F.col("node").alias("a"), F.col("sketch").alias("a_s")), "a").join(
        side.select(F.col("node").alias("b"), F.col("sketch").alias("b_s")), "b"
    )
    need = F.greatest(_needed(F.col("a_n"), percent), _needed(F.col("b_n"), percent))
    shared = F.array_intersect("a_s", "b_s")
    union = F.slice(F.array_sort(F.array_union("a_s", "b_s")), 1, K)
    both = F.size(F.array_intersect(shared, union))
    floor = F.lit(least_shared(percent)) / K
    return joined.where(F.size(shared) >= need).where(both >= floor * F.size(union)).select("a", "b")


def texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(node, text) of distinct nodes, written: one text of each class."""
    keys = written(classes.select("node", "text_key").join(nodes, "node"), "text-keys")
    wanted = keys.select("text_key")
    text_key = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    keyed = docs.select(text_key.alias("text_key"), F.col(text_col).alias("text"))
    few = keys.count() <= FEW_TEXTS
    keyed = keyed.join(F.broadcast(wanted) if few else wanted, "text_key", "left_semi")
    return written(keyed.dropDuplicates(["text_key"]).join(keys, "text_key").select("node", "text"), "texts")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int, text_col: str) -> DataFrame:
    """The pairs whose full shingle sets have the similarity, compared word by word."""
    pairs = written(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = texts_of(nodes, classes, docs, text_col)
    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back_memory()
        last, kept = None, set()
        for piece in slices(batches, "b_text", TEXT_BYTES):
            good = []
            for a, a_text, b_text in zip(*(piece.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if a != last:
                    last, kept = a, shingle_set(words_of(a_text), size)
                other = shingle_set(words_of(b_text), size)
                both = len(kept & other)
                good.append(100 * both >= percent * (len(kept) + len(other) - both))
            yield piece.select(["a", "b"]).filter(pa.array(good))
        del kept
        give_back_memory()

    return written(joined.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long"), "links")


def full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, size: int, text_col: str) -> DataFrame:
    """(node, hashes) of distinct nodes: all their shingles' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back_memory()
        for piece in slices(batches, "text", TEXT_BYTES):
            sets = [shingle_hashes(words_of(t), size) for t in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"])
        give_back_memory()

    return texts_of(nodes, classes, docs, text_col).mapInArrow(run, "node long, hashes array<long>")


def shingle_set(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    size = min(size, len(words))
    return set(zip(*(words[k:] for k in range(size)), strict=False))


def hub_pairs(entries: DataFrame, labels: DataFrame, hub: Column, shift: float, percent: int) -> DataFrame:
    """For each node the one hub, of those of its lists, that it meets most often and is not yet linked with.

    A list has a hub for each band of sizes; sizes of one band are within the
    threshold of each other. ``shift`` moves the bands.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + shift)
    rows = entries.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    rows = rows.withColumn("band", band)
    hubs = rows.groupBy("value", "band").agg(hub.alias("h"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    hubs = hubs.where("c0 <> c1").select(
        "value", "band", F.col("h.node").alias("b"), F.col("h.n").alias("b_n"), F.col("h.comp").alias("b_comp")
    )
    met = (
        rows.join(hubs, ["value", "band"])
        .where("comp <> b_comp")
        .select(F.col("node").alias("a"), F.col("n").alias("a_n"), "b", "b_n")
        .where(_alike(percent))
        .groupBy("a", "b", "a_n", "b_n")
        .agg(F.count("*").alias("times"))
    )
    best = met.groupBy("a", "a_n").agg(F.max(F.struct("times", "b", "b_n")).alias("best"))
    return best.select("a", F.col("best.b").alias("b"), "a_n", F.col("best.b_n").alias("b_n"))


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of hashes of one block are similar to which of another, by matrix products.

    Hashes that one set alone holds count for its size only.
    """
    sizes = np.array([len(s) for s in (*left, *right)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, at, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    shared = times[at] > 1
    owner, at = owner[shared], at[shared]
    _, at = np.unique(at, return_inverse=True)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    n = len(left)
    both = np.zeros((n, len(right)), np.float32)
    held = np.empty((len(sizes), COLUMNS), np.float32)
    for begin in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        part = slice(*np.searchsorted(at, [begin, begin + COLUMNS]))
        held[:] = 0
        held[owner[part], at[part] - begin] = 1
        both += held[:n] @ held[n:].T
    return 100 * both >= percent * (sizes[:n, None] + sizes[None, n:] - both)


def spanning(similar: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) that connect whatever the given links connect, no more than needed."""
    rows, columns = similar.shape
    group = list(range(rows + columns))

    def root(k: int) -> int:
        while group[k] != k:
            group[k] = group[group[k]]
            k = group[k]
        return k

    out = []
    for i in range(rows):
        for j in np.flatnonzero(similar[i]).tolist():
            a, b = root(i), root(rows + j)
            if a != b:
                group[a] = b
                out.append((i, j))
    return out


def cross_pairs(
    entries: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """All pairs of a list whose nodes are in different components yet.

    The first result has the pairs of short lists, to be estimated. A long list
    is dealt into blocks, every two blocks meet in one bounded group, all their
    pairs are compared on the full sets of hashes, and what leaves the group
    (the second result) are links that connect the same nodes, fewer than it
    has nodes.
    """
    rows = entries.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = (
        rows.groupBy("value")
        .agg(F.count("*").alias("length"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
        .where("c0 <> c1")
        .select("value", "length")
    )
    rows = written(rows.join(mixed, "value"), "mixed")
    short, long = rows.where(F.col("length") <= SHORT), rows.where(F.col("length") > SHORT)
    side = [
        short.select("value", *(F.col(c).alias(f"{s}{t}") for c, t in (("node", ""), ("n", "_n"), ("comp", "_comp"))))
        for s in "ab"
    ]
    pairs = (
        side[0]
        .join(side[1], "value")
        .where("a < b and a_comp <> b_comp")
        .where(_alike(percent))
        .select("a", "b", "a_n", "b_n")
        .distinct()
    )
    if long.isEmpty():
        return pairs, pairs.sparkSession.createDataFrame([], "a long, b long")
    blocks = F.ceil(F.col("length") / BLOCK).cast("int")
    dealt = (
        long.join(full_sets(long.select("node").distinct(), classes, docs, size, text_col), "node")
        .withColumn("mine", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("low", F.least("mine", "other"))
        .withColumn("high", F.greatest("mine", "other"))
        .select("value", "low", "high", "mine", "node", "comp", "hashes")
    )

    def compare(table: pa.Table) -> pa.Table:
        mine, low, high, node, comp = (
            table[c].to_numpy() for c in ("mine", "low", "high", "node", "comp")
        )
        hashes = [
            np.split(chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())[:-1])
            for chunk in table["hashes"].chunks
            if len(chunk)
        ]
        hashes = [each for chunk in hashes for each in chunk]
        first, second = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
        found = []
        if len(first) and len(second):
            similar = linked([hashes[i] for i in first], [hashes[i] for i in second], percent)
            similar &= comp[first][:, None] != comp[second][None, :]
            a, b = node[first], node[second]
            found = [(a[i], b[j]) for i, j in spanning(similar)]
        both = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": both.min(1), "b": both.max(1)})

    met = dealt.groupBy("value", "low", "high").applyInArrow(compare, "a long, b long").distinct()
    return pairs, met


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Rows whose sets of ``size``-word shingles have a Jaccard similarity of
    ``percent`` or more are linked. ``component_id`` is the smallest id that
    links reach; ``kept`` tells the row of that id. Rows of equal sets are one
    class, linked without pairs. Classes are first linked to hubs of their
    lists, twice, so that large groups are joined by few pairs; then every pair
    of one list that is not yet in one component is compared. Every link is
    confirmed on the full sets.

    A null, empty or blank text has no shingle and is linked with nothing; a
    text of fewer words is one shingle. A null id counts only where its group
    has no other; such a row is not kept. Rows that repeat an id are linked by
    their own texts; of equal ids all rows are kept. Other columns are left
    out; an empty table gives an empty result.
    """
    rows = written(sketches(docs, size, id_col, text_col), "sketches")
    classes = written(
        rows.where("n > 0")
        .groupBy("print")
        .agg(
            F.min("doc_id").alias("rep"),
            F.min("text_key").alias("text_key"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    entries = written(rare_entries(classes, percent), "entries")
    spark = docs.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "node long, comp long")
    member = F.struct("node", "n", "comp")
    for hub, shift in ((F.min(member), 0.0), (F.max(member), 0.5)):
        pairs = estimated(hub_pairs(entries, labels, hub, shift, percent), classes, percent)
        links = links.union(verified(pairs, classes, docs, size, percent, text_col))
        labels = written(connected(links), "labels")
    pairs, met = cross_pairs(entries, labels, classes, docs, size, percent, text_col)
    pairs = estimated(pairs, classes, percent).union(met).distinct()
    links = links.union(verified(pairs, classes, docs, size, percent, text_col))
    labels = connected(links)
    grouped = classes.select("print", "rep", "node").join(labels, "node", "left")
    grouped = grouped.withColumn("comp", F.coalesce("comp", "node"))
    least = grouped.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = grouped.join(least, "comp").select("print", "component_id")
    out = rows.select("doc_id", "n", "print").join(named, "print", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
