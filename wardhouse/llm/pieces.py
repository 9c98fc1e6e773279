"""SentencePiece encoding and decoding of giant texts by a max-plus parallel scan.

A model trained by merges joins neighbours, the pair with the highest score (the
leftmost of equal ones) first, until no two make a piece. Nothing is joined across
the parts of a text, so texts are split there, many at once, and each distinct
part is encoded once. Giant texts are cut into chunks of one size, wherever that
cuts them, and put together by the scan of ``merge_scan``. The rest of this text
is about the scan for models whose scores are to be summed.

A text's best segmentation is the one with the highest sum of piece scores; of
equal sums the one whose last piece is longest, then the one before it, and so
on. Characters that no piece holds become their UTF-8 byte pieces.

A giant text is cut into chunks. Where a chunk ends, the piece that crosses the
end reaches some characters into the next chunk: that number, below the length
of the longest piece, is the boundary's state. A chunk's matrix holds, for each
state before and after, the score of the best path between them and its place in
the order of equal scores. Matrices combine associatively by (max, +), so groups
of chunks are combined level by level; going down again, each group's boundary
states fix those inside it, and at last every chunk is traced back by itself.
"""

from __future__ import annotations

import heapq
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardhouse.llm import merge_scan
from wardhouse.llm.common import append_columns, slices, without, written

SPACE = "▁"
#: Stands for U+2581 in a text itself; no text can hold half a surrogate pair.
_LITERAL = "\udc81"
#: Texts longer than this many characters are cut into chunks of CHUNK.
GIANT = 16_384
CHUNK = 8_192
#: Matrices that are combined in one step.
FAN = 64
#: Parts encoded one by one that a task keeps at most, and a quarter as many pairs of pieces; a
#: fuller store is emptied and filled anew.
KEPT = 200_000
#: Characters whose parts are numbered and merged at once.
AT_ONCE = 2_000_000
#: Bytes of chunks that a task is dealt, as long as that takes no more tasks than MOST_TASKS.
TASK_BYTES = 8_000_000
MOST_TASKS = 20_000
#: Up to so many chunks' states (about 80 bytes each) are broadcast to the chunks, more meet them in a shuffle.
FEW_CHUNKS = 2_000_000
_NONE = -(1 << 62)
_NEVER = -(1 << 61)


@dataclass
class Vocabulary:
    """Pieces with whole-number scores (scaled where the file has fractions)."""

    ids: dict[str, int]
    scores: dict[str, int]
    bytes_from: list[int]
    shown: list[bytes | None]
    longest: int
    unknown: int
    by_words: bool
    prefix: bool
    scale: int
    tree: dict
    kept: dict[str, tuple[int, bytes]] = field(default_factory=dict)
    kept_merged: dict[str, tuple[int, bytes]] = field(default_factory=dict)
    kept_pairs: dict[tuple[str, str], bool] = field(default_factory=dict)

    @cached_property
    def pairs(self) -> Pairs:
        return Pairs(self)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model file with byte pieces, whose normaliser changes nothing but blanks."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, raw, bytes_from, shown = {}, {}, [-1] * 256, []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                bytes_from[int(piece[3:-1], 16)] = k
                shown.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                shown.append(None)
            else:
                ids[piece], raw[piece] = k, model.get_score(k)
                shown.append(piece.replace(SPACE, " ").encode())
        if -1 in bytes_from:
            raise ValueError("the model has no byte pieces")
        if model.normalize("  a  bÅﬁ ").replace(SPACE, " ").lstrip() != "a  bÅﬁ ":
            raise ValueError("the model's normaliser is not supported")
        whole = all(float(s).is_integer() for s in raw.values())
        scale = 1 if whole else 1 << 16
        scores = {p: round(max(s, -1e9 if whole else -1e5) * scale) for p, s in raw.items()}
        longest = max(map(len, ids))
        by_words = not any(SPACE in p.lstrip(SPACE) for p in ids) and not any(
            "\n" in p and len(p) > 1 for p in ids
        )
        prefix = model.normalize("a").startswith(SPACE)
        # Character by character: what a piece that ends here scores, and how pieces go on.
        tree: dict = {}
        for piece in sorted(scores):
            branch = tree
            for letter in piece[:-1]:
                branch = branch.setdefault(letter, (_NEVER, {}))[1]
            branch[piece[-1]] = (scores[piece], branch.get(piece[-1], (0, {}))[1])
        unknown = min(scores.values()) - 10 * scale
        return cls(ids, scores, bytes_from, shown, longest, unknown, by_words, prefix, scale, tree)

    def prepared(self, text: str) -> str:
        """The text as it is segmented: blanks shown, one before the first character."""
        if not text:
            return ""
        text = text.replace(SPACE, _LITERAL).replace(" ", SPACE)
        return SPACE + text if self.prefix else text

    def forward(self, text: str, start: int, stop: int) -> tuple[list, list]:
        """Best scores of paths from start, and where their last pieces begin.

        Pieces begin before stop and may end behind it. Positions that no path
        reaches have score _NONE.
        """
        size = min(len(text), stop + self.longest - 1)
        score = [_NONE] * (size + 1)
        back = [0] * (size + 1)
        score[start] = 0
        tree, unknown, longest = self.tree, self.unknown, self.longest
        for i in range(start, stop):
            base = score[i]
            if base == _NONE:
                continue
            branch, j, single = tree, i, True
            for letter in text[i : i + longest]:
                found = branch.get(letter)
                if found is None:
                    break
                s, branch = found
                j += 1
                if s != _NEVER:
                    if j == i + 1:
                        single = False
                    s += base
                    if s > score[j]:
                        score[j], back[j] = s, i
            if single and base + unknown > score[i + 1]:
                score[i + 1], back[i + 1] = base + unknown, i
        return score, back

    def ids_between(self, text: str, back: list, start: int, end: int) -> list[int]:
        out: list[int] = []
        while end > start:
            begin = back[end]
            found = self.ids.get(text[begin:end])
            if found is None:
                raw = text[begin:end].replace(_LITERAL, SPACE).encode()
                out.extend(self.bytes_from[b] for b in reversed(raw))
            else:
                out.append(found)
            end = begin
        out.reverse()
        return out

    def best(self, text: str) -> tuple[int, bytes]:
        """Score and ids (little-endian unsigned 32-bit) of a text that no piece leaves."""
        found = self.kept.get(text)
        if found is None:
            score, back = self.forward(text, 0, len(text))
            found = score[-1], array("I", self.ids_between(text, back, 0, len(text))).tobytes()
            if len(text) <= 64:
                if len(self.kept) >= KEPT:
                    self.kept.clear()
                self.kept[text] = found
        return found

    def parts(self, text: str) -> list[str]:
        """The text cut where no piece can cross: before words, if the pieces allow it."""
        return _WORDS.findall(text) if self.by_words else [text]

    def encode(self, text: str) -> tuple[int, bytes]:
        """Score and ids of a prepared text."""
        found = [self.best(p) for p in self.parts(text)]
        return sum(s for s, _ in found), b"".join([i for _, i in found])

    def merged(self, text: str) -> tuple[int, bytes]:
        """Summed scores and ids of a part whose neighbours are joined, best pair first."""
        found = self.kept_merged.get(text)
        if found is None:
            score, out = 0, array("I")
            for piece in self._joined(text):
                self.put(out, piece)
                score += self.scores.get(piece, self.unknown)
            found = score, out.tobytes()
            if len(text) <= 64:
                if len(self.kept_merged) >= KEPT:
                    self.kept_merged.clear()
                self.kept_merged[text] = found
        return found

    def _joined(self, text: str) -> list[str]:
        n, scores = len(text), self.scores
        piece: list[str] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(-scores[p], i, p) for i in range(n - 1) if (p := text[i : i + 2]) in scores]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            # Pairs of which one side has been joined to something else since are no more.
            if j >= n or not piece[i] or piece[i] + piece[j] != both:
                continue
            piece[i], piece[j] = both, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := both + piece[k]) in scores:
                    heapq.heappush(heap, (-scores[p], i, p))
            if (k := before[i]) >= 0 and (p := piece[k] + both) in scores:
                heapq.heappush(heap, (-scores[p], k, p))
        return [p for p in piece if p]

    def put(self, out: array, piece: str) -> None:
        """Append the id of a piece, or those of the bytes of a character that no piece holds."""
        k = self.ids.get(piece)
        if k is None:
            out.extend(self.bytes_from[b] for b in piece.replace(_LITERAL, SPACE).encode())
        else:
            out.append(k)

    def follows(self, left: str, right: str) -> bool:
        """Whether the two, put together, are merged to just these pieces."""
        found = self.kept_pairs.get((left, right))
        if found is None:
            if len(self.kept_pairs) >= KEPT // 4:
                self.kept_pairs.clear()
            found = self._joined(left + right) == ([left, right] if left else [right])
            self.kept_pairs[left, right] = found
        return found

    def cut(self, text: str, at: int) -> bool:
        """Whether no piece can cross this place: a text's ends and those of its parts."""
        if at <= 0 or at >= len(text):
            return True
        before, after = text[at - 1], text[at]
        return self.by_words and ("\n" in (before, after) or (after == SPACE and before != SPACE))

    def next_cut(self, text: str, at: int) -> int:
        return _WORDS.match(text, at).end() if self.by_words else len(text)

    def merge_all(self, texts: Iterable[str]) -> tuple[pa.Array, np.ndarray]:
        """``encode_merged`` of many prepared texts: parts are numbered, each distinct one is encoded once."""
        ids, scores, some, size = [], [], [], 0
        for text in texts:
            if some and size + len(text) > AT_ONCE:
                found = self._merge_some(some)
                ids.append(found[0])
                scores.append(found[1])
                some, size = [], 0
            some.append(text)
            size += len(text)
        found = self._merge_some(some)
        return pa.concat_arrays([*ids, found[0]]), np.concatenate([*scores, found[1]])

    def _merge_some(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        import pyarrow.compute as pc

        if not self.by_words or any(_LITERAL in t or "\0" in t for t in texts):
            found = [self.encode_merged(t) for t in texts]
            return pa.array([i for _, i in found], pa.binary()), np.array([s for s, _ in found], np.int64)
        marked = pc.replace_substring(pa.array(texts, pa.string()), SPACE, "\0" + SPACE)
        marked = pc.replace_substring(marked, "\n", "\0\n\0")
        if pc.any(pc.match_substring(marked, SPACE + "\0" + SPACE)).as_py():
            for _ in range(2):  # matches do not overlap: the second pass finds what is between
                marked = pc.replace_substring(marked, SPACE + "\0" + SPACE, SPACE * 2)
        parts = pc.split_pattern(marked, "\0")
        coded = parts.flatten().dictionary_encode()
        totals, merged = self.pairs.merged(coded.dictionary)
        numbers, offsets = coded.indices, parts.offsets
        ids = merged.take(numbers)
        sums = np.append(0, np.cumsum(totals[numbers.to_numpy()]))
        ends = offsets.to_numpy()
        return pc.binary_join(pa.ListArray.from_arrays(offsets, ids), b""), sums[ends[1:]] - sums[ends[:-1]]

    def encode_merged(self, text: str) -> tuple[int, bytes]:
        """Score and ids of a prepared text, as a model trained by merges has them."""
        found = [self.merged(p) for p in self.parts(text)]
        return sum(s for s, _ in found), b"".join([i for _, i in found])

    def decode(self, ids: bytes) -> str:
        shown = self.shown
        text = b"".join([shown[k] or b"" for k in array("I", ids)]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text

    def decode_all(self, ids: pa.Array) -> pa.Array:
        """``decode`` of many id strings; null stays null."""
        import pyarrow.compute as pc

        given = pc.fill_null(ids.cast(pa.binary()), b"")
        ends = np.append(0, np.cumsum(pc.binary_length(given).to_numpy(zero_copy_only=False) // 4))
        flat = np.frombuffer(b"".join(given.to_pylist()), "<u4")
        pieces = pa.array([p or b"" for p in self.shown], pa.binary()).take(pa.array(flat))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces), b"")
        try:
            texts = texts.cast(pa.string())
        except pa.ArrowInvalid:
            texts = pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())
        if self.prefix:
            texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
        return pc.if_else(pc.is_null(ids), pa.scalar(None, pa.string()), texts)

    def cuts(self, text: str, size: int) -> list[int]:
        """Ends of the parts that lie inside a chunk (the first ``size`` characters)."""
        out, at = [], 0
        for part in self.parts(text):
            at += len(part)
            if at >= size:
                break
            out.append(at)
        return out


class Pairs:
    """Merges of many parts at once.

    Symbols are numbers: a piece's id, or, from ``known`` on, a character that no
    piece holds. Parts of one length are the rows of a matrix. In a step each row
    joins its best pair, the leftmost of equal ones, so that all rows stay equally
    long; a row without a pair is done.
    """

    def __init__(self, words: Vocabulary):
        self.words = words
        self.known = max(words.ids.values()) + 1
        self.span = self.known + sys.maxunicode + 1
        self.of_character = np.arange(sys.maxunicode + 1) + self.known
        self.scores = np.full(self.span, words.unknown, np.int64)
        for piece, k in words.ids.items():
            self.scores[k] = words.scores[piece]
            if len(piece) == 1:
                self.of_character[ord(piece)] = k
        made = {}
        for piece, k in words.ids.items():
            for i in range(1, len(piece)):
                left, right = self._symbol(piece[:i]), self._symbol(piece[i:])
                if left is not None and right is not None:
                    made[left * self.span + right] = k
        self.keys = np.array(sorted(made), np.int64)
        self.joined = np.array([made[k] for k in self.keys.tolist()], np.int64)

    def _symbol(self, text: str) -> int | None:
        return int(self.of_character[ord(text)]) if len(text) == 1 else self.words.ids.get(text)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of pairs (_NONE: they make no piece) and the pieces they make."""
        wanted = left * self.span + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        piece = self.joined[at]
        return np.where(self.keys[at] == wanted, self.scores[piece], _NONE), piece

    def merged(self, parts: pa.StringArray) -> tuple[np.ndarray, pa.BinaryArray]:
        """Summed scores and ids of parts, by their places."""
        import pyarrow.compute as pc

        lengths = np.array(pc.utf8_length(parts))
        sums, counts = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        done = []
        for n in np.unique(lengths[(lengths > 0) & (lengths <= 64)]).tolist():
            row = np.flatnonzero(lengths == n)
            letters = "".join(parts.take(pa.array(row)).to_pylist()).encode("utf-32-le")
            for rows, symbols in self._steps(row, self.of_character[np.frombuffer(letters, "<u4").reshape(-1, n)]):
                sums[rows], counts[rows] = self.scores[symbols].sum(1), symbols.shape[1]
                whole = (symbols < self.known).all(1)
                done.append((rows[whole], symbols[whole]))
                lengths[rows[~whole]] = 65
        # Long parts are merged by themselves; so are those with a character that no piece holds, which becomes bytes.
        for k in np.flatnonzero(lengths > 64).tolist():
            sums[k], raw = self.words.merged(parts[k].as_py())
            counts[k] = len(raw) // 4
            done.append((np.array([k]), np.frombuffer(raw, "<u4").reshape(1, -1)))
        starts = np.append(0, np.cumsum(counts))
        ids = np.empty(starts[-1], "<u4")
        for rows, symbols in done:
            ids[starts[rows][:, None] + np.arange(symbols.shape[1])] = symbols
        buffers = [None, pa.py_buffer((starts * 4).astype(np.int32)), pa.py_buffer(ids)]
        return sums, pa.BinaryArray.from_buffers(pa.binary(), len(parts), buffers)

    def _steps(self, row: np.ndarray, symbol: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, their symbols) that are done, step by step."""
        score, piece = self._look(symbol[:, :-1], symbol[:, 1:])
        while (n := symbol.shape[1]) > 1:
            best = score.argmax(1)
            open_ = score[np.arange(len(row)), best] != _NONE
            yield row[~open_], symbol[~open_]
            if not open_.any():
                return
            row, symbol, score, piece, best = (x[open_] for x in (row, symbol, score, piece, best))
            each = np.arange(len(row))
            symbol[each, best] = piece[each, best]
            symbol = symbol[np.arange(n) != best[:, None] + 1].reshape(len(row), n - 1)
            stay = np.arange(n - 1) != best[:, None]
            score, piece = (x[stay].reshape(len(row), n - 2) for x in (score, piece))
            for place in (best - 1, best):
                near = np.flatnonzero((place >= 0) & (place < n - 2))
                at = place[near]
                score[near, at], piece[near, at] = self._look(symbol[near, at], symbol[near, at + 1])
        yield row, symbol


_WORDS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file; a Python worker keeps the last one for its next tasks."""
    kept = sys.modules.setdefault("wardhouse_llm_pieces", types.ModuleType("wardhouse_llm_pieces"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.words = path, Vocabulary.load(path)
    return kept.words


def _order(paths: list[tuple]) -> list[int]:
    """Places of paths, given as their piece lengths from the end, longest last pieces first."""
    ranked = sorted(range(len(paths)), key=lambda k: tuple(-n for n in paths[k]))
    out = [0] * len(paths)
    for place, k in enumerate(ranked):
        out[k] = place
    return out


def _lengths(back: list, start: int, end: int) -> tuple:
    out = []
    while end > start:
        out.append(end - back[end])
        end = back[end]
    return tuple(out)


def chunk_matrix(words: Vocabulary, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and places of the best paths through a chunk, for each state before and after.

    ``text`` is the chunk, ``size`` characters, and what follows it as far as a
    piece can reach.
    """
    n = words.longest
    scores = np.full((n, n), _NONE, np.int64)
    places = np.zeros((n, n), np.int64)
    cuts = words.cuts(text, size)
    if cuts:
        first, last = cuts[0], cuts[-1]
        middle = sum(words.best(p)[0] for p in words.parts(text[first:last])) if last > first else 0
        starts = list(range(min(first, n - 1) + 1))
        runs = [words.forward(text[:first], s, first) for s in starts]
        order = _order([_lengths(back, s, first) for s, (_, back) in zip(starts, runs, strict=True)])
        tail, _ = words.forward(text[last:], 0, size - last)
        for s, (score, _) in zip(starts, runs, strict=True):
            if score[first] == _NONE:
                continue
            for e in range(min(n, len(tail) - (size - last))):
                if tail[size - last + e] != _NONE:
                    scores[s, e] = score[first] + middle + tail[size - last + e]
                    places[s, e] = order[s]
        return scores, places
    runs = [words.forward(text, s, size) for s in range(min(n, size))]
    for e in range(min(n, len(runs[0][0]) - size)):
        open_ = [s for s, (score, _) in enumerate(runs) if size + e < len(score) and score[size + e] != _NONE]
        order = _order([_lengths(runs[s][1], s, size + e) for s in open_])
        for s, place in zip(open_, order, strict=True):
            scores[s, e] = runs[s][0][size + e]
            places[s, e] = place
    return scores, places


def chunk_ids(words: Vocabulary, text: str, size: int, before: int, after: int) -> list[bytes]:
    """Ids of a chunk's pieces, between known states."""
    cuts = words.cuts(text, size)
    end = size + after
    if not cuts:
        _, back = words.forward(text[:end], before, size)
        return [array("I", words.ids_between(text, back, before, end)).tobytes()]
    first, last = cuts[0], cuts[-1]
    _, back = words.forward(text[:first], before, first)
    out = [array("I", words.ids_between(text, back, before, first)).tobytes()]
    if last > first:
        out += [words.best(p)[1] for p in words.parts(text[first:last])]
    tail = text[last:end]
    _, back = words.forward(tail, 0, size - last)
    out.append(array("I", words.ids_between(tail, back, 0, len(tail))).tobytes())
    return out


def combine(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The matrix of two neighbours: associative; equal sums are decided by the later part first."""
    n = len(left[0])
    total = left[0][:, :, None] + right[0][None, :, :]
    total[(left[0] == _NONE)[:, :, None] | (right[0] == _NONE)[None, :, :]] = _NONE
    scores = total.max(1)
    later = np.where(total == scores[:, None, :], right[1][None, :, :], n * n)
    middle = later.argmin(1)
    before = np.take_along_axis(left[1], middle, 1)
    key = np.take_along_axis(right[1], middle, 0) * (n + 1) + before
    places = np.argsort(np.argsort(key, axis=0, kind="stable"), axis=0, kind="stable")
    return scores, places


def states(matrices: list[tuple[np.ndarray, np.ndarray]], before: int, after: int) -> list[int]:
    """The boundary states of the best path through neighbours, from the first to the last."""
    sums = [matrices[0]]
    for matrix in matrices[1:-1]:
        sums.append(combine(sums[-1], matrix))
    out = [after]
    for k in range(len(matrices) - 1, 0, -1):
        left, right = sums[k - 1], matrices[k]
        open_ = [
            m for m in range(len(left[0])) if left[0][before, m] != _NONE and right[0][m, out[-1]] != _NONE
        ]
        out.append(
            max(open_, key=lambda m: (left[0][before, m] + right[0][m, out[-1]], -right[1][m, out[-1]]))
        )
    out.append(before)
    return out[::-1]


def _pack(matrix: tuple[np.ndarray, np.ndarray]) -> bytes:
    return np.stack(matrix).tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(raw, np.int64)
    n = int(np.sqrt(len(both) // 2))
    return tuple(both.reshape(2, n, n))


def _scan(chunks: DataFrame, most: int, merges: bool, total: int) -> DataFrame:
    """(row, chunk, before, after, score) of each of ``total`` chunks (row, chunk, matrix): its boundary
    states, and its share of the best path's sum."""
    pack, unpack, join, through, worth = (
        (merge_scan.pack, merge_scan.unpack, merge_scan.combine, merge_scan.states, _score)
        if merges
        else (_pack, _unpack, combine, states, lambda matrix, before, after: int(matrix[0][before, after]))
    )
    levels = [chunks.select("row", F.col("chunk").alias("at"), "matrix")]
    # Small tables that take long: AQE would put them into one task.
    tasks = [min(total // (8 * FAN) + 1, MOST_TASKS)]
    while most > 1 or len(levels) == 1:
        def up(frame):
            import pandas as pd

            frame = frame.sort_values("at")
            total = None
            for raw in frame["matrix"]:
                total = unpack(raw) if total is None else join(total, unpack(raw))
            return pd.DataFrame({"row": [frame["row"].iloc[0]], "at": [frame["at"].iloc[0] // FAN], "matrix": [pack(total)]})

        grouped = levels[-1].withColumn("group", F.expr(f"at div {FAN}"))
        grouped = grouped.repartition(tasks[-1], "row", "group").groupBy("row", "group")
        tasks.append(tasks[-1] // FAN + 1)
        levels.append(written(grouped.applyInPandas(up, "row long, at long, matrix binary"), "matrices"))
        most = -(-most // FAN)
    known = levels[-1].select("row", "at", F.lit(0).alias("before"), F.lit(0).alias("after"))
    for level, many in zip(levels[-2::-1], tasks[-2::-1], strict=True):

        def down(frame):
            import pandas as pd

            frame = frame.sort_values("at")
            matrices = [unpack(r) for r in frame["matrix"]]
            found = through(matrices, frame["before"].iloc[0], frame["after"].iloc[0])
            score = [worth(m, *e) for m, e in zip(matrices, zip(found, found[1:], strict=False), strict=True)]
            return pd.DataFrame({"row": frame["row"], "at": frame["at"], "before": found[:-1], "after": found[1:], "score": score})

        inner = level.withColumn("group", F.expr(f"at div {FAN}"))
        inner = inner.join(known.select("row", F.col("at").alias("group"), "before", "after"), ["row", "group"])
        inner = inner.repartition(many, "row", "group").groupBy("row", "group")
        known = inner.applyInPandas(down, "row long, at long, before int, after int, score long")
    return known.withColumnRenamed("at", "chunk")


def encode(
    docs: DataFrame, model: str, text_col: str = "text", giant: int = GIANT, chunk: int = CHUNK, merges: bool = False
) -> DataFrame:
    """Adds ids (little-endian unsigned 32-bit numbers) and score (scaled sum) of every whole text.

    With ``merges`` the ids are those of a model trained by merges (``merge_scan``),
    otherwise those of the highest sum. Texts up to ``giant`` characters are encoded where
    they are; longer ones are cut into chunks that are spread over the tasks (see
    the module). A null or empty text has no ids and score 0. Columns named ids
    or score are replaced; repeated rows are encoded each by itself; an empty
    table gives an empty result.
    """
    text = F.col(f"`{text_col}`")
    fields = [T.StructField("ids", T.BinaryType()), T.StructField("score", T.LongType())]
    docs = without(docs, ["ids", "score"])
    long = F.coalesce(F.length(text) > giant, F.lit(False))

    def make():
        words = vocabulary(model)

        def compute(texts: list) -> list:
            ready = (words.prepared(t or "") for t in texts)
            if merges:
                return list(words.merge_all(ready))
            found = [words.encode(t) for t in ready]
            return [[i for _, i in found], [s for s, _ in found]]

        return compute

    small = append_columns(docs.where(~long), text_col, fields, make)
    giants = written(docs.where(long).withColumn("__row", F.monotonically_increasing_id()), "giants")
    most, total = giants.agg(F.max(F.length(text)), F.sum(F.octet_length(text))).first()
    if most is None:
        return small
    chunk = max(chunk, vocabulary(model).longest)
    tasks = min(-(-total // TASK_BYTES), MOST_TASKS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in slices(batches, "t"):
            rows = []
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ready = words.prepared(raw)
                count = max(len(ready) // chunk, 1)
                for k in range(count):
                    size = chunk if k < count - 1 else len(ready) - k * chunk
                    lead = min(words.longest, k * chunk) if merges else 0
                    part = ready[k * chunk - lead : k * chunk + size + words.longest - 1]
                    rows.append((row, k, lead, size, part.encode("utf-8", "surrogatepass")))
            kinds = [pa.int64()] * 4 + [pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "chunk", "lead", "size", "part"])

    pieces = written(
        giants.select(F.col("__row").alias("row"), text.alias("t"))
        .mapInArrow(cut, "row long, chunk long, lead long, size long, part binary")
        .repartition(tasks, "row", "chunk"),
        "chunks",
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        words = vocabulary(model)
        for batch in slices(batches, "part", AT_ONCE):
            if merges:
                chunks, _, totals = _chunks(words, batch)
                made = [merge_scan.pack(c.matrix(t)) for c, t in zip(chunks, totals.tolist(), strict=True)]
            else:
                made = [_pack(chunk_matrix(words, p, s)) for _, s, p in _texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], ["row", "chunk", "matrix"])

    matrices = written(pieces.mapInArrow(measure, "row long, chunk long, matrix binary"), "matrices")
    count = matrices.count()
    known = _scan(matrices, most // chunk + 1, merges, count)
    found = pieces.join(F.broadcast(known) if count <= FEW_CHUNKS else known, ["row", "chunk"])
    found = found.select("row", "chunk", "lead", "size", "part", "score", "before", "after")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        words = vocabulary(model)
        for batch in slices(batches, "part", AT_ONCE):
            ends = list(zip(batch.column(6).to_pylist(), batch.column(7).to_pylist(), strict=True))
            if merges:
                chunks, middles, _ = _chunks(words, batch)
                ids = [c.ids(*e, m) for c, e, m in zip(chunks, ends, middles.to_pylist(), strict=True)]
            else:
                ids = [b"".join(chunk_ids(words, p, s, *e)) for (_, s, p), e in zip(_texts(batch), ends, strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), batch.column(5)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "chunk", "ids", "score"])

    traced = found.mapInArrow(trace, "row long, chunk long, ids binary, score long")
    return small.unionByName(_gathered(giants, traced))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, str]]:
    """(lead, size, text) of the chunks of a batch."""
    for lead, size, part in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
        yield lead, size, part.decode("utf-8", "surrogatepass")


def _chunks(words: Vocabulary, batch: pa.RecordBatch) -> tuple[list[merge_scan.Chunk], pa.Array, np.ndarray]:
    """The chunks of a batch, with ids and scores of their whole words."""
    chunks = [merge_scan.Chunk(words, p, lead, size) for lead, size, p in _texts(batch)]
    return chunks, *words.merge_all([c.middle for c in chunks])


def _score(matrix: np.ndarray, before: int, after: int) -> int:
    return int(matrix[2][(matrix[0] == before) & (matrix[1] == after)][0])


def _gathered(giants: DataFrame, traced: DataFrame) -> DataFrame:
    """The giant texts with the ids and scores of their chunks put together."""
    whole = traced.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"), F.sum("score").alias("score")
    )
    joined = F.aggregate("parts.ids", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x))
    whole = whole.select(F.col("row").alias("__row"), joined.alias("ids"), "score")
    return giants.join(whole, "__row").drop("__row")


def decode(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Adds the text that the ids stand for (a column of that name is replaced); null ids give null."""
    kept = without(rows, [text_col])
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, ids_col, AT_ONCE):
            texts = words.decode_all(batch.column(batch.schema.get_field_index(ids_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*names, text_col])

    return kept.mapInArrow(run, schema)
