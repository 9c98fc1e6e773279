"""The (max, +) scan of a giant text for a model trained by merges.

Merging gives a text the pieces p1, p2, ... exactly if each of its neighbours
pi, pi+1, put together, are merged to these two again: the first merge across a
place between pieces would be the first one across it in the pair alone. So the
wanted segmentation is the only path whose neighbours all follow one another
that way, and what a text before a place does to the text behind it is known
from one piece.

Where a chunk ends, that piece is the boundary's state: how many of its
characters lie before the end and how many behind it. An end where no piece can
cross has the one state FRESH. A chunk's matrix holds, for each state before and
after it, the summed score of the pieces that begin in the chunk, as columns
(before, after, score); pairs without a path are left out, which stands for
minus infinity. Matrices combine associatively by (max, +). Between known states
each chunk is traced back by itself. Whole words inside a chunk do not depend on
its states and are encoded as those of short texts are.
"""

from __future__ import annotations

from array import array

import numpy as np

FRESH = 0
_NEVER = -(1 << 61)


def pack(matrix: np.ndarray) -> bytes:
    return np.ascontiguousarray(matrix, np.int64).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64).reshape(3, -1)


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The matrix of two neighbours, by (max, +) over the states between them."""
    right = right[:, np.argsort(right[0], kind="stable")]
    low = np.searchsorted(right[0], left[1], "left")
    count = np.searchsorted(right[0], left[1], "right") - low
    i = np.repeat(np.arange(left.shape[1]), count)
    j = np.arange(len(i)) + np.repeat(low - np.cumsum(count) + count, count)
    made = np.stack([left[0][i], right[1][j], left[2][i] + right[2][j]])
    made = made[:, np.lexsort((-made[2], made[1], made[0]))]
    best = np.ones(made.shape[1], bool)
    best[1:] = (made[:2, 1:] != made[:2, :-1]).any(0)
    return made[:, best]


def states(matrices: list[np.ndarray], before: int, after: int) -> list[int]:
    """The boundary states of the best path through neighbours, from the first to the last."""
    sums = [matrices[0]]
    for matrix in matrices[1:-1]:
        sums.append(combine(sums[-1], matrix))
    out = [after]
    for k in range(len(matrices) - 1, 0, -1):
        reached = {m: s for b, m, s in sums[k - 1].T.tolist() if b == before}
        open_ = [(reached[m] + s, m) for m, a, s in matrices[k].T.tolist() if a == out[-1] and m in reached]
        out.append(max(open_)[1])
    return [before, *out[::-1]]


class Chunk:
    """A chunk of ``size`` characters in ``text``, after ``lead`` of them.

    What stands before and behind the chunk is there as far as a piece can
    reach; a text's first chunk has nothing before it, its last nothing behind.
    """

    def __init__(self, words, text: str, lead: int, size: int):
        self.words, self.text, self.begin, self.end = words, text, lead, lead + size
        self.edges: dict = {}
        #: Where the first and the last whole word of the chunk begin and end; none: equal to None.
        self.first = self.last = None
        inner = [self.begin] if words.cut(text, self.begin) else []
        if not inner and (at := words.next_cut(text, self.begin)) < self.end:
            inner = [at]
        if inner:
            self.first = self.last = inner[0]
            for at in range(self.end, self.first, -1):
                if words.cut(text, at):
                    self.last = at
                    break

    @property
    def middle(self) -> str:
        return "" if self.first is None else self.text[self.first : self.last]

    def befores(self) -> list[int]:
        """Every state that the text allows where the chunk begins."""
        if self.words.cut(self.text, self.begin):
            return [FRESH]
        n, text, out = self.words.longest, self.text, []
        for a in range(1, min(n, self.begin) + 1):
            for e in range(n - a + 1):
                piece = text[self.begin - a : self.begin + e]
                if len(piece) == a + e and self.words.follows("", piece):
                    out.append(a * (n + 1) + e)
        return out

    def place(self, state: int, at: int) -> tuple[int, int]:
        """Where the piece of a state begins and ends."""
        if state == FRESH:
            return at, at
        a, e = divmod(state, self.words.longest + 1)
        return at - a, at + e

    def _onward(self, start: int, at: int) -> list[tuple[int, int]]:
        """Ends and scores of the pieces that may follow text[start:at]."""
        found = self.edges.get((start, at))
        if found is None:
            words, text = self.words, self.text
            previous, branch, found = text[start:at], words.tree, []
            for end, letter in enumerate(text[at : at + words.longest], at + 1):
                score, branch = branch.get(letter, (_NEVER, None))
                if score == _NEVER and end == at + 1:
                    score = words.unknown
                if score != _NEVER and words.follows(previous, text[at:end]):
                    found.append((end, score))
                if not branch:
                    break
            self.edges[start, at] = found
        return found

    def paths(self, start: int, at: int, stop: int) -> dict[int, tuple[int, int]]:
        """From the piece text[start:at] on: for each end that is reached, the last piece's begin and the sum.

        Pieces begin before stop; no end is reached by two paths.
        """
        out = {at: (start, 0)}
        for i in range(at, stop):
            if i in out:
                start, total = out[i]
                for end, score in self._onward(start, i):
                    out[end] = i, total + score
        return out

    def matrix(self, middle: int) -> np.ndarray:
        """The chunk's matrix; ``middle`` is the score of its whole words."""
        rows = []
        tail = None if self.first is None else self.paths(self.last, self.last, self.end)
        for before in self.befores():
            start, at = self.place(before, self.begin)
            if tail is None:
                rows += [(before, a, s) for a, s in self._afters(self.paths(start, at, self.end))]
                continue
            head = self.paths(start, at, self.first).get(self.first)
            if head is not None:
                rows += [(before, a, head[1] + middle + s) for a, s in self._afters(tail)]
        return np.array(rows, np.int64).reshape(-1, 3).T

    def _afters(self, paths: dict) -> list[tuple[int, int]]:
        if self.words.cut(self.text, self.end):
            return [(FRESH, paths[self.end][1])] if self.end in paths else []
        n = self.words.longest
        return [
            ((self.end - start) * (n + 1) + end - self.end, total)
            for end, (start, total) in paths.items()
            if start < self.end <= end
        ]

    def _between(self, start: int, at: int, end: int) -> bytes:
        paths, cuts = self.paths(start, at, min(end, self.end)), []
        while end > at:
            cuts.append((paths[end][0], end))
            end = paths[end][0]
        out = array("I")
        for piece in reversed(cuts):
            self.words.put(out, self.text[slice(*piece)])
        return out.tobytes()

    def ids(self, before: int, after: int, middle: bytes) -> bytes:
        """Ids of the pieces that begin in the chunk, between known states."""
        start, at = self.place(before, self.begin)
        _, end = self.place(after, self.end)
        if self.first is None:
            return self._between(start, at, end)
        return self._between(start, at, self.first) + middle + self._between(self.last, self.last, end)
