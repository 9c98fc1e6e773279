"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import re
import sys
import types
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa

from wardhouse.llm.common import give_back_memory

#: Parts whose ids a task keeps, and words of them; a fuller store is emptied and filled anew.
KEPT_PIECES = 500_000
#: Parts whose ids are put together at once.
GATHERED = 1 << 20

#: A word of Latin letters and the ASCII marks after it: two parts for the byte-level pattern.
_PLAIN = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)")


class Encoder:
    """Ids of a text, as little-endian unsigned 32-bit numbers.

    The file's pre-tokenizer (byte level, with its pattern) never joins a blank
    to what stands before it. So a text may be cut before any single blank that
    has other characters than white space on both sides, and the ids of the
    parts, put together, are those of the whole text; likewise at a single line
    break between words. Many texts are split and their parts numbered at once;
    each distinct part is encoded once, and the ids are gathered by its number.
    ``safe`` tells whether the file has that pre-tokenizer and no normalizer; any
    other file encodes whole texts.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        kind = parts.get("pre_tokenizer") or {}
        self.safe = (
            kind.get("type") == "ByteLevel"
            and kind.get("use_regex", True)
            and not kind.get("add_prefix_space")
            and not parts.get("normalizer")
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in parts.get("added_tokens", []))
        )
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t["content"] for t in parts.get("added_tokens", [])]
        self.words: dict[str, bytes] = {}
        self._forget()
        if self.safe:
            self._byte_letters = _byte_letters()

    def _ids(self, letters: str) -> bytes:
        """Ids of one part that the pre-tokenizer leaves whole, given in its letters."""
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if word.isascii() and word != "\n":
                letters = "\u0120" + word[1:] if word[0] == " " else word
            else:
                letters = word.encode().decode("latin-1").translate(self._byte_letters)
            found = self.words[word] = self._ids(letters)
        return found

    def _piece(self, piece: str) -> bytes:
        plain = _PLAIN.fullmatch(piece)
        if plain:
            word, marks = plain.groups()
            return self._word(word) + self._word(marks) if marks else self._word(word)
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)
        return b"".join([self._ids(letters) for letters, _ in parts])

    def _part(self, part: str) -> bytes:
        """Ids of what follows a blank, or of a line break and the word after it."""
        return self._word("\n") + self._piece(part[1:]) if part[0] == "\n" else self._piece(" " + part)

    def _forget(self) -> None:
        """Empty the stores: the number of each part, and for each number where its ids lie in
        ``flat``, how many they are, and whether the part may stand by itself."""
        self.words.clear()
        self.numbers: dict[str, int] = {}
        self.flat = np.empty(0, "<u4")
        self.starts, self.counts = np.empty(0, np.int32), np.empty(0, np.int32)
        self.single = np.empty(0, bool)

    def _numbered(self, parts: list[str]) -> np.ndarray:
        """The number of each of the distinct parts; new ones are encoded."""
        if len(self.numbers) > KEPT_PIECES or len(self.words) > KEPT_PIECES:
            self._forget()
        found = np.fromiter(map(self.numbers.get, parts, repeat(-1)), np.int32, len(parts))
        new = np.flatnonzero(found < 0).tolist()
        if new:
            found[new] = np.arange(len(self.starts), len(self.starts) + len(new))
            ids, single = [], []
            for k in new:
                part = parts[k]
                # What is stored has no further white space at its ends.
                alone = _bounded(part[1:] if part[:1] == "\n" else part)
                single.append(alone)
                ids.append(self._part(part) if alone else b"")
            self.numbers.update(zip([parts[k] for k in new], found[new].tolist(), strict=True))
            counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            starts = len(self.flat) + np.cumsum(counts) - counts
            # KEPT_PIECES parts and those of a slice of text: far below 2**31 ids.
            self.starts = np.append(self.starts, starts.astype(np.int32))
            self.counts = np.append(self.counts, counts.astype(np.int32))
            self.flat = np.append(self.flat, np.frombuffer(b"".join(ids), "<u4"))
            self.single = np.append(self.single, single)
        return found

    def encode_all(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, each text's followed by ``end_id`` if that is
        given, and how many ids each text has so. Texts are not null."""
        import pyarrow.compute as pc

        n = len(texts)
        whole = np.full(n, not self.safe)
        for special in self.special:
            whole |= np.asarray(pc.match_substring(texts, special))
        # A single line break between words is a part of its own, too.
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        offsets = np.asarray(lists.offsets, np.int64)
        coded = lists.flatten().dictionary_encode()
        codes = np.asarray(coded.indices)
        distinct = coded.dictionary.to_pylist()
        first, size = offsets[:-1], np.diff(offsets)
        firsts = [distinct[c] for c in codes[first].tolist()]
        numbers = self._numbered(distinct)[codes] if n else codes
        single = self.single[numbers]
        single[first] = [_bounded(p) for p in firsts]
        cut = (np.logical_and.reduceat(single, first) if n else whole) & ~whole
        starts, counts = self.starts[numbers], self.counts[numbers]
        del lists, coded, codes, distinct, numbers, single
        # The first part has no blank before it; other texts are encoded as one.
        heads = []
        for k, (head, parts, apart) in enumerate(zip(firsts, size.tolist(), cut.tolist(), strict=True)):
            if apart:
                heads.append(self._piece(head))
            elif parts == 1 and not whole[k]:
                heads.append(self._piece(head) if head else b"")
            else:
                heads.append(self.encode(texts[k].as_py()))
        held = np.fromiter(map(len, heads), np.int64, n) // 4
        flat = np.append(self.flat, np.frombuffer(b"".join(heads), "<u4"))
        counts[np.repeat(~cut, size)] = 0
        starts[first], counts[first] = len(self.flat) + np.cumsum(held) - held, held
        if end_id is not None:
            starts = np.insert(starts, offsets[1:], len(flat))
            counts = np.insert(counts, offsets[1:], 1)
            flat = np.append(flat, np.array([end_id], "<u4"))
            first, size = first + np.arange(n), size + 1
        ids = np.empty(int(counts.sum()), "<u4")
        at = 0
        for begin in range(0, len(counts), GATHERED):
            part = counts[begin : begin + GATHERED]
            total = int(part.sum())
            jump = np.repeat(starts[begin : begin + GATHERED] - (np.cumsum(part) - part), part)
            ids[at : at + total] = flat[jump + np.arange(total)]
            at += total
        return ids, np.add.reduceat(counts, first, dtype=np.int64) if n else np.empty(0, np.int64)

    def encode(self, text: str) -> bytes:
        if not self.safe or any(s in text for s in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return self._uneven(text)

    def _uneven(self, text: str) -> bytes:
        """For texts with other white space beside their blanks: cut only where it is allowed."""
        parts = text.split(" ")
        out, run = [], [parts[0]]
        for before, part in zip(parts, parts[1:]):
            if _bounded(part[:1]) and _bounded(before[-1:]):
                out.append(run)
                run = []
            run.append(part)
        out.append(run)
        ids = [self._piece(" ".join(out[0]))] if out[0] != [""] else []
        for run in out[1:]:
            ids.append(self._piece(" " + " ".join(run)))
        return b"".join(ids)


def _bounded(piece: str) -> bool:
    return bool(piece) and not piece[0].isspace() and not piece[-1].isspace() and "\u180e" not in piece


def _byte_letters() -> dict[int, int]:
    """The byte-level scheme's letter for each byte: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden)}


#: Where a worker keeps its encoder: a module of no file, so that it outlives the task.
_KEPT = "wardhouse_llm_kept"


def encoder(path: str) -> Encoder:
    """The encoder of a file; a Python worker keeps the last one for its next tasks."""
    kept = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT))
    if getattr(kept, "path", None) != path:
        kept.path, kept.encoder = path, Encoder(path)
    return kept.encoder


def forget_encoder() -> None:
    """Give back what :func:`encoder` keeps in this Python worker; for tasks that do not encode."""
    kept = sys.modules.pop(_KEPT, None)
    if kept is not None:
        vars(kept).clear()
        give_back_memory()


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public tokenizer's file lies; every machine has the same files."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
