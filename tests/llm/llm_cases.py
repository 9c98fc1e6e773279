"""Texts and helpers of these tests."""

import zlib

GOOD = "the river runs past quiet houses and the people walk along its banks in the evening light"
BAD = "BUY!! NOW!! CHEAP### deal$$$ click%%% here&&& win*** cash### fast!! only!! today%%%"
RUDE = "you stupid moron this scum is pathetic"


def fold_of(doc_id):
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def mixed(n, seed=0):
    """Words of a small invented language, different for each number."""
    parts = "al be cor dun el far gil hom in jur kel lom mor nan or pel".split()
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(parts[x >> 8 & 15] + parts[x >> 13 & 15])
    return " ".join(out)


def odd_rows(rows):
    """Pairs of equal rows: an id that is there twice with one text."""
    twice = [r for r in rows if r.doc_id == 1003]
    assert len(twice) == 2
    return [tuple(twice)]
