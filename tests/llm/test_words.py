import re

import pytest

from quadrille.llm import words
from quadrille.llm.words import NOT_ALNUM, WHITE, shingles, words_of

TEXTS = ["", None, "a", " One\ttwo\u00a0three\x0bone  TWO ", "É é ÉCOLE école", "x" * 50, "a b c d e f g a b c", "\x00 \x1c nul"]


def plain(text, pattern):
    # lower case first: A-Z are among the separators of the second pattern
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("sep,pattern", [(WHITE, r"[^\x20\x09-\x0D]+"), (NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
@pytest.mark.parametrize("piece", [1 << 20, 16])
def test_hashes_stand_for_words(monkeypatch, sep, pattern, piece):
    monkeypatch.setattr(words, "PIECE", piece)
    known = {}
    got = []
    for a, b, bounds, h in words_of([None if t is None else t.encode() for t in TEXTS], sep):
        got += [h[bounds[i] : bounds[i + 1]].tolist() for i in range(b - a)]
    assert len(got) == len(TEXTS)
    for t, hashes in zip(TEXTS, got):
        want = plain(t, pattern)
        assert len(want) == len(hashes)
        for w, x in zip(want, hashes):
            assert known.setdefault(w, x) == x
    assert len(set(known.values())) == len(known)


def test_shingles():
    (part,) = list(words_of([b"a b c d", b"a b", b"", b"a b c a b c"], WHITE))
    _, _, bounds, h = part
    sets = [set(s.tolist()) for s in shingles(h, bounds, 3)]
    assert [len(s) for s in sets] == [2, 1, 0, 3]
    assert len(sets[0] & sets[3]) == 1 and not sets[1] & sets[0]
