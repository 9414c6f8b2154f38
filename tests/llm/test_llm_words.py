import re

import numpy as np

from transferlake.llm import words

TEXTS = ["The quick brown Fox, jumps over; the lazy-dog", None, "", "one two", "a b c d e", "ÉCOLE été 東京 x_1", " ".join("ab" * (i % 9 + 1) for i in range(500))]


def brute(text, width=5):
    w = re.findall(r"[0-9a-z_\x80-\U0010FFFF]+", (text or "").lower())
    return [tuple(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [tuple(w)] * bool(w)


def test_shingles_match_brute_force_and_are_the_same_in_any_batch():
    hashes, owner = words.shingle_table(TEXTS)
    seen = {}
    for i, t in enumerate(TEXTS):
        own, want = hashes[owner == i].tolist(), brute(t)
        assert len(own) == len(want)
        alone = words.shingle_table([t])[0].tolist()
        assert own == alone
        for s, h in zip(want, own):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_texts_longer_than_a_piece(monkeypatch):
    text = " ".join(f"w{i % 211}" for i in range(3000))
    whole = words.shingle_table([text, "x y"])[0]
    monkeypatch.setattr(words, "PIECE", 256)
    monkeypatch.setattr(words, "_TABLES", {})
    assert np.array_equal(words.shingle_table([text, "x y"])[0], whole)


def test_batches_cover_every_text_once():
    assert [i for a, b in words.batches(["x" * 10] * 7, 25) for i in range(a, b)] == list(range(7))
    assert list(words.batches([])) == []
