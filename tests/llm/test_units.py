"""The parts that run inside tasks, against plain versions."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from spendecho.llm import decontaminate, golay, langid, licenses, ranking, simhash, substring, tokens

TEXTS = ["One two  three", None, "", " \n", "élan x y", "a\x1cb c", "last"]


def test_words_of_slices():
    found = [[] for _ in TEXTS]
    for first, data, offsets in tokens.slices(pa.array(TEXTS), size=8):
        starts, ends, docs = tokens.spans(data, offsets, tokens.NOT_SPACE)
        for a, b, d in zip(starts, ends, docs):
            found[first + d].append(data[a:b].tobytes())
    assert found == [(t or "").encode().split() for t in TEXTS]


def test_hashes_depend_on_the_word_only():
    words = [b"same", b"other", b"same", b"x", b"emas"]
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    starts, ends, _ = tokens.spans(data, np.array([0, len(data)]), tokens.NOT_SPACE)
    h = tokens.hashes(data, starts, ends).tolist()
    assert h[0] == h[2] and len(set(h)) == 4


def test_lookup():
    draw = np.random.default_rng(4)
    keys = np.unique(draw.integers(-(1 << 62), 1 << 62, 5000))
    known = dict(zip(keys[::2].tolist(), range(len(keys))))
    table = tokens.Lookup(keys[::2], np.arange(len(keys[::2]), dtype=float))
    hit, value = table(keys)
    assert hit.tolist() == [k in known for k in keys.tolist()]
    assert value.tolist() == [known.get(k, 0) for k in keys.tolist()]
    hit, _ = tokens.Lookup(np.zeros(0, np.int64), np.zeros(0))(keys)
    assert not hit.any()


def test_golay_code():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 1 << 23, 200)
    index = golay.decode(words)
    codewords = (index << 11) | 0
    codewords = codewords | golay._LOW[codewords & 0xFFF] ^ golay._HIGH[codewords >> 12]
    assert (np.bitwise_count(words ^ codewords) <= 3).all()
    for a, b in itertools.combinations(range(23), 2):
        other = words ^ (1 << a) ^ (1 << b)
        x, y = golay.nearby(words[:20]), golay.nearby(other[:20])
        assert all(set(p[p >= 0]) & set(q[q >= 0]) for p, q in zip(x, y))
    assert max((row >= 0).sum() for row in golay.nearby(words)) == 6


def test_fingerprint():
    text = "The quick brown fox jumps over THE lazy dog"
    words = text.lower().split()
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    assert simhash.fingerprint(text, 3) % (1 << 64) == bits
    assert simhash.fingerprint(None, 3) == simhash.fingerprint(" ", 3) == 0
    assert simhash.fingerprint("Two words", 3) % (1 << 64) == xxhash.xxh64_intdigest("two words", 42)


def test_automaton_finds_what_is_there():
    draw = random.Random(2)
    texts = [[draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(1, 60))] for _ in range(30)]
    automaton = substring.Automaton()
    for owner, words in enumerate(texts[:20]):
        automaton.add(words, owner)
    automaton.finish()
    for order, words in enumerate(texts):
        expected = [
            i for i in range(len(words) - 4)
            if any(words[i : i + 5] == t[j : j + 5] for t in texts[: min(order, 20)] for j in range(len(t) - 4))
        ]
        assert automaton.shared(words, order, 5) == expected
    assert automaton.shared([b"z"] * 9 + texts[0], 99, len(texts[0])) == [9]


def test_scan_maps_back_to_the_text():
    windows = decontaminate.Windows([("7", "Ein, zwei DREI"), ("8", "zwei drei vier"), ("9", "!!")], 3)
    text = "é Ein (zwei) drei\nvier, eins"
    ranges, items = windows.scan(decontaminate.normalised(text))
    assert ranges == [(1, 3), (2, 4)] and items == {"7", "8"}
    (a, b), = decontaminate.characters(text, decontaminate.merged(ranges))
    assert text[a:b] == "Ein (zwei) drei\nvier"
    assert decontaminate.Windows([], 3).scan([b"x"]) == windows.scan([]) == ([], set())


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(["▁", "▁a", "a", "b", "ab", "▁ab", "bc"])
    table = np.array([[0.1, 0.2]] * 7 + [[0.001, 0.002]])

    def total(word, column):
        if not word:
            return 1.0
        names = ["▁", "▁a", "a", "b", "ab", "▁ab", "bc"]
        return sum(
            (table[0, column] if word[:n] in names else table[-1, column] if n == 1 else 0.0) * total(word[n:], column)
            for n in range(1, len(word) + 1)
        )

    words = ["ab", "abc", "zz", "a"]
    got = langid.log_likelihood(pieces, table, words)
    for word, row in zip(words, got):
        assert row == pytest.approx([math.log(total("▁" + word, c)) for c in (0, 1)])


def test_expected_counts_add_up():
    pieces = langid.Pieces(["▁", "▁a", "a", "b", "ab", "▁ab"])
    counts = langid.expected_counts(pieces, ["ab", "q"], np.array([3.0, 2.0]))
    lengths = np.array([1, 2, 1, 1, 2, 3, 1])
    assert (counts * lengths).sum() == pytest.approx(3 * 3 + 2 * 2)


def test_long_words_are_scored_like_short_ones(monkeypatch):
    """By logarithms and in blocks, with few columns held: the same as many at once."""
    vocab = ["▁", "▁a", "a", "b", "ab", "▁ab", "bba", "abab", "cc"]
    pieces, draw = langid.Pieces(vocab), np.random.default_rng(4)
    table = draw.random((len(vocab) + 1, 3)) / 20
    words = ["".join(draw.choice(list("abcd"), size=n)) for n in (1, 2, 3, 7, 20, 40, 61, 62)]
    times = draw.random(len(words)) * 5
    short = langid.log_likelihood(pieces, table, words), langid.expected_counts(pieces, words, times)
    for block in (1 << 16, 5, 1):
        monkeypatch.setattr(langid, "LONG", 0)
        monkeypatch.setattr(langid, "BLOCK", block)
        assert langid.log_likelihood(pieces, table, words) == pytest.approx(short[0], rel=1e-12)
        assert langid.expected_counts(pieces, words, times) == pytest.approx(short[1], rel=1e-9)
    (row,) = langid.log_likelihood(pieces, table, ["ab" * 3000])
    assert np.isfinite(row).all() and (row < -1000).all()  # far below what a double holds


def test_letters():
    assert langid.letters("Über 12 e² \n x_y") == ["über", "e", "x", "y"]
    assert list(map(len, langid.letters("q" * 70 + "7" + "w" * 5))) == [70, 5]
    assert langid.letters(None) == langid.letters("1 !") == []


def test_license_index():
    index = licenses.Index(1000, {b"the": 900, b"license": 20, b"under": 500, b"apache": 3})
    text = "code, Licensed under the Apache License, Version 2.0. And more"
    assert [(m[0], m[1]) for m in index.scan(decontaminate.normalised(text))] == [("apache-2.0", 1)]
    assert index.scan(decontaminate.normalised("an apache under the license of nobody")) == []
    assert index.scan([]) == []
    assert licenses.places(b"cc by cc by all rights reserved".split()) == [(0, "cc-by"), (2, "cc-by"), (4, "reserved")]


def test_license_index_finds_every_notice():
    """Two to four notices in one text, rare and frequent words: all of their labels."""
    for n in (0, 30, 600):
        index = licenses.Index(10000, {w: n * (i % 17) for i, w in enumerate(sorted(licenses.vocabulary()))})
        for size in (1, 2, 3, 4):
            for chosen in itertools.combinations(licenses.TEMPLATES, size):
                words = " and also ".join(text for _, text, _ in chosen).encode().split()
                found = {(label, at) for label, at, _, _ in index.scan(words)}
                at = 0
                for label, text, _ in chosen:
                    assert (label, at) in found
                    at += len(text.split()) + 2


def test_ranking_orders_and_calibrates():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, ranking.N_FEATURES))
    good = x[:, 5] - x[:, 9] > -0.8
    model = ranking.fit(x, good, float(good.mean()))
    scores = np.array([ranking.score_of(model, row) for row in x])
    assert ((scores >= 0.5) == good).mean() > 0.95 and 0 <= scores.min() <= scores.max() <= 1
    assert ranking.score_of(ranking.fit(x, np.ones(400, bool), 1.0), x[0]) == 0.5
    assert ranking.score_of(ranking.fit(np.zeros((0, ranking.N_FEATURES)), np.zeros(0, bool), 0.0), x[0]) == 0.5
    assert not ranking.features(None).any() and np.isfinite(ranking.features("é\n\n")).all()


def test_ranking_sums_over_pairs_by_node():
    """Node sums give the chances of all pairs, far scores and scores on a node among them;
    a score that rounds to the next node in a later pass finds its nodes."""
    draw = np.random.default_rng(6)
    w = np.eye(ranking.N_FEATURES)[0]
    z = draw.normal(size=(90, ranking.N_FEATURES))
    z[:, 0] = [*draw.normal(size=80) * 9, *[ranking.SPACE * k for k in (-3, 0, 1, 80)], *[700.3, -1e6] * 3]
    times = draw.integers(1, 5, 90).astype(float)
    a, b = slice(0, 45), slice(45, 90)
    low, high = ranking._by_node(z[a], times[a], w), ranking._by_node(z[b], times[b], w)
    chance = lambda x, y: 1 / (1 + np.exp(np.clip(x[:, None] - y, -30, 30)))
    by_node = high[1].T @ chance(high[0] * ranking.SPACE, low[0] * ranking.SPACE) @ low[1]
    rows = np.column_stack([np.ones(90), z]) * times[:, None]
    assert np.allclose(by_node, rows[b].T @ chance(z[b, 0], z[a, 0]) @ rows[a], rtol=1e-7, atol=1e-5)
    values = 1 / (1 + np.exp(-np.clip(high[0] * ranking.SPACE, -30, 30)))
    for scale in (1 - 1e-15, 1.0, 1 + 1e-15):
        got = ranking._curve(z[b], times[b], w * scale, high[0], values)
        assert np.allclose(got, (z[b] * (times[b] / (1 + np.exp(-np.clip(z[b, 0], -30, 30))))[:, None]).T @ z[b], rtol=1e-7, atol=1e-5)
