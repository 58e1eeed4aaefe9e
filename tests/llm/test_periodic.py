"""Periodic runs against brute force over all periods; texts, digests and edge rows."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelyard.llm import periodic
from panelyard.llm.common import mix


def brute(words):
    """(start, end, period) of all runs of three periods: maximal stretches of each period, with the smallest period of each place."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        x = 0
        while x < len(words) - q:
            y = x
            while y < len(words) - q and words[y] == words[y + q]:
                y += 1
            if y - x >= 2 * q:
                found.setdefault((x, y + q), q)
            x = max(y, x + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def some_words(rng, letters, depth):
    if not depth:
        return [rng.randrange(letters) for _ in range(rng.randint(1, 14))]
    out = [x for _ in range(rng.randint(1, 3)) for x in some_words(rng, letters, depth - 1)] * rng.choice([1, 1, 2, 3, 4, 5])
    return out[: len(out) - rng.randrange(3)] if len(out) > 3 else out


@pytest.mark.parametrize("letters", [1, 2, 3, 6, 60])
def test_all_runs_by_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(250):
        words = some_words(rng, letters, rng.randint(0, 4))[:450]
        assert [tuple(x) for x in periodic.cubic_runs(np.array(words, np.uint64)).tolist()] == brute(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=25), st.integers(1, 9), st.lists(st.integers(0, 2), max_size=30), st.integers(1, 5))
def test_nested_repeats(root, times, tail, outer):
    words = (root * times + tail) * outer
    assert [tuple(x) for x in periodic.cubic_runs(np.array(words, np.uint64)).tolist()] == brute(words)


def test_long_periods_with_highly_periodic_roots():
    rng = random.Random(9)
    for root in ([1] * 500 + [2], [1, 2] * 300 + [3], [1] * 200 + [2] + [1] * 199 + [3], [rng.randrange(9) for _ in range(700)], list(range(1000))):
        words = [1] * 40 + root * 3 + root[:17] + [77]
        assert [tuple(x) for x in periodic.cubic_runs(np.array(words, np.uint64)).tolist()] == brute(words)


def test_unlucky_hashes_make_no_runs(monkeypatch):
    monkeypatch.setattr(periodic._Prefixes, "same", lambda self, i, j, n: np.ones(len(i), bool))  # whatever is compared seems equal
    words = [5, 6, 7] + [10, 11, 12, 13, 14, 15, 16] * 5 + list(range(100, 140))
    got = periodic.cubic_runs(np.array(words, np.uint64))
    assert all((np.array(words)[s : e - q] == np.array(words)[s + q : e]).all() for s, e, q in got.tolist()) and [3, 38, 7] in got.tolist()


def test_texts_share_passes_and_keep_apart(monkeypatch):
    rng = random.Random(3)
    texts = [np.array(some_words(rng, rng.choice([1, 2, 5]), rng.randint(0, 4))[:300], np.uint64) for _ in range(300)]
    want = [[(s, e - s, q) for s, e, q in brute(t.tolist()) if e - s >= 24] for t in texts]
    for size in (1, 500, 1 << 16):
        monkeypatch.setattr(periodic, "_PASS", size)
        assert [[tuple(r) for r in x.tolist()] for x in periodic.runs_of(texts)] == want


def test_separators_are_no_words():
    first = mix(np.arange(1, 4, dtype=np.uint64) * periodic._BASE)
    got = periodic.runs_of([np.tile(first, 9)] * 3)
    assert [x.tolist() for x in got] == [[[0, 27, 3]]] * 3
    with pytest.raises(ValueError):
        periodic.runs_of([], periods=2)


def _query_row(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(key).encode())
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = [(s, e - s, q) for s, e, q in brute(words) if e - s >= 24]
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    lines = "".join(f"{s},{n_},{q}\n" for s, n_, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, sha(lines), sha(kept))


def test_query_by_brute_force(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t ", "one", "a b c", "x" * 3000, " ".join(["same"] * 300), "\x1c a\x85b c " * 30, "é 中\x0b" * 40, "same\tsame\nsame " * 9]
    texts += [" ".join(f"w{x}" for x in some_words(rng, rng.choice([2, 4, 500]), rng.randint(0, 4))[:400]) for _ in range(150)]
    texts += [" ".join(f"v{rng.randrange(5000)}" for _ in range(rng.randint(1, 500))) for _ in range(150)]
    rows = [(i, t, [1], 5, "c") for i, t in enumerate(texts)] + [(None, "a b " * 30, None, 1, "c"), (3, "one", None, 1, "c"), (3, "one", None, 1, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs array<int>, n_words int, collapsed string").repartition(3)
    got = periodic.digested(periodic.find_runs(periodic.with_planted_runs(df))).collect()
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted((tuple(r[n] for n in names) for r in got), key=lambda r: repr(key(r))) == sorted(((r[0], *_query_row(r[0], r[1])) for r in rows), key=lambda r: repr(key(r)))


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(periodic, "_PIECE", 50)
    raw = ("  " + " ".join(f"w{i % 37}" for i in range(500)) + "\n" + "y" * 300 + " z").encode()
    words = raw.split()
    assert [w for some in periodic.pieces(raw) for w in some] == words and len(periodic.word_ids(raw)) == len(words)
    runs = periodic.runs_of([periodic.word_ids(raw)])[0]
    assert runs.tolist() == [[0, 500, 37]]
    assert periodic.collapsed(raw, runs, len(words)) == b" ".join(words[:37] + words[500:])
