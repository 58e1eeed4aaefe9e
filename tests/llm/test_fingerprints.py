"""Fingerprints: the multiset algebra, the edited texts by brute force, likeness against true window counts, edge rows."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelyard.llm import multiset
from panelyard.llm.multiset import fingerprint, likeness, updated

LINES = st.text(alphabet=st.sampled_from("abé中 \t"), max_size=40)
EDGES = [None, "", "\n", "a", "abcd", "a b c", "x" * 5000, "\n\n", "é中" * 9, " ".join(["same"] * 300), "twice\nover", "twice\nover"]


@settings(max_examples=60, deadline=None)
@given(st.lists(LINES, min_size=1, max_size=8), st.lists(LINES, max_size=3), st.randoms())
def test_paragraphs_in_any_order_inserted_and_deleted(lines, more, rng):
    mixed = [*lines, *more]
    rng.shuffle(mixed)
    whole = fingerprint("\n".join(mixed))
    assert whole == fingerprint("\n".join([*more, *lines])) == updated(fingerprint("\n".join(lines)), inserted=more)
    assert updated(whole, deleted=more) == fingerprint("\n".join(lines))
    if sorted(lines) != sorted(mixed):
        assert whole != fingerprint("\n".join(lines))


def test_slices_change_nothing(monkeypatch):
    rng = random.Random(2)
    texts = ["\n".join(" ".join(rng.choice(["ab", "cde", "é", "中"]) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    texts += ["", "", "z" * 30, "\n"]
    want = multiset.sums(texts)
    assert all((multiset.sums([t])[0] == w).all() for t, w in zip(texts, want))
    monkeypatch.setattr(multiset, "_SLICE", 500)  # longer than any line: cuts fall between lines only
    assert (multiset.sums(texts) == want).all()


def test_a_long_line_is_cut_from_its_own_start(monkeypatch):
    monkeypatch.setattr(multiset, "_SLICE", 100)
    line = "".join(random.Random(3).choice("abc ") for _ in range(1234))
    alone = multiset.sums([line])[0]
    both = multiset.sums(["before\nit", f"head\n{line}\nfoot"])[1]
    assert (both - multiset.sums(["head\nfoot"])[0] == alone).all()


def _edited(texts):
    texts = [t or "" for t in texts]
    after = [*texts[1:], texts[0]]
    return [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, after)], after


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_edited_texts_by_brute_force(spark, parts):
    rng = random.Random(parts)
    texts = EDGES + ["\n".join(" ".join(rng.choice(["red", "grün", "blue", "中文"]) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 6))) for _ in range(90)]
    rows = [(i * 7 - 30, t, "x", 1) for i, t in enumerate(texts)]
    mixed = rows[:]
    rng.shuffle(mixed)
    df = spark.createDataFrame(mixed, "doc_id bigint, text string, part string, guest int").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r["doc_id"]: r for r in multiset.edited_likeness(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    edited, after = _edited(texts)
    assert len(got) == len(rows)
    for (i, t, *_), e, n in zip(rows, edited, after):
        r, own = got[i], fingerprint(t)
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t or ""), hashlib.sha256(e.encode()).hexdigest(), own, fingerprint(e))
        assert r["near_edited"] == likeness(own, fingerprint(e)) and r["near_next"] == likeness(own, fingerprint(n))


def test_null_and_repeated_ids_and_a_single_row(spark):
    rows = [(None, "first text of none"), (None, "second text of none"), (4, "a b"), (4, "a b"), (4, "c d e f g h"), (9, "last of all")]
    got = multiset.edited_likeness(spark.createDataFrame(rows * 3, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in got) == sorted((i or 0, len(t)) for i, t in rows * 3)
    one = multiset.edited_likeness(spark.createDataFrame([(5, "alone in here")], "doc_id bigint, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["edited_sha256"] == hashlib.sha256(b"alone in halo").hexdigest()


def test_likeness_follows_the_share_of_common_text():
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    for kept in (0.0, 0.25, 0.5, 0.75, 1.0):
        seen = []
        for _ in range(12):
            a = words(400)
            cut = int(len(a) * kept)
            seen.append(likeness(fingerprint(a), fingerprint(a[:cut] + words(400)[: len(a) - cut])))
        assert abs(np.mean(seen) - kept) < 0.06


def test_edits_of_stored_fingerprints(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, None), (3, "x")], "doc_id bigint, text string")
    edits = spark.createDataFrame([(1, "b", -1), (1, "d", 2), (2, None, -1), (2, "new", 1), (9, "lost", 1), (None, "lost", 1), (3, "y", None)] + [(3, "z", 1)] * 500, "doc_id bigint, paragraph string, times int")
    got = {r["doc_id"]: r["fingerprint"] for r in multiset.apply_edits(multiset.fingerprints(docs), edits.repartition(6)).collect()}
    assert got == {1: fingerprint("c\nd\na\nd"), 2: fingerprint("new"), 3: fingerprint("\n".join(["z"] * 500 + ["x"]))}
