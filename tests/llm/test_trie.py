"""Conversation prefix trie against brute force: random trees, chains, copies, null and turnless conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelyard.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, keys int"


def brute(convs):
    """convs: id -> list of (role, text); rows as prefix_nodes gives them."""
    order = lambda c: (c is not None, c or 0)
    members, ends, kids, size = defaultdict(set), defaultdict(list), defaultdict(set), {(): 0}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            p = tuple(turns[:d])
            members[p].add(c)
            if d:
                kids[p[:-1]].add(p)
                size[p] = len(turns[d - 1][1].encode())
        ends[tuple(turns)].append(c)
    low = lambda p: min((c for c in members[p] if c is not None), default=None)
    below = {}
    for p in sorted(members, key=len, reverse=True):
        saved, leaves = (len(members[p]) - 1) * size[p], 0 if kids[p] else 1
        for k in kids[p]:
            saved, leaves = saved + below[k][0], leaves + below[k][1]
        below[p] = (saved, leaves)
    out = []
    for p in members:
        ids = ",".join("null" if c is None else str(c) for c in sorted(ends.get(p, []), key=order))
        out.append((low(p), len(p), low(p[:-1]) if p else None, len(members[p]), len(kids[p]), below[p][1], below[p][0], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(convs):
    return [(c, k, r, t, "x", 1) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]


def found(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def nodes_of(spark, convs):
    turns = trie.turns_of(spark.createDataFrame(rows_of(convs), SCHEMA).repartition(3))
    return trie.prefix_nodes(trie.written(trie.paths(turns), "paths"))


def tree(rng, depth):
    return [(rng.choice("ua"), rng.choice(["a", "b", "é"])) for _ in range(depth)]


@pytest.mark.parametrize("kind", ["bushy", "chain", "copies", "deep"])
def test_prefix_nodes_by_brute_force(spark, kind):
    rng = random.Random(kind)
    if kind == "bushy":
        convs = {c: tree(rng, rng.randint(1, 6)) for c in range(120)} | {None: [("u", "a"), ("u", "zz")]}
    elif kind == "chain":  # each a prefix of the next one
        long = [("u", f"t{i}") for i in range(40)]
        convs = {c: long[: c + 1] for c in range(40)}
    elif kind == "copies":
        convs = {c: [("u", "hot"), ("a", f"x{c % 3}")] for c in range(9000)} | {9001: [("u", "hot")], 9002: [("a", "hot")], -5: [("u", "hot"), ("a", "x0")]}
    else:
        base = [("u", f"é{i}") for i in range(300)]
        convs = {c: base[: rng.randint(1, 300)] + [("a", f"{c}-{i}") for i in range(rng.randint(0, 3))] for c in range(60)}
    assert found(nodes_of(spark, convs)) == brute(convs)


def test_one_conversation_and_none(spark):
    assert found(nodes_of(spark, {7: [("u", "a"), ("a", "b")]})) == brute({7: [("u", "a"), ("a", "b")]})
    assert found(nodes_of(spark, {None: [("u", "a")]})) == brute({None: [("u", "a")]})
    assert nodes_of(spark, {}).count() == 0


def test_rebuilt_conversations(spark):
    rng = random.Random(4)
    convs = {c: tree(rng, rng.randint(1, 12)) for c in [*range(-7, 40), 1000003]}
    del convs[10], convs[15]
    rows = rows_of(convs) + [(50, None, None, None, "x", 1), (50, None, "u", "a", "x", 1), (50, 3, "u", "a", "x", 1), (50, 3, "u", "a", "x", 1), (None, 0, "u", "q", "x", 1)]
    turns = trie.written(trie.turns_of(spark.createDataFrame(rows, SCHEMA).repartition(3)), "turns")
    digest = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).digest()
    convs[50] = [*sorted([("", ""), ("u", "a")], key=lambda x: digest(*x)), ("u", "a"), ("u", "a")]
    want = {None: [("u", "q")]}
    for c, turns_ in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 9, int(c - (abs(c) % 5) * (1 if c >= 0 else -1))
        want[c] = convs.get(base, [])[:h] + turns_[h:]
    assert any(not t for t in want.values())  # a turnless one
    assert found(trie.prefix_nodes(trie.written(trie.paths(trie.rebuilt(turns)), "paths"))) == brute(want)


def test_exit_nodes_of_new_conversations(spark):
    old = {c: [("u", x) for x in p] for c, p in enumerate(["abcdef", "abcxyz", "abq", "r", "abcde"])}
    new = {100 + i: [("u", x) for x in p] for i, p in enumerate(["abcdex", "abcxyz", "ab", "z", "abcxy", "rrrr", "abqqqqqqq"])}
    ready = lambda convs: trie.written(trie.paths(trie.turns_of(spark.createDataFrame(rows_of(convs), SCHEMA))), "p")
    nodes = trie.build(ready(old).select("n", "keys", "bytes"))
    where = trie.locate(nodes, ready(new).withColumn("path", F.expr("element_at(keys, -1)")), 4).collect()
    assert {r["conv"]: (r["at"], r["edge"] is None) for r in where} == {100: (5, True), 101: (6, True), 102: (2, True), 103: (0, True), 104: (5, False), 105: (1, True), 106: (3, True)}


def test_two_fattest_numbers(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 70)]
    got = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", F.expr(trie.two_fattest("a", "b")).alias("f")).collect()
    assert all(r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda x: x & -x) for r in got)
