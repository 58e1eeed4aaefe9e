"""Conversation prefix trie: a z-fast trie whose tables are DataFrames.

A conversation is a path of keys: key d is a 128-bit hash of its first d turns. The compacted trie has a node where paths branch or end; a node's row
holds the keys and running text bytes of the edge that leads to it, from its parent's depth (excluded) to its own. The node is found by its handle: the
key at the two-fattest depth of that range, the one divisible by the largest power of two.

A conversation's exit node is located by fat binary search: of a range of depths it looks up its key at the two-fattest one as a handle, goes below the node that
it finds or above the depth that it doesn't, and so needs log2(turns) joins; the child that it leaves by is found by the key one turn
further on. Insertion is in batches: all waiting conversations are located at once, and of those that leave the trie at one place by one turn a random one is
inserted, which cuts edges and adds a leaf; the others wait for the next batch, in which they get further. As in quicksort,
batches grow with the logarithm of the conversations, and usually there are two to four of them. Equal conversations are one path with members.

Sums over subtrees double their reach each step (a node adds the sums of its descendants 2^k nodes below), so the steps are the logarithm of the height.
At the end each edge is expanded to a row per depth. Every step is a plain join or aggregation with partial sums, so a node with most of the conversations is
split like any other hot key. Texts are hashed where they are read and never shuffled.

Defined cases: null roles and texts are empty. Turns with equal or null numbers are ordered by number (nulls first), then by a hash of role and text;
repeated rows are repeated turns. Rows with a null conv_id are one conversation that is written "null" among the ids of ends, before others, and
names a node only if no other member does; it is not rebuilt. A conversation's keys (16 bytes a turn) are one row. An
empty table has no nodes. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import forget, table, written

#: Turns that a conversation may share with its group's first one are below this; conversations in a group.
SHARED, GROUP = 9, 5
#: Ids that are joined to one text before they are shuffled.
CHUNK = 4096


def turns_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, k (from 1), digest (of role and text), bytes (of text): narrow rows, a turn each."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_)))
    rows = conversations.select(F.col(conv_id).cast("bigint").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(text_).cast("bigint").alias("bytes"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv", F.row_number().over(order).cast("bigint").alias("k"), "digest", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Turns as `turns_of` has them, of conversations that start like the first one of their group: conv, own, k, digest, bytes, and for each conversation a row
    without digest, so that turnless ones stay. turns should be stored, they are read three times."""
    shared = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(SHARED))
    convs = turns.groupBy("conv").agg(F.lit(0).alias("zero")).select("conv", F.expr(f"conv - conv % {GROUP}").alias("first"), F.coalesce(shared, F.lit(0)).alias("h"))
    own = turns.where(F.col("k") > F.coalesce(shared, F.lit(0))).select("conv", F.lit(1).alias("own"), "k", "digest", "bytes")
    source = turns.where(F.col("k") < SHARED).select(F.col("conv").alias("of"), "k", "digest", "bytes")
    lent = convs.join(source, (F.col("first") == F.col("of")) & (F.col("k") <= F.col("h"))).select("conv", F.lit(0).alias("own"), "k", "digest", "bytes")
    heads = convs.select("conv", F.lit(-1).alias("own"), F.lit(0).cast("bigint").alias("k"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("bytes"))
    return heads.unionByName(lent).unionByName(own)


def paths(turns: DataFrame) -> DataFrame:
    """conv, n, keys (of its first 1 to n turns), bytes (running, from 0), from rows as `rebuilt` or `turns_of` has them (own may be lacking)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
        done: list[tuple] = []
        nothing = object()
        now, keys, sizes, held = nothing, [], [0], 0
        for b in batches:
            for c, digest, size in zip(b.column("conv").to_pylist(), b.column("digest").to_pylist(), b.column("bytes").to_pylist()):
                if c != now:
                    if now is not nothing:
                        done.append((now, len(keys), keys, sizes))
                        held += len(keys) + 1
                    now, keys, sizes = c, [], [0]
                if digest is not None:
                    keys.append(hashlib.blake2b((keys[-1] if keys else b"") + digest, digest_size=16).digest())
                    sizes.append(sizes[-1] + size)
                if held > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), kinds)], ["conv", "n", "keys", "bytes"])
                    done, held = [], 0
        if now is not nothing:
            done.append((now, len(keys), keys, sizes))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), kinds)], ["conv", "n", "keys", "bytes"])

    rows = turns if "own" in turns.columns else turns.withColumn("own", F.lit(1))
    ordered = rows.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "own", "k").select("conv", "digest", "bytes")
    return ordered.mapInArrow(run, "conv bigint, n bigint, keys array<binary>, bytes array<bigint>")


def two_fattest(a: str, b: str) -> str:
    """SQL of the number in (a, b] that the largest power of two divides."""
    return f"(({b}) & shiftleft(-1L, length(bin(({a}) ^ ({b}))) - 1))"


def _at(keys: str, depth: str) -> str:
    """SQL of the key at a depth, the root's at 0."""
    return f"IF({depth} = 0, X'', element_at({keys}, CAST(greatest({depth}, 1) AS INT)))"


_NODE = ["id", "parent", "top", "depth", "keys", "bytes"]


def _root(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(bytearray(), None, -1, 0, [], [0])], "id binary, parent binary, top bigint, depth bigint, keys array<binary>, bytes array<bigint>")


def _search(nodes: DataFrame, waiting: DataFrame, steps: int) -> DataFrame:
    """waiting with a (depth of the deepest node on its path that is found) and leaves (the node whose edge it leaves, null at a node)."""
    handle = F.expr(f"element_at(keys, CAST({two_fattest('top', 'depth')} - top AS INT))")
    handles = nodes.where("top >= 0").select(handle.alias("handle"), F.col("id").alias("hit"), F.col("depth").alias("hit_depth"))
    found = waiting.withColumns({"a": F.lit(0).cast("bigint"), "b": F.col("n"), "leaves": F.lit(None).cast("binary")})
    kept = waiting.columns
    for _ in range(steps):
        found = found.withColumn("f", F.expr(f"IF(leaves IS NULL AND a < b, {two_fattest('a', 'b')}, 0)"))
        # a search that is over asks for a key of its own, which no handle equals
        found = found.withColumn("asked", F.expr("IF(f > 0, element_at(keys, CAST(greatest(f, 1) AS INT)), concat(path, X'00'))"))
        found = found.join(handles, F.col("asked") == F.col("handle"), "left")
        whole = "(hit_depth <= n AND element_at(keys, CAST(greatest(least(hit_depth, n), 1) AS INT)) = hit)"
        found = found.select(
            *kept, F.expr(f"IF(hit IS NOT NULL AND {whole}, hit_depth, a)").alias("a"), F.expr("IF(f > 0 AND hit IS NULL, f - 1, b)").alias("b"),
            F.expr(f"IF(hit IS NOT NULL AND NOT {whole}, hit, leaves)").alias("leaves"),
        )
    firsts = nodes.where("top >= 0").select(F.expr("keys[0]").alias("first_key"), F.col("id").alias("child"))
    found = found.withColumn("asked", F.expr("IF(leaves IS NULL AND a < n, element_at(keys, CAST(least(a + 1, n) AS INT)), concat(path, X'00'))"))
    return found.join(firsts, F.col("asked") == F.col("first_key"), "left").select(*kept, "a", F.coalesce("leaves", "child").alias("leaves"))


def locate(nodes: DataFrame, waiting: DataFrame, steps: int) -> DataFrame:
    """Where paths leave the trie. waiting: n, keys, path (a key of its own for each row), any others; steps: bits of the largest n.

    Adds at (depth up to which the trie has the path), edge (id of the node whose edge holds that depth inside it, null if it is a node's depth).
    """
    found = _search(nodes, waiting, steps)
    edges = nodes.select(F.col("id").alias("edge"), F.col("top").alias("edge_top"), F.col("depth").alias("edge_depth"), F.col("keys").alias("edge_keys"))
    found = found.withColumn("asked", F.coalesce("leaves", F.concat("path", F.lit(b"\0"))))
    found = found.join(edges, F.col("asked") == F.col("edge"), "left")
    # keys of prefixes: once two paths differ, they differ at all greater depths
    common = "size(filter(sequence(1L, greatest(1L, least(size(edge_keys), n - edge_top))), i -> i <= n - edge_top AND edge_keys[CAST(i - 1 AS INT)] = keys[CAST(edge_top + i - 1 AS INT)]))"
    at = F.expr(f"IF(edge IS NULL, a, edge_top + {common})")
    found = found.withColumn("at", at)
    return found.select(*waiting.columns, "at", F.expr("IF(edge IS NOT NULL AND at < edge_depth, edge, NULL)").alias("edge"))


def _inserted(nodes: DataFrame, chosen: DataFrame) -> DataFrame:
    """nodes after a batch: chosen are paths with `at` and `edge`, no two of which leave at one place by one turn."""
    cuts = chosen.where("edge IS NOT NULL").groupBy(F.col("edge").alias("cut_id")).agg(F.sort_array(F.collect_set("at")).alias("cuts"))  # depths inside one edge
    both = nodes.join(cuts, F.col("id") == F.col("cut_id"), "left")
    both = both.select(*_NODE, F.explode(F.expr("zip_with(concat(array(top), coalesce(cuts, array())), concat(coalesce(cuts, array()), array(depth)), (x, y) -> struct(x AS low, y AS high))")).alias("piece"))
    low, high = "CAST(piece.low - top AS INT)", "CAST(piece.high - piece.low AS INT)"
    part = both.select(
        F.expr(f"IF(piece.high = depth, id, element_at(keys, CAST(greatest(piece.high - top, 1) AS INT)))").alias("id"), F.expr(f"IF(piece.low = top, parent, element_at(keys, greatest({low}, 1)))").alias("parent"),
        F.expr("piece.low").alias("top"), F.expr("piece.high").alias("depth"), F.expr(f"IF(depth = 0, keys, slice(keys, {low} + 1, {high}))").alias("keys"),
        F.expr(f"IF(depth = 0, bytes, slice(bytes, {low} + 1, {high} + 1))").alias("bytes"),
    )
    leaves = chosen.where("n > at").select(
        F.expr("element_at(keys, -1)").alias("id"), F.expr(_at("keys", "at")).alias("parent"), F.col("at").alias("top"), F.col("n").alias("depth"),
        F.expr("slice(keys, CAST(at + 1 AS INT), CAST(n - at AS INT))").alias("keys"), F.expr("slice(bytes, CAST(at + 1 AS INT), CAST(n - at + 1 AS INT))").alias("bytes"),
    )
    return part.unionByName(leaves)


def build(distinct: DataFrame) -> DataFrame:
    """The nodes of the compacted trie of paths (n, keys, bytes; no two of them equal): id (the key at depth, empty for the root), parent (null for it), top (the
    parent's depth, -1), depth, keys (of the edge), bytes (running, at depths top to depth)."""
    spark = distinct.sparkSession
    nodes = _root(spark)
    waiting = written(distinct.where("n > 0").select("n", "keys", "bytes", F.expr("element_at(keys, -1)").alias("path")), "waiting")
    longest = waiting.agg(F.max("n")).first()[0]
    batch = 0
    while longest:
        if batch:
            placed = locate(nodes, waiting, int(longest).bit_length())
        else:  # there is the root only
            placed = waiting.withColumns({"at": F.lit(0).cast("bigint"), "edge": F.lit(None).cast("binary")})
        # those whose last turn is a node's depth are in
        placed = placed.where("at < n OR edge IS NOT NULL").withColumn("exit", F.expr("IF(at < n, element_at(keys, CAST(least(at + 1, n) AS INT)), concat(path, X'01'))"))
        placed = written(placed.withColumn("order", F.xxhash64("path", F.lit(batch))), "placed")
        firsts = placed.groupBy(F.col("exit").alias("chosen_exit")).agg(F.min(F.struct("order", "path")).alias("low")).select("chosen_exit", F.col("low.path").alias("chosen_path"))
        drawn = placed.join(firsts, F.col("exit") == F.col("chosen_exit"))
        drawn = written(drawn.select("n", "keys", "bytes", "path", "at", "edge", (F.col("path") == F.col("chosen_path")).alias("chosen")), "drawn")
        last, before = nodes, waiting
        nodes = written(_inserted(nodes, drawn.where("chosen")), "nodes")
        waiting = drawn.where("NOT chosen").select("n", "keys", "bytes", "path")
        longest = waiting.agg(F.max("n")).first()[0]
        forget(last, before, placed, *kept_from(drawn, longest))
        batch += 1
    return nodes


def kept_from(drawn: DataFrame, longest: int | None) -> list[DataFrame]:
    """Tables of a batch that the next one doesn't read: drawn holds those that wait."""
    return [] if longest else [drawn]


def subtree_sums(nodes: DataFrame, own: list[Column], names: list[str], least: str) -> DataFrame:
    """id and the sums of columns (own, as names) over each node's subtree, itself included; `least` is a minimum instead. Sums double their reach each step."""
    now = written(nodes.select("id", F.col("parent").alias("above"), *[c.alias(n) for c, n in zip(own, names)]), "sums")
    while not now.where("above IS NOT NULL").isEmpty():
        added = now.where("above IS NOT NULL").groupBy(F.col("above").alias("to")).agg(*[(F.min if n == least else F.sum)(n).alias(f"{n}_below") for n in names])
        next_ = now.select(F.col("id").alias("up"), F.col("above").alias("higher")).where("higher IS NOT NULL")
        both = now.join(added, F.col("id") == F.col("to"), "left").join(next_, F.col("above") == F.col("up"), "left")
        more = [F.least(n, f"{n}_below").alias(n) if n == least else (F.col(n) + F.coalesce(f"{n}_below", F.lit(0))).alias(n) for n in names]
        last, now = now, written(both.select("id", F.col("higher").alias("above"), *more), "sums")
        forget(last)
    return now


def ends_digests(ends: DataFrame) -> DataFrame:
    """ended (a path's last key), ends_sha256 (of its members' ids, ascending, comma-joined) from rows (ended, conv). Ids are sorted by ranges and joined to texts there, so that the
    members of a path which most conversations take are shuffled as a few texts."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids, done = None, None, [], []

        def end() -> None:
            if ids:
                done.append((now, first is not None, first or 0, ",".join(ids)))

        def batch() -> pa.RecordBatch:
            kinds = (pa.binary(), pa.bool_(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), kinds)], ["ended", "named", "low", "ids"])

        for b in batches:
            for key, conv in zip(b.column("ended").to_pylist(), b.column("conv").to_pylist()):
                if key != now or len(ids) >= CHUNK:
                    end()
                    now, first, ids = key, conv, []
                ids.append("null" if conv is None else str(conv))
            if len(done) > 20_000:
                yield batch()
                done.clear()
        end()
        if done:
            yield batch()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, done = None, None, []
        for b in batches:
            for key, ids in zip(b.column("ended").to_pylist(), b.column("ids").to_pylist()):
                if key == now:
                    sha.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.binary(), pa.string()))], ["ended", "ends_sha256"])
                done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([sha.hexdigest()], pa.string())], ["ended", "ends_sha256"])

    order = [F.col("ended"), F.col("conv").asc_nulls_first()]
    texts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "ended binary, named boolean, low bigint, ids string")
    return texts.repartition("ended").sortWithinPartitions("ended", "named", "low").mapInArrow(hashed, "ended binary, ends_sha256 string")


def prefix_nodes(found: DataFrame) -> DataFrame:
    """A row per distinct prefix of paths (as `paths` gives them; stored, they are read twice): conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves (childless nodes
    in its subtree), saved_tokens (text bytes that its subtree's members share with an earlier one), ends_sha256 (of the ids that end there)."""
    ends = written(found.select("conv", "n", F.expr(_at("keys", "n")).alias("ended"), F.expr("element_at(bytes, -1)").alias("total")), "ends")
    tally = ends.groupBy("ended").agg(F.count("*").alias("members"), F.min("conv").alias("low"), F.max("conv").isNotNull().alias("named"), F.max("total").alias("total"))
    tally = written(tally, "tally")
    # one path of each class: its first member, the nameless one if there is no other
    reps = tally.select(F.col("low").alias("rep"), F.col("ended").alias("rep_ended"))
    distinct = found.join(reps, F.col("conv").eqNullSafe(F.col("rep")) & (F.expr(_at("keys", "n")) == F.col("rep_ended"))).select("n", "keys", "bytes")
    nodes = build(distinct)
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("parent_id")).agg(F.count("*").alias("n_children"))
    rich = nodes.join(tally, F.col("id") == F.col("ended"), "left").join(children, F.col("id") == F.col("parent_id"), "left")
    rich = written(rich.select(*_NODE, F.coalesce("members", F.lit(0)).alias("members"), "low", F.coalesce("n_children", F.lit(0)).alias("n_children")), "rich")
    own = [
        F.col("members"), F.col("low"), (F.col("n_children") == 0).cast("bigint"), F.col("members") * F.element_at("bytes", -1), F.element_at("bytes", -1) - F.element_at("bytes", 1),
    ]
    sums = subtree_sums(rich, own, ["n_convs", "least", "n_leaves", "all_bytes", "own_bytes"], "least")
    digests = written(ends_digests(ends.select("ended", "conv")), "digests")
    both = rich.drop("members", "low").join(sums.drop("above").withColumnRenamed("id", "sum_id"), F.col("id") == F.col("sum_id"))
    both = both.join(sums.select(F.col("id").alias("parent_id"), F.col("least").alias("parent_least")), F.col("parent") == F.col("parent_id"), "left")
    both = both.join(digests, F.col("id") == F.col("ended"), "left").where("n_convs > 0")
    rows = both.withColumn("d", F.explode(F.expr("IF(depth = 0, array(0L), sequence(top + 1, depth))")))
    before = "IF(depth = 0, 0L, bytes[CAST(greatest(d - 1 - top, 0) AS INT)])"
    out = rows.select(
        F.col("least").alias("conv_id"), F.col("d").alias("depth"), F.expr("IF(d = top + 1, parent_least, least)").alias("up"), "depth", "n_convs", F.expr("IF(d = depth, n_children, 1L)").alias("n_children"), "n_leaves",
        F.expr(f"all_bytes - n_convs * {before} - (own_bytes - ({before} - bytes[0]))").alias("saved_tokens"), F.expr("IF(d = depth, ends_sha256, NULL)").alias("ends_sha256"),
    ).toDF("conv_id", "depth", "up", "node_depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", F.expr("IF(depth = 0, NULL, up)").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(turns_of(table(spark, sf_dir, "conversations")), "turns")
    return prefix_nodes(written(paths(rebuilt(turns)), "paths"))


_CRC = ", ".join(str(v) for v in (0, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C, 0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C))
#: crc32 by half-bytes over the digits; prefixes are told apart by their turns' hashes, one after the other.
ORACLE = f"""
WITH c AS (SELECT conv_id, list_reduce([4294967295::BIGINT] || flatten([[ascii(x) & 15, ascii(x) >> 4]::BIGINT[] FOR x IN string_split(conv_id::VARCHAR, '')]),
    lambda a, x: xor(a >> 4, ([{_CRC}]::BIGINT[])[(xor(a, x) & 15) + 1])) AS crc FROM (SELECT DISTINCT conv_id FROM conversations)),
h AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS base, xor(crc, 4294967295) % {SHARED} AS h FROM c),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
r AS (SELECT h.conv_id, 0 AS own, k, md5(role) || md5(text) AS m, strlen(text) AS bytes FROM h JOIN t ON t.conv_id = h.base AND k <= h
  UNION ALL SELECT h.conv_id, 1, k, md5(role) || md5(text), strlen(text) FROM h JOIN t ON t.conv_id = h.conv_id AND k > h),
p AS (SELECT conv_id, row_number() OVER w AS d, md5(string_agg(m, '') OVER w) AS id, bytes FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, k ROWS UNBOUNDED PRECEDING)),
q AS (SELECT conv_id, d, id, coalesce(lag(id) OVER (PARTITION BY conv_id ORDER BY d), '') AS up, bytes, d = max(d) OVER (PARTITION BY conv_id) AS last FROM p
  UNION ALL SELECT conv_id, 0, '', NULL, 0, NOT EXISTS (SELECT 1 FROM r WHERE r.conv_id = h.conv_id) FROM h),
n AS (SELECT id, any_value(up) AS up, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(bytes) AS saved,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends FROM q GROUP BY id),
k AS (SELECT up, count(*) AS children FROM n WHERE up IS NOT NULL GROUP BY up),
a AS (SELECT DISTINCT q.id, o.id AS above FROM q JOIN q AS o ON o.conv_id = q.conv_id AND o.d <= q.d),
s AS (SELECT above, sum(saved) AS saved, count(*) FILTER (k.up IS NULL) AS leaves FROM a JOIN n ON n.id = a.id LEFT JOIN k ON k.up = a.id GROUP BY above)
SELECT n.conv_id, n.d::BIGINT AS depth, o.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM n LEFT JOIN n AS o ON o.id = n.up LEFT JOIN k ON k.up = n.id JOIN s ON s.above = n.id
"""
