"""Block-wise screening by keyed state: blocks in order give the batch job's rows, across restarts, failures and skewed keys."""

import random

import pytest
from pyspark.sql import functions as F

from panelyard.streaming.ingest import screen_blocks

SCHEMA = "key string, pos bigint, size double, more string"


def _land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(folder)


def _first_rows(blocks):
    """The batch job's rows: of each key the smallest place of its first block."""
    out = {}
    for rows in blocks:
        first = {}
        for r in sorted(rows, key=lambda r: r[1]):
            if r[0] is not None:
                first.setdefault(r[0], r)
        out = first | out
    return sorted(out.values())


def test_blocks_and_restarts_give_the_batch_rows(spark, tmp_path):
    rng = random.Random(3)
    row = lambda pos: (rng.choice([None, "hot", "hot", *[f"k{i}" for i in range(60)]]), pos, rng.choice([None, 1.5, 2.5]), rng.choice([None, "x"]))
    blocks = [[row(n * 1000 + i) for i in range(200)] for n in range(4)]
    place = [f"{tmp_path}/{x}" for x in ("in", "out", "checkpoint")]
    known, total = set(), 0
    for rows in blocks:
        _land(spark, place[0], rows)
        done = screen_blocks(spark, place[0], SCHEMA, lambda b: b.withColumn("screened", F.col("size") * 2), place[1], place[2], files_at_once=100)
        new = {r[0] for r in rows if r[0] is not None} - known
        known |= new
        # a block reads its own rows and no earlier output; its state grows by its new keys
        assert sum(d["rows"] for d in done) == len(rows) and sum(d["new_keys"] for d in done) == len(new) and done[-1]["keys"] == len(known)
        total += len(rows)
    got = spark.read.parquet(place[1]).select("key", "pos", "size", "more", "screened").collect()
    assert sorted(((r["key"], r["pos"], r["size"], r["more"]) for r in got), key=lambda r: r[:2]) == _first_rows(blocks)
    assert all(r["screened"] == (None if r["size"] is None else 2 * r["size"]) for r in got)
    assert screen_blocks(spark, place[0], SCHEMA, lambda b: b, place[1], place[2]) == [] or spark.read.parquet(place[1]).count() == len(known)


def test_a_block_that_fails_is_run_again(spark, tmp_path):
    place = [f"{tmp_path}/{x}" for x in ("in", "out", "checkpoint")]
    blocks = [[("a", 1, 1.0, None), ("b", 2, 1.0, None)], [("b", 3, 9.0, None), ("c", 4, 1.0, None)]]
    _land(spark, place[0], blocks[0])
    screen_blocks(spark, place[0], SCHEMA, lambda b: b, place[1], place[2], files_at_once=100)
    _land(spark, place[0], blocks[1])

    def broken(batch):
        batch.write.mode("overwrite").parquet(f"{place[1]}/block=1")  # half done
        raise ValueError("lost")

    with pytest.raises(Exception, match="lost"):
        screen_blocks(spark, place[0], SCHEMA, broken, place[1], place[2], files_at_once=100)
    screen_blocks(spark, place[0], SCHEMA, lambda b: b, place[1], place[2], files_at_once=100)
    assert sorted(tuple(r)[:2] for r in spark.read.parquet(place[1]).select("key", "pos").collect()) == [("a", 1), ("b", 2), ("c", 4)]
