"""Points in space: boxes around groups, quality of boxes, neighbours within a radius."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("x", "y", "z")


def inside(prefix_center: str = "c", prefix_size: str = "s") -> Column:
    """Point columns x, y, z inside the box of centers cx.. and sizes sx.. (borders inside)."""
    ok = F.lit(True)
    for a in AXES:
        ok = ok & (F.abs(F.col(a) - F.col(f"{prefix_center}{a}")) <= F.col(f"{prefix_size}{a}") / 2)
    return ok


def group_box(points: DataFrame, entry: str = "entry", group: str = "grp", pad: float = 4.0, least: float = 20.0, named: int | str | None = None) -> DataFrame:
    """Per entry: the named or else the largest group (the smallest name of equals), its centroid and padded extent."""
    aggs = [F.count("*").alias("n")]
    for a in AXES:
        aggs += [F.round(F.avg(a), 6).alias(f"c{a}"), F.round(F.greatest(F.lit(least), F.max(a) - F.min(a) + 2 * pad), 6).alias(f"s{a}")]
    boxes = points.groupBy(entry, group).agg(*aggs)
    if named is not None:
        boxes = boxes.where(F.col(group) == named)
        if boxes.isEmpty():
            raise ValueError(f"no group {named!r}")
        return boxes
    return boxes.groupBy(entry).agg(F.min_by(F.struct(*boxes.columns), F.struct((-F.col("n")).alias("n"), F.col(group))).alias("b")).select("b.*")


def box_qa(points: DataFrame, boxes: DataFrame, entry: str = "entry", group: str = "grp", min_inside: float = 0.9) -> DataFrame:
    """Per box: points of its group, share inside, points of other groups inside, failed checks. One box per entry comes in."""
    b = boxes.select(entry, F.col(group).alias("box_group"), *[f"{k}{a}" for k in "cs" for a in AXES])
    own, within = F.col(group) == F.col("box_group"), inside()
    out = points.join(b, entry).groupBy(entry, "box_group").agg(F.count_if(own).alias("n_own"), F.round(F.count_if(own & within) / F.count_if(own), 6).alias("inside"), F.count_if(~own & within).alias("n_others_inside"))
    why = F.array_compact(F.array(F.when(F.col("inside") < min_inside, "group outside box"), F.when(F.col("n_own") < 3, "few points"), F.when(F.col("n_others_inside") == 0, "nothing around")))
    return out.select(entry, "box_group", "n_own", "inside", "n_others_inside", F.array_join(why, ",").alias("failed"))


#: Points that share a cell and a part of it when they meet centers.
CROWD = 4096


def within_radius(points: DataFrame, centers: DataFrame, radius: float, by: str = "entry") -> DataFrame:
    """Points with a center of the same entry within the radius.

    Cells of half the radius' width come first: their diagonal is shorter than the radius, so points that share one with a center need no distance, and a crowd of points around a
    crowd of centers is one row of cells. The other points meet the centers of the 27 cells of the radius' width around them; a cell with many such points is split into parts, each
    with the cell's centers."""
    fine = lambda d: [F.floor(F.col(a) / (radius / 2)).alias(f"h{a}") for a in d]
    own = points.select("*", *fine(AXES), *[F.floor(F.col(a) / radius).alias(f"g{a}") for a in AXES])
    cells = [by, *[f"h{a}" for a in AXES]]
    centered = centers.select(by, *fine(AXES)).distinct()
    inside_ = own.join(centered, cells, "left_semi")
    rest = own.join(centered, cells, "left_anti")
    keys = [by, *[f"g{a}" for a in AXES]]
    crowds = rest.groupBy(*keys).agg(F.ceil(F.count("*") / CROWD).cast("int").alias("parts"))
    around = centers.select(F.col(by), *[F.col(a).alias(f"o{a}") for a in AXES])
    for a in AXES:
        at = F.floor(F.col(f"o{a}") / radius)
        around = around.withColumn(f"g{a}", F.explode(F.array(at - 1, at, at + 1)))
    around = around.join(crowds, keys).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = rest.join(crowds, keys).withColumn("part", F.pmod(F.xxhash64(*AXES), "parts").cast("int"))
    near = sum(((F.col(a) - F.col(f"o{a}")) ** 2 for a in AXES), F.lit(0.0)) <= radius * radius
    p, c = dealt.alias("p"), around.alias("c")
    same = F.col("p.part") == F.col("c.part")
    for k in keys:
        same = same & (F.col(f"p.{k}") == F.col(f"c.{k}"))
    found = p.join(c, same & near, "left_semi")
    return inside_.select(*points.columns).unionByName(found.select(*points.columns))


def preference(df: DataFrame, similarity: str = "similarity", quality: str = "resolution", row: str = "id") -> DataFrame:
    """Exact matches first, then the finer quality (absent ones as 99), then the greater similarity."""
    return df.orderBy(F.desc(F.col(similarity) >= 0.999), F.coalesce(quality, F.lit(99.0)), F.desc(similarity), row)
