"""Pool-adjacent-violators without gathering the scores: the convex minorant by ranges.

The isotonic fit of sums over sorted scores is the slope of the greatest convex minorant of their
cumulative sums, a lower convex hull. Scores are dealt into sorted ranges, and each range reduces
its points to its own lower hull (the stack of pooled blocks) in one pass; a point off its range's
hull is on no larger one. Of the whole hull, a range holds one unbroken stretch of its own, so
only the bridges between ranges are unknown. They are found for all ranges together: the driver
keeps the hull of a few vertices of each range, asks in one pass over the stored stacks for the
lowest vertex under every unproven bridge, adds those, and stops when none lies below. What the
driver holds grows with the number of ranges and passes, not with the scores.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.session import materialize

_STACK = "range int, w double, s double, x double, after double"
#: Vertices compared with all asked slopes at once.
ROWS = 4096


def lower_hull(w: list, s: list) -> list[int]:
    """Places of the lower convex hull of points sorted by w."""
    kept: list[int] = []
    for i in range(len(w)):
        while len(kept) > 1:
            a, b = kept[-2], kept[-1]
            if (s[b] - s[a]) * (w[i] - w[b]) < (s[i] - s[b]) * (w[b] - w[a]):
                break
            kept.pop()
        kept.append(i)
    return kept


def _stacks(batches):
    """The lower hull of one range's cumulative sums: rows (range, w, s, x, the score after x)."""
    from pyspark import TaskContext
    columns: list[list] = [[], [], [], []]
    w_all = s_all = 0.0
    w, s, x, after = columns
    for batch in batches:
        score, total, weight = (np.asarray(batch.column(c)) for c in ("_x", "_s", "_w"))
        w_cum, s_cum = w_all + np.cumsum(weight), s_all + np.cumsum(total)
        if x and after[-1] is None and len(score):
            after[-1] = float(score[0])
        for i, (a, b) in enumerate(zip(w_cum.tolist(), s_cum.tolist())):
            while len(w) > 1 and (s[-1] - s[-2]) * (a - w[-1]) >= (b - s[-1]) * (w[-1] - w[-2]):
                for c in columns:
                    c.pop()
            w.append(a)
            s.append(b)
            x.append(float(score[i]))
            after.append(float(score[i + 1]) if i + 1 < len(score) else None)
        if len(score):
            w_all, s_all = float(w_cum[-1]), float(s_cum[-1])
    if x:
        here = np.full(len(x), TaskContext.get().partitionId(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(here), *(pa.array(c, pa.float64()) for c in columns)],
                                         names=["range", "w", "s", "x", "after"])


def _lowest(slopes: np.ndarray, offsets: dict):
    """For every slope m the vertex of the batches with the least s - m w, over the whole sums."""
    def find(batches):
        best = np.full(len(slopes), np.inf)
        at = np.zeros((len(slopes), 3))
        for batch in batches:
            here = np.asarray(batch.column("range"))
            shift = np.array([offsets[r] for r in here.tolist()]).reshape(-1, 2)
            w, s = (np.asarray(batch.column(c)) + shift[:, j] for j, c in enumerate(("w", "s")))
            for k in range(0, len(w), ROWS):
                value = s[k:k + ROWS, None] - w[k:k + ROWS, None] * slopes
                low = value.argmin(0)
                found = value[low, np.arange(len(slopes))]
                nearer = found < best
                best[nearer] = found[nearer]
                at[nearer] = np.stack([here[k + low], w[k + low], s[k + low]], 1)[nearer]
        told = np.flatnonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays(
            [pa.array(told.astype(np.int32)), pa.array(best[told]), *(pa.array(at[told, j]) for j in range(3))],
            names=["asked", "value", "range", "w", "s"])
    return find


def blocks(sums: DataFrame, ranges: int | None = None) -> DataFrame:
    """Pooled blocks ``(lo, hi, value, weight)`` of an isotonic fit, rising with the scores.

    sums: one row per distinct score ``_x`` with the weighted sum of labels ``_s`` and the weight
    ``_w`` (above 0). A block covers the scores lo..hi and has their weighted mean as its value."""
    spark = sums.sparkSession
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    stacks = materialize(sums.select("_x", F.col("_s").cast("double").alias("_s"), F.col("_w").cast("double").alias("_w"))
                         .repartitionByRange(ranges, "_x").sortWithinPartitions("_x").mapInArrow(_stacks, _STACK), "stacks")
    ends = sorted(stacks.groupBy("range").agg(
        F.min(F.struct("w", "s", "x")).alias("first"), F.max(F.struct("w", "s", "x")).alias("last")).collect(),
        key=lambda r: r["range"])
    if not ends:
        return spark.createDataFrame([], "lo double, hi double, value double, weight double")
    offsets, start, w, s = {}, {}, 0.0, 0.0
    hull = {(-1, 0.0, 0.0)}
    for r in ends:
        offsets[r["range"]], start[r["range"]] = (w, s), r["first"]["x"]
        for end in (r["first"], r["last"]):
            hull.add((r["range"], w + end["w"], s + end["s"]))
        w, s = w + r["last"]["w"], s + r["last"]["s"]
    proven: set[tuple] = set()
    while True:
        points = sorted(hull, key=lambda p: p[1])
        points = [points[i] for i in lower_hull([p[1] for p in points], [p[2] for p in points])]
        asked = [(a, b) for a, b in zip(points, points[1:]) if a[0] != b[0] and (a, b) not in proven]
        if not asked:
            break
        slopes = np.array([(b[2] - a[2]) / (b[1] - a[1]) for a, b in asked])
        found = (stacks.select("range", "w", "s").mapInArrow(_lowest(slopes, offsets), "asked int, value double, range double, w double, s double")
                 .groupBy("asked").agg(F.min(F.struct("value", "w", "s", "range")).alias("v")).collect())
        for r in found:
            (a, b), v = asked[r["asked"]], r["v"]
            vertex = (int(v["range"]), v["w"], v["s"])
            if vertex in hull or not v["value"] < a[2] - slopes[r["asked"]] * a[1]:
                proven.add((a, b))
            else:
                hull.add(vertex)
    # Of every range: where the whole hull enters and leaves it, and what comes after.
    order = [r["range"] for r in ends]
    following = {r: start[n] for r, n in zip([-1, *order], order)}
    plan = []
    for r in dict.fromkeys(p[0] for p in points):
        own = [p for p in points if p[0] == r]
        later = points[points.index(own[-1]) + 1] if points[-1] != own[-1] else None
        plan.append((r, *offsets.get(r, (0.0, 0.0)), own[0][1], own[-1][1], following.get(r), *(later[1:] if later else (None, None))))
    plan = spark.createDataFrame(plan, "range int, ow double, os double, enters double, leaves double, following double, lw double, ls double")
    origin = spark.createDataFrame([(-1, 0.0, 0.0, None, None)], _STACK)
    # One row per range at most: a broadcast of bounded size.
    whole = (stacks.unionByName(origin).join(F.broadcast(plan), "range").withColumn("w", F.col("w") + F.col("ow"))
             .withColumn("s", F.col("s") + F.col("os")).where("w >= enters and w <= leaves"))
    along = Window.partitionBy("range").orderBy("w")
    ended = whole.select(
        "w", "s", F.coalesce("after", "following").alias("lo"), F.coalesce(F.lead("w").over(along), "lw").alias("to_w"),
        F.coalesce(F.lead("s").over(along), "ls").alias("to_s")).where("to_w is not null")
    last = whole.select(F.col("w").alias("to_w"), F.col("x").alias("hi"))
    return ended.join(last, "to_w").select("lo", "hi", ((F.col("to_s") - F.col("s")) / (F.col("to_w") - F.col("w"))).alias("value"),
                                           (F.col("to_w") - F.col("w")).alias("weight"))
