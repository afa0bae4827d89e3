import math
import random

from pyspark.sql import functions as F

from pulsegrid.llm.metric_tree import TreeSettings, top_k

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    import numpy as np

    cut = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
           if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in cut:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in cut if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumn("row", F.lit("x")).withColumn("score", F.lit(1))
    return sorted(tuple(r) for r in top_k(frame, TreeSettings(**settings)).collect())


def test_equals_all_products(spark):
    draw = random.Random(5)
    centres = [[draw.gauss(0, 0.3) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + draw.gauss(0, 0.05) for c in draw.choice(centres)]) for i in range(700)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, tree_rows=64, page_rows=8, block_rows=4, routing=4) == brute(rows)


def test_one_vector_many_times(spark):
    rows = [(i, [0.5, 0.25, -0.125]) for i in range(300)] + [(i, [0.1 * (i % 7), 0.2, 0.3]) for i in range(300, 400)]
    assert found(spark, rows, tree_rows=32, page_rows=8) == brute(rows)


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []),
            (50, [0.5, 0.5]), (51, [0.0, -1.0]), (None, [9.0, 9.0]), (100, [1.0, 2.0, 3.0])]
    assert found(spark, rows) == brute(rows)


def test_few_and_no_rows(spark):
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(0, [1.0]), (7, [0.5])]) == [(0, 1, 7, 256 * 128)]
    assert found(spark, [(1, None)]) == []


def test_large_components_take_part(spark):
    draw = random.Random(8)
    rows = [(i, [draw.choice([-1, 1]) * 2.0 ** draw.randint(-4, 20), draw.random(), 2.0 ** draw.randint(0, 21)]) for i in range(200)]
    assert found(spark, rows, tree_rows=32, page_rows=4) == brute(rows)
    assert found(spark, [(0, [2.0**30, 1.0]), (1, [2.0**30, 0.0]), (2, [2.0**30, 3.0]), (3, [-(2.0**100), 0.0])]) == [
        (0, 1, 1, 2**63 - 1), (0, 2, 2, 2**63 - 1), (0, 3, 3, -(2**63) + 2)]


def test_the_longest_vector_and_its_copies(spark):
    draw = random.Random(9)
    top = [0.9, 0.8, 0.7, 0.6]
    rows = [(i, top if i % 3 == 0 else [draw.gauss(0, 0.2) for _ in top]) for i in range(400)]
    assert found(spark, rows, tree_rows=64, page_rows=4) == brute(rows)
