import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, kind int"


def plain(rows, k, every):
    vectors = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
               if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in vectors:
        if q % every == 0:
            best = {}
            for c, b in vectors:
                if c != q:
                    score = sum(x * y for x, y in zip(a, b, strict=True))
                    best[c] = max(best.get(c, score), score)
            top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
            out |= {(q, r + 1, c, s) for r, (c, s) in enumerate(top)}
    return out


def found(spark, rows, k, every, **options):
    df = spark.createDataFrame([(i, v, 0, "s", 1) for i, v in rows], SCHEMA).repartition(3)
    got = topk.top_k(topk.integer_vectors(df), F.col("vec_id") % every == 0, k, **options).collect()
    out = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got]
    assert len(set(out)) == len(out)
    return set(out)


@pytest.mark.parametrize("options", [{}, {"query_block": 3, "candidate_share": 40, "head": 2}])
def test_equals_brute_force(spark, options, monkeypatch):
    monkeypatch.setattr(topk, "STEP", 16)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) * rng.choice([0.1, 1, 3]) for _ in range(12)]) for i in range(200)]
    rows += [(200 + i, rows[5][1]) for i in range(30)]  # ties
    rows += [(300, [0.0] * 12), (301, None), (302, [None] + [1.0] * 11), (303, [float("nan")] + [1.0] * 11),
             (304, [float("inf")] + [1.0] * 11), (None, [1.0] * 12), (305, []), (5, rows[5][1]), (10, rows[10][1])]
    assert found(spark, rows, 7, 5, **options) == plain(rows, 7, 5)


def test_fewer_than_k_large_numbers_and_empty(spark):
    rows = [(0, [3.0e7, 1.0]), (1, [3.0e7, 2.0]), (2, [-3.0e7, 0.5])]
    assert found(spark, rows, 20, 1) == plain(rows, 20, 1)
    assert found(spark, [], 20, 1) == set() and found(spark, [(1, [1.0])], 20, 1) == set()


def test_pruning_ends_the_search():
    rng = np.random.default_rng(0)
    block = topk._Block(np.array([0]), np.array([[5, 5]]), np.eye(2), 1, 1)
    assert block.meet(np.array([1]), np.array([[100, 100]])) and not block.meet(np.array([2, 3]), rng.integers(-9, 9, (2, 2)))


def test_rotation_is_orthogonal_and_ordered(spark):
    rows = [(i, [float(i % 7), 10.0 * (i % 3), 1.0]) for i in range(50)]
    vectors = topk.integer_vectors(spark.createDataFrame([(i, v, 0, "", 0) for i, v in rows], SCHEMA))
    axes = topk.rotation(vectors, 3)
    m = np.array([[64 * x for x in v] for _, v in rows]) @ axes
    assert np.allclose(axes.T @ axes, np.eye(3)) and (np.diff((m ** 2).sum(axis=0)) <= 1e-6).all()
