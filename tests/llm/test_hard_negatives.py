"""Hard negatives against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from printfold.llm import hard_negatives as h
from printfold.llm.hard_negatives import hard_negatives


def plain(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """What the operator is to return, from (vec_id, label, vector)."""
    valid = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
             if i is not None and label is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor, label, a in {(i, label, tuple(v)) for i, label, v in valid if is_anchor(i)}:
        scored = sorted(((-sum(x * y for x, y in zip(a, v)), i, other) for i, other, v in valid), key=lambda s: s[:2])
        near = [(i, -s) for s, i, other in scored if other == label and i != anchor][:positives]
        for positive, p in near:
            band = [(i, -s) for s, i, other in scored if other != label and low * p <= 100 * -s <= high * p]
            out += [(anchor, positive, n, i, p, s) for n, (i, s) in enumerate(band[:negatives], 1)]
    return sorted(out)


def found(df):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    """Vectors of several kinds: copies, ties, other lengths, large, null and not finite ones."""
    r = np.random.default_rng(5)
    out = [(i, int(r.integers(3)), r.normal(size=19).tolist()) for i in range(200)]
    out += [(i, i % 3, (np.round(r.normal(size=19)) / 4).tolist()) for i in range(200, 300)]
    out += [(i, i % 3, out[7][2]) for i in range(300, 320)]  # one vector many times
    out += [out[3], out[3], out[10], out[10]]  # repeated rows, one of them an anchor
    out += [(400, 1, []), (401, 1, [1.0]), (402, 2, r.normal(size=40).tolist()), (403, 0, [900.0] * 19), (410, 0, [-900.5] * 19)]
    out += [(None, 1, out[0][2]), (500, None, out[0][2]), (510, 1, None), (520, 1, [None] * 19), (530, 1, [1.0, None]),
            (540, 1, [float("nan")] * 19), (550, 1, [1.0, float("inf")]), (560, 2, [0.0] * 19)]
    r.shuffle(out)
    return [(None if i is None else int(i), label, v) for i, label, v in out]


TYPES = "vec_id long, label int, embedding array<double>, rank string, anchor int, score double, list string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "r", 1, 2.0, "l") for row in rows], TYPES)


@pytest.mark.parametrize("a_round", [65_536, 7])
def test_equals_plain_loops(spark, rows, a_round):
    got = hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, anchors_a_round=a_round)
    expected = plain(rows, lambda i: i % 10 == 0)
    assert len(expected) > 500 and found(got) == expected


def test_other_bands_and_numbers(spark, rows):
    got = hard_negatives(table(spark, rows).repartition(5), F.col("vec_id") < 30, positives=2, negatives=3, low=-50, high=120)
    assert found(got) == plain(rows, lambda i: i < 30, 2, 3, -50, 120)


@pytest.mark.parametrize("few", [[], [(0, 1, [1.0])], [(0, 1, [1.0]), (1, 2, [1.0])], [(0, None, None)]])
def test_few_rows(spark, few):
    assert found(hard_negatives(table(spark, few), F.col("vec_id") % 10 == 0)) == plain(few, lambda i: i % 10 == 0)


def test_tables_give_inner_products():
    r = np.random.default_rng(1)
    for size, most in ((1, 1), (8, 200), (19, 3), (64, 70_000)):
        rows = r.integers(-most, most + 1, (50, size))
        anchors = np.zeros((9, 8 * h.groups_of(size)), np.int64)
        anchors[:, :size] = r.integers(-most, most + 1, (9, size))
        packed = [p.tobytes() for p in h.planes(rows)]
        got = h.scores(h.tables(anchors), h.unpacked(packed, np.full(50, h.groups_of(size)), anchors.shape[1] // 8))
        assert (got == rows @ anchors[:, :size].T).all()


def test_too_large_scores_fail(spark):
    huge = [(i, i % 2, [3e15, 1.0]) for i in range(4)]
    with pytest.raises(Exception, match="62 bits"):
        hard_negatives(table(spark, huge), F.col("vec_id") == 0).collect()
