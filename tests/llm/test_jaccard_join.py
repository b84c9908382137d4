"""Links and classes against all pairs."""

import math

import numpy as np
import pytest

from printfold.llm import jaccard_join
from printfold.llm.components import components
from printfold.llm.jaccard_join import BANDS, ENOUGH, HASHES, ROWS, STEP, THRESHOLD, TOLERANCE, near_duplicates, one_of_each


def shingles(text):
    w = (text or "").encode().split()
    return {tuple(w[i: i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    link = [[j for j, b in enumerate(sets) if j != i and a and b and len(a & b) * 10 >= 8 * len(a | b)] for i, a in enumerate(sets)]
    group = list(range(len(rows)))
    for _ in rows:
        group = [min([group[i], *(group[j] for j in link[i])]) for i in range(len(rows))]
    ids = {}
    for i, g in enumerate(group):
        if rows[i][0] is not None:
            ids[g] = min(ids.get(g, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], ids.get(group[i]), len(link[i])) for i in range(len(rows))), key=str)


def found(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in near_duplicates(df).collect()), key=str)


def test_equals_all_pairs(make, some_texts):
    assert found(make(some_texts)) == plain(some_texts)


def test_small_blocks_find_the_same(make, some_texts, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 3)
    monkeypatch.setattr(jaccard_join, "SKETCH_ROWS", 3)
    assert found(make(some_texts)) == plain(some_texts)


def test_one_stays_of_each_class(make, some_texts):
    rows = [*some_texts, some_texts[0], some_texts[0]]
    df = make(rows)
    kept = one_of_each(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    classes = plain(some_texts)
    assert sorted(ids) == sorted({c for _, c, _ in classes})


def test_null_ids_and_repeats(make):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(None, a), (None, a), (7, a), (3, a), (3, a), (None, b), (None, b), (9, None), (None, None), (8, "")]
    assert found(make(rows)) == plain(rows)
    kept = sorted(((r.doc_id, r.text) for r in one_of_each(make(rows)).collect()), key=str)
    assert kept == sorted([(3, a), (None, b), (9, None), (None, None), (8, "")], key=str)


def test_empty_table(make):
    assert found(make([])) == [] and one_of_each(make([])).count() == 0


def test_pruning_loses_next_to_nothing():
    for n, enough in ENOUGH.items():
        tail = lambda m: sum(math.comb(n + 1, k) * THRESHOLD**k * (1 - THRESHOLD) ** (n + 1 - k) for k in range(m + 1))
        assert tail(enough) >= TOLERANCE and (enough == 0 or tail(enough - 1) < TOLERANCE)
    r = np.random.default_rng(3)
    lost = 0
    for _ in range(4000):
        same = r.random(HASHES) < THRESHOLD
        lost += any(same[:n].sum() < e for n, e in ENOUGH.items())
    assert lost == 0 and list(ENOUGH) == list(range(STEP, HASHES + 1, STEP))
    assert (1 - THRESHOLD**ROWS) ** BANDS < 1e-7


@pytest.mark.parametrize("edges", [
    [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (9, 8)],
    [(10, i) for i in range(11, 60)] + [(i, i + 100) for i in range(11, 60)],
    [(i, i + 1) for i in range(200)] + [(i, i) for i in range(300, 305)],
    [],
])
def test_components(spark, edges):
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in up:
        for a, b in edges:
            if a != b:
                up[a] = up[b] = min(up[a], up[b])
    assert got == up
