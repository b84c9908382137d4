"""Scores against a plain version."""

import math
from collections import Counter

import pytest

from printfold.llm.lm_scoring import MU, NU, score


def plain(rows, target):
    docs = [(i, ["E", *(t or "").encode().split(), "E"], i in target and i is not None) for i, t in rows]
    docs = [(i, w if len(w) > 2 else [], t) for i, w, t in docs]
    count = lambda w: Counter([*w[1:], *zip(w, w[1:])])
    models = {x: sum((count(w) for _, w, t in docs if t == x), Counter()) for x in (True, False)}
    n = {x: sum(len(w) - 1 for _, w, t in docs if t == x and w) for x in models}
    out = []
    for i, w, t in docs:
        losses = []
        for x in (True, False):
            own = count(w) if t == x else Counter()
            c, size = models[x], n[x] - (len(w) - 1 if t == x else 0)
            loss = 0
            for v, u in zip(w, w[1:]):
                p = (models[True][u] + models[False][u]) / sum(n.values())
                one = (c[u] - own[u] + MU * p) / (size + MU)
                loss -= math.log((c[v, u] - own[v, u] + NU * one) / (c[v] - own[v] + NU))
            losses.append(loss / (len(w) - 1) if w else None)
        out.append((i, max(len(w) - 2, 0), *losses))
    return sorted(out, key=str)


def check(df, labels, rows, target):
    got = sorted(((r.doc_id, r.n_words, r.target_loss, r.background_loss, r.score) for r in score(df, labels).collect()), key=str)
    expected = plain(rows, target)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    for g, e in zip(got, expected):
        assert g[2:] == (None,) * 3 if e[2] is None else g[2:] == pytest.approx((e[2], e[3], e[2] - e[3]))


def test_equals_plain_version(spark, make, some_texts, monkeypatch):
    target = {i for i, _ in some_texts if i % 2}
    labels = spark.createDataFrame([(i,) for i in [*target, *target, 10**9, None]], "doc_id long")
    check(make(some_texts), labels, some_texts, target)
    monkeypatch.setattr("printfold.llm.lm_scoring.sizes", lambda docs, *_: (23, 7))
    check(make(some_texts), labels, some_texts, target)


def test_odd_rows(spark, make):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b"), (None, "a b"), (2, None), (3, " "), (4, "a a a a")]
    for wanted in ([1], [], [1, 4]):
        check(make(rows), spark.createDataFrame([(i,) for i in wanted], "doc_id long"), rows, set(wanted))
    assert score(make([]), spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_tells_the_target_from_the_rest(spark, make):
    good = [(i, f"the good text says {i} fine words and is fine") for i in range(30)]
    bad = [(100 + i, f"buy cheap pills now {i} click here now") for i in range(30)]
    got = {r.doc_id: r.score for r in score(make(good + bad), spark.createDataFrame([(i,) for i in range(20)], "doc_id long")).collect()}
    assert max(got[i] for i in range(30)) < min(got[100 + i] for i in range(30))
