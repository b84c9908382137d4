"""SuperMinHash groups against all pairs."""

import random
import re

import numpy as np
import pytest

from printfold.llm import super_minhash as s
from printfold.llm.super_minhash import near_duplicates
from printfold.llm.words import hash_table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """(doc_id, n_shingles, component_id, kept) of every row, from (doc_id, text)."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i:i + 2]) for i in range(max(len(w) - 1, 1))} if w else set())
    up = list(range(len(rows)))
    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = {}
    for n, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(n)] = min(doc, least.get(root(n), doc))
    named = [least.get(root(n)) for n in range(len(rows))]
    return sorted(((doc, len(sets[n]), named[n], doc == named[n]) for n, (doc, _) in enumerate(rows)), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_equals_all_pairs(spark, make, some_texts):
    r = random.Random(4)
    rows = list(some_texts)
    base = [f"b{i}" for i in range(60)]
    for n in range(120):  # a group whose members drift apart, linked in chains
        for _ in range(r.randrange(4)):
            base[r.randrange(60)] = f"c{n}"
        rows.append((6000 + n, " ".join(base)))
    rows += [(6200 + n, f"Tiny {n % 5}") for n in range(20)] + [(6300, "TINY 3"), (6300, "TINY 3"), (6301, "solo"), (6302, "SOLO"), (6303, "Été été"), (6304, "été ÉTÉ")]
    rows += [(6400 + n, " ".join(f"t{i + n % 2}" for i in range(10))) for n in range(4)]  # 8 of 10 pairs: on the line
    r.shuffle(rows)
    expected = plain(rows)
    assert sum(not k for *_, k in expected) > 100
    assert found(near_duplicates(make(rows).repartition(7))) == expected


@pytest.mark.parametrize("size", [1, 3])
def test_small_blocks_find_the_same(spark, make, monkeypatch, size):
    """Hubs do not settle this group: many members are linked with some others but not with the first."""
    r = random.Random(9)
    words = [f"v{i}" for i in range(80)]
    rows = []
    for n in range(60):
        mine = list(words)
        for _ in range(r.randrange(2, 8)):
            mine[r.randrange(80)] = f"x{n}-{r.random()}"
        rows.append((n, " ".join(mine)))
    monkeypatch.setattr(s, "BLOCK_ROWS", size)
    monkeypatch.setattr(s, "SKETCH_ROWS", size)
    assert found(near_duplicates(make(rows))) == plain(rows)


@pytest.mark.parametrize("few", [[], [(1, None)], [(1, ""), (2, "")], [(1, "a"), (None, "a")], [(None, "a b"), (None, "a b")]])
def test_few_rows(spark, make, few):
    got = found(near_duplicates(make(few)))
    if few and all(i is None for i, _ in few):
        assert [(i, n, c) for i, n, c, _ in got] == [(None, 1, None)] * 2
    else:
        assert got == plain(few)


def test_registers_estimate_likeness_with_less_variance():
    r = np.random.default_rng(7)
    table, off, independent = hash_table(), [], []
    for n in range(300):
        words = [f"{n}-{i}" for i in range(150)]
        a, b = " ".join(words[:120]), " ".join(words[30:])
        one, two = (s.shingles(t.encode(), table) for t in (a, b))
        true = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
        x, y = s.signatures([one, two])
        off.append((x == y).mean() - true)
        independent.append(true * (1 - true) / s.REGISTERS)
    assert abs(np.mean(off)) < 0.01
    assert np.var(off) < np.mean(independent)


def test_signatures_equal_a_plain_version():
    """The stop leaves nothing out: every element's whole permutation gives the same registers."""
    r = np.random.default_rng(8)
    sets = [np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 2, 40, 700)]
    for one, got in zip(sets, s.signatures(sets)):
        best = [1 << 64] * s.REGISTERS
        for element in one:
            order = list(range(s.REGISTERS))
            for rank in range(s.REGISTERS):
                draw = int(s.scrambled(np.array([element]) + s.STEPS[rank])[0])
                pick = rank + ((draw >> 32) * (s.REGISTERS - rank) >> 32)
                order[rank], order[pick] = order[pick], order[rank]
                best[order[rank]] = min(best[order[rank]], rank << 32 | draw & 0xFFFFFFFF)
        assert got.tolist() == best
