"""Seeds that lose nothing, and overlaps against brute force."""

import itertools
import random

import pytest

from printfold.llm import decontaminate
from printfold.llm.decontaminate import MASKS, SHORTEST, SUBSTITUTIONS, WINDOW, clean, contaminations, token


def test_masks_miss_no_window():
    for gone in itertools.combinations(range(WINDOW), SUBSTITUTIONS):
        assert any(not {p + at for p in m} & set(gone) for m in MASKS for at in range(WINDOW - m[-1]))


def plain(docs, items):
    out = {}
    tokens = lambda t: [x for x in map(token, (t or "").encode().split()) if x]
    for (d, dt), (b, bt) in itertools.product(docs, items):
        x, y = tokens(dt), tokens(bt)
        n = min(WINDOW, len(y))
        if not y:
            continue
        if len(y) < SHORTEST:
            lines = [tokens(line) for line in (dt or "").split("\n")]
            hits = {(sum(map(len, lines[:i])), n) for i, line in enumerate(lines) if line == y} | ({(0, n)} if x == y else set())
        else:
            hits = [(p, m) for p in range(len(x) - n + 1) for q in range(len(y) - n + 1)
                    if (m := sum(u == v for u, v in zip(x[p: p + n], y[q: q + n]))) >= n - 2 * n // 13]
        if hits:
            old = out.get((d, b), (0, 0, 10**9))
            out[d, b] = max(old[0], len(hits)), max(old[1], max(m for _, m in hits)), min(old[2], min(p for p, _ in hits))
    return out


def planted(seed=2):
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
    text = lambda n: " ".join(r.choices(vocabulary, k=n))
    items = [(i, text(n)) for i, n in enumerate([40, 25, 13, 14, 12, 5, 4, 30, 7, 9, 2, 1])] + [(18, None), (19, ""), (3, text(20))]
    docs = [(i, text(r.randrange(0, 80))) for i in range(40)]
    for n, (_, t) in enumerate(items):
        for changes in range(4):
            w = (t or "").split()
            for at in r.sample(range(len(w)), min(changes, len(w))):
                w[at] = f"changed{at}"
            docs.append((100 + 10 * n + changes, f"{text(9)}. {' '.join(w).upper()}! | {text(7)}"))
    docs += [(700 + n, f"{text(6)}\n {(t or '').title()}! \n\n--\n{text(4)}\n{t}") for n, (_, t) in enumerate(items)]
    docs += [(800 + n, (t or "").replace(" ", "\n")) for n, (_, t) in enumerate(items)]
    return [*docs, docs[-1], (900, None), (901, ""), (902, "?! ..."), (None, items[0][1]), (903, items[0][1] + " " + text(30_000))], items


def test_equals_brute_force(spark, make):
    docs, items = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.windows, r.best, r.first) for r in contaminations(make(docs), bench).collect()}
    short = [d for d in docs if len(d[1] or "") < 5000]
    expected = plain(short, items)
    assert {k: v for k, v in got.items() if k[0] != 903} == expected
    assert got[903, 0][1] == 13 and got[903, 0][2] == 0


def test_parts_of_a_large_benchmark(spark, make, monkeypatch):
    docs, items = planted(4)
    docs = docs[:-1]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in contaminations(make(docs), bench).collect()}
    real = decontaminate.indexes
    monkeypatch.setattr(decontaminate, "indexes", lambda b: real(b, part_tokens=50))
    assert {tuple(r) for r in contaminations(make(docs), bench).collect()} == whole
    dirty = {r[0] for r in whole}
    df = make(docs)
    kept = clean(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect() if r.text) == sorted(
        (i, t) for i, t in docs if i is not None and t and i not in dirty)


@pytest.mark.parametrize("hits", [1, 40])
def test_slices_of_hits_find_the_same(hits, monkeypatch):
    """Items that share a phrase with a document that repeats it."""
    r = random.Random(3)
    items = [f"{' '.join(r.choices('abcdefgh', k=9))} one phrase that all of them share in the end {n}" for n in range(12)]
    docs = [(" ".join(["one phrase that all of them share in the end x"] * 30)).encode(), items[3].encode(), b"", b"a b"]
    index = decontaminate.Index(items)
    whole = [tuple(x) for part in index.find(docs, index.table()) for x in part]
    monkeypatch.setattr(decontaminate, "HITS", hits)
    parts = [part for part in index.find(docs, index.table())]
    assert len(parts) > 3 and sorted(tuple(x) for part in parts for x in part) == sorted(whole)
    assert max(map(len, parts)) < len(whole) / 2


def test_a_long_item_in_segments(spark, make, monkeypatch):
    r = random.Random(5)
    item = [f"v{r.randrange(300)}" for _ in range(900)]
    docs = [(n, " ".join(item[n: n + 40])) for n in range(0, 880, 7)] + [(2000, " ".join(item)), (2000, " ".join(item[:50]))]
    bench = spark.createDataFrame([(1, " - ".join(item)), (2, "v1 v2 v3 v4 v5 v6 v7")], "item_id smallint, text string")
    expected = plain(docs, [(1, " ".join(item)), (2, "v1 v2 v3 v4 v5 v6 v7")])
    monkeypatch.setattr(decontaminate, "SEGMENT", 50)
    got = {(r.doc_id, r.item_id): (r.windows, r.best, r.first) for r in contaminations(make(docs), bench).collect()}
    assert got == expected


@pytest.mark.parametrize("kind", ["smallint", "decimal(9,2)", "date", "double", "struct<a:int>"])
def test_item_ids_of_any_type(spark, make, kind):
    docs, items = planted()
    value = "struct(cast(id as int) as a)" if kind.startswith("struct") else "date_add(date'2020-01-01', id)" if kind == "date" else f"cast(id as {kind})"
    bench = spark.createDataFrame([(7, items[0][1])], "id int, text string").selectExpr(f"{value} as item_id", "text")
    rows = contaminations(make(docs), bench)
    assert rows.schema["item_id"].dataType.simpleString() == kind and rows.count() > 1


def test_empty_tables(spark, make):
    docs, items = planted()
    named = spark.createDataFrame([(f"item {i}", t) for i, t in items], "item_id string, text string")
    assert {r.item_id for r in contaminations(make(docs), named).collect()} >= {"item 0", "item 7"}
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminations(make(docs), none).count() == 0 and clean(make(docs), none).count() == len(docs)
    assert contaminations(make([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0
