"""Fingerprints against a plain version in Python."""

import hashlib
import random

import pytest
import xxhash

from printfold.llm.fingerprints import K, S, SIZE, SLACK, as_text, edit_and_compare

SCHEMA = "doc_id long, text string, lang string, n_chars int"
MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(*parts):
    """Spark's xxhash64: each value is hashed with the hash before as seed."""
    seed = 42
    for p in parts:
        raw = p.encode() if isinstance(p, str) else (p & MASK).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return signed(seed)


def fingerprint(text):
    words = text.encode().split()
    h = [xx(w.decode()) for w in words]
    inner = h
    for i in range(1, S):
        inner = [xx(a, b) for a, b in zip(inner, h[i:])]
    anchors = {}
    for i in range(len(h) - K + 1):
        run = inner[i: i + K - S + 1]
        if min(run) in (run[0], run[-1]):
            anchors.setdefault((xx(*h[i: i + K]) & MASK) >> 32, i)
    if not anchors and h:
        anchors[(xx(*h) & MASK) >> 32] = 0
    return sorted(anchors.items())[:SIZE]


def likeness(a, b):
    if not a or not b:
        return 1.0 if a == b else 0.0
    limit = min(x[-1][0] if len(x) >= SIZE else 1 << 32 for x in (a, b))
    a, b = {h: p for h, p in a if h <= limit}, {h: p for h, p in b if h <= limit}
    moves = sorted(b[h] - p for h, p in a.items() if h in b)
    match = sum(abs(m - moves[len(moves) // 2]) <= SLACK for m in moves)
    return match / (len(a) + len(b) - match)


def plain(rows):
    """Rows of distinct ids, in order."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for n, (i, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        fp = [fingerprint(t) for t in (text, edited, following)]
        shown = [" ".join(f"{h:x}@{p}" for h, p in x) for x in fp[:2]]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), *shown,
                  likeness(fp[0], fp[1]), likeness(fp[0], fp[2]))
    return out


def found(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    return [(r.doc_id, (r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest(), r.a, r.b, r.near_edited, r.near_next))
            for r in edit_and_compare(df).withColumns({"a": as_text("fp"), "b": as_text("edited_fp")}).collect()]


def unhex(rows):
    return {k: v for k, v in rows}


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_equals_plain_version(spark, texts):
    odd = [(-5, None), (-4, ""), (-3, " \t\n"), (-2, "one two"), (-1, "é ü x 😀 a b c d e f"), (None, "first of all texts here"),
           (10**12, "wort " * 3000), (10**12 + 1, "x" * 50_000)]
    rows = texts + odd
    expected, got = plain(rows), found(spark, rows)
    assert len(got) == len(rows)
    for key, value in got:
        assert value == expected[key], key


def test_copies_and_neighbours(spark):
    text = " ".join(f"w{i}" for i in range(300))
    got = unhex(found(spark, [(1, text), (2, text), (3, text[:700] + " other words " * 60)]))
    assert got[1][2] == got[2][2] and got[1][5] == 1.0
    assert 0.2 < got[2][5] < 1 and got[1][4] > 0.25


def test_repeated_rows_and_one_row(spark):
    got = found(spark, [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "other"), (2, "z")])
    assert len(got) == 4 and sum(k == 1 for k, _ in got) == 3
    alone = found(spark, [(1, "a b c d")])
    assert alone[0][1][5] == 1.0


def test_empty_table(spark):
    assert found(spark, []) == []


def words(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


def near_next(spark, first, second):
    return unhex(found(spark, [(1, " ".join(first)), (2, " ".join(second))]))[1][5]


def test_a_passage_keeps_its_anchors_in_long_texts(spark):
    passage, a, b = words(0, 200), words(1, 6000), words(2, 6000)
    rows = [(1, " ".join(a[:3000] + passage + a[3000:])), (2, " ".join(b[:1000] + passage + b[1000:])), (3, " ".join(passage))]
    got = unhex(found(spark, rows))
    one, two, own = ({x.split("@")[0] for x in got[i][2].split()} for i in (1, 2, 3))
    assert len(own) > 70 and own <= one and own <= two and got[1][5] > 0.01


def test_both_sides_of_an_insertion_count(spark):
    text, more = words(1, 2000), words(2, 400)
    assert near_next(spark, text, text[:1000] + more[:20] + text[1000:]) > 0.95
    several = text[:500] + more[:50] + text[500:1200] + more[50:] + text[1200:]
    assert 0.7 < near_next(spark, text, several) < 0.9
    assert near_next(spark, text, text[300:] + text[:300]) > 0.95
    assert near_next(spark, text, words(3, 2000)) == 0
