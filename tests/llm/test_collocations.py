"""Phrases against plain counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from printfold.llm.collocations import collocations, frequent

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least, limit=2000):
    """What the operator is to return, from (lang, text)."""
    f = {}
    for lang, text in docs:
        count = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            count.update(" ".join(w[i:j]) for i in range(len(w)) for j in range(i + 1, min(i + 5, len(w)) + 1))
    out = []
    for lang, count in f.items():
        n = sum(c for p, c in count.items() if " " not in p)
        whole = {p: c for p, c in count.items() if " " in p and c >= least}
        rows = []
        for phrase, a in whole.items():
            if any(c >= a and f" {phrase} " in f" {p} " and p != phrase for p, c in whole.items()):
                continue
            w = phrase.split(" ")
            cuts = [(count[" ".join(w[:k])], count[" ".join(w[k:])]) for k in range(1, len(w))]
            score, _, left, right = min((1000 * a * n // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
            rows.append((-score, -a, phrase.encode(), phrase, left, right))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(rows)[:limit], 1):
            out.append((lang, rank, phrase, -a, left, right, n, -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.fixture(scope="module")
def docs():
    """Texts of few words, with a line and a pair that a third of all words are in, and odd ones."""
    r = random.Random(3)
    words = ["the", "The", "of", "Straße", "ÉTÉ", "été", "x-1", "\x1cq", "日本", "a\x00b", *(f"w{i}" for i in range(8))]
    def text(n):
        return "".join(r.choice(words) + r.choice([" "] * 20 + ["  ", "\t", ", ", ".", "\n", "?! ", "\r\n"]) for _ in range(n))
    rows = [(r.choice(["en", "en", "de", None, "und"]), text(r.randrange(60))) for _ in range(250)]
    rows += [("en", "hot pair " + text(8)) for _ in range(90)] + [("en", "one hot line of six words")] * 60
    rows += [("de", text(4000)), ("fr", "solo"), ("fr", None), (None, ""), ("fr", " .,\t"), ("es", "a " * 300), ("it", "a.b." * 40), ("", "no name " * 12)]
    for _ in range(60):
        sentence = [r.choice(words) for _ in range(7)]
        rows += [("en", " ".join(sentence[r.randrange(3):r.randrange(3, 8)])) for _ in range(20)]
    r.shuffle(rows)
    return rows


def table(spark, rows):
    types = "lang string, text string, words int, phrase string, f long, n long, bucket string, rank int"
    return spark.createDataFrame([(*row, 1, "p", 2, 3, "b", 4) for row in rows], types)


@pytest.mark.parametrize("size", [{}, {"small_bucket": 64, "large_bucket": 400}, {"small_bucket": 200, "large_bucket": 200}])
def test_equals_plain_counts(spark, docs, size):
    expected = plain(docs, 9)
    assert len(expected) > 300 and {len(e[2].split(" ")) for e in expected} == {2, 3, 4, 5}
    assert found(collocations(table(spark, docs).repartition(6), 9, **size)) == expected


def test_first_ones_only(spark, docs):
    assert found(collocations(table(spark, docs), 9, limit=20)) == plain(docs, 9, 20)


@pytest.mark.parametrize("few", [[], [(None, None)], [("en", "x y")], [("en", "x y " * 3)]])
def test_few_rows(spark, few):
    assert found(collocations(table(spark, few), 2)) == plain(few, 2)


def test_a_long_text_in_pieces(spark):
    text = "alpha beta gamma delta " * 120_000 + "end"
    assert found(collocations(table(spark, [("en", text)]), 100)) == plain([("en", text)], 100)


def test_quicksort_counts_every_beginning():
    r = np.random.default_rng(2)
    rows = np.minimum(r.geometric(0.4, (2000, 5)), 9)
    for k in range(2, 5):
        rows[rows[:, k - 1] == 0, k] = 0
        rows[r.random(2000) < 0.2, k:] = 0
    weights = r.integers(1, 4, 2000)
    expected = Counter()
    for row, weight in zip(rows.tolist(), weights.tolist()):
        for k in range(2, 6):
            if 0 not in row[:k]:
                expected[tuple(row[:k])] += weight
    got = {tuple(rows[at, :length].tolist()): count for at, length, count in frequent(list(rows.T), weights, 2, 30)}
    assert got == {p: c for p, c in expected.items() if c >= 30}
