"""Removed windows against a plain version."""

import pytest

from printfold.llm.substring_dedup import WORDS, dedup


def plain(rows, n=WORDS):
    """Kept text, counts and longest repeat by brute force; ids are compared, null first."""
    order = lambda i: -1 if i is None else i
    words = [(order(i), (t or "").encode().split()) for i, t in rows]
    out, size, longest = [], n, [0] * len(rows)
    firsts = None
    while any(len(w) >= size for _, w in words):
        seen = {}
        for i, w in words:
            for p in range(len(w) - size + 1):
                seen.setdefault(tuple(w[p: p + size]), set()).add(i)
        firsts = firsts or {k: min(v) for k, v in seen.items()}
        for x, (i, w) in enumerate(words):
            if any(len(seen[tuple(w[p: p + size])]) > 1 for p in range(len(w) - size + 1)):
                longest[x] = size
        size *= 2
    for x, (i, w) in enumerate(words):
        gone = {q for p in range(len(w) - n + 1) if firsts[tuple(w[p: p + n])] < i for q in range(p, p + n)}
        out.append((rows[x][0], len(w), len(gone), longest[x], b" ".join(a for q, a in enumerate(w) if q not in gone).decode()))
    return sorted(out, key=str)


def found(df, **settings):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.longest, r.text) for r in dedup(df, **settings).collect()), key=str)


def test_equals_plain_version(make, some_texts):
    assert found(make(some_texts)) == plain(some_texts)


@pytest.mark.parametrize("words", [1, 2, 5, 40])
def test_other_windows(make, some_texts, words):
    rows = some_texts[:40]
    assert found(make(rows), words=words) == plain(rows, words)


def test_many_chunks_and_buckets(make, some_texts, monkeypatch):
    monkeypatch.setattr("printfold.llm.substring_dedup.sizes", lambda docs, *_: (37, 11))
    assert found(make(some_texts)) == plain(some_texts)


def test_null_ids_and_repeated_rows(make, some_texts):
    text = some_texts[0][1] + " " + some_texts[1][1]
    rows = [(None, text), (None, text), (None, "a " * 20), (1, text), (1, text), (1, "b " * 20), (2, "b " * 20), (2, "a " * 20)]
    assert found(make(rows)) == plain(rows)


def test_nothing(make):
    assert found(make([])) == []
    assert found(make([(1, None)])) == [(1, 0, 0, 0, "")]
