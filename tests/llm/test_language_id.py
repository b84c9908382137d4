"""Held-out accuracy, mixtures, and rows that have no language."""

import math
import random
import zlib

import numpy as np
import pytest

from printfold.llm.language_id import ROUNDS, SETTLED, UNKNOWN, Likelihoods, _results, identify, keep_identified, learn, proportions, train
from printfold.llm.query_language import op2_language_id

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op2_language_id(spark, FOLDER).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_mixture_and_odd_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = learn(docs)
    first = {lang: docs.where(f"lang = '{lang}' and n_chars > 2000").first().text for lang in ("en", "de")}
    half = " ".join(first["en"].split()[:150] + first["de"].split()[:50])
    odd = [(1, half), (2, None), (3, ""), (4, "123 !? — …"), (5, first["de"]), (6, first["de"]), (None, first["en"].upper()),
           (8, "x"), (9, first["en"] * 200)]
    df = spark.createDataFrame([(i, t, "clash", 9.0) for i, t in odd], "doc_id long, text string, lang_pred string, score double")
    got = {}
    for r in identify(df, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    shares = dict(x.split(":") for x in got[1][0].languages.split(","))
    assert got[1][0].lang_pred == "en" and abs(float(shares["de"]) - 0.25) < 0.1
    assert all(got[i][0].lang_pred == UNKNOWN and got[i][0].score == 0 for i in (2, 3, 4))
    assert got[5][0].lang_pred == "de" == got[6][0].lang_pred and got[5][0].score == got[6][0].score > 0.9
    assert got[None][0].lang_pred == "en" and got[9][0].lang_pred == "en" and got[8][0].lang_pred != UNKNOWN
    kept = keep_identified(docs.select("doc_id", "text"), model)
    assert kept.count() == docs.count() and kept.columns == ["doc_id", "text"]


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([("some text", None), (None, "en")], "text string, lang string")
    model = train(rows)
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    got = identify(df, model).first()
    assert identify(df.limit(0), model).count() == 0
    assert got.lang_pred in (UNKNOWN, "en")
    nothing = train(rows.limit(0))
    assert identify(df, nothing).first().lang_pred == UNKNOWN


def test_penalty_selects_one_language_for_plain_texts():
    r = np.random.default_rng(0)
    like = np.where(r.random((400, 3)) < 0.3, 1.0, 1e-4).astype(np.float32)
    like[:, 0] = 1
    share = proportions(like, np.array([400]))
    assert share[0, 0] == 1 and share[0, 1:].sum() == 0


def test_only_known_languages_are_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars > 500")
    model = train(docs.where("lang <> 'de'").select("text", "lang"))
    r = random.Random(4)
    mash = [" ".join("".join(r.choices(letters, k=r.randrange(3, 9))) for _ in range(80)) for letters in ("abcdefghijklmnopqrstuvwxyz", "абвгдежз")]
    known = {lang: docs.where(f"lang = '{lang}'").first().text.split()[:60] for lang in ("en", "es", "fr")}
    even = " ".join(w for words in known.values() for w in words)
    new = spark.createDataFrame([(-1, mash[0]), (-2, mash[1]), (-3, even), (-4, "12 3")], "doc_id long, text string")
    kept = {x.doc_id for x in keep_identified(docs.select("doc_id", "text").union(new), model).collect()}
    rows = docs.collect()
    german = {x.doc_id for x in rows if x.lang == "de"}
    assert kept & {-1, -2, -3, -4} == {-3} and {x.doc_id for x in rows} - german <= kept
    assert len(german & kept) < 0.05 * len(german)


def test_even_mixture_of_four_languages_is_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars > 1000")
    parts = [docs.where(f"lang = '{lang}'").first().text.split()[:60] for lang in ("en", "de", "es", "fr")]
    df = spark.createDataFrame([(1, " ".join(sum(parts, [])))], "doc_id long, text string")
    assert keep_identified(df, learn(docs)).count() == 1


def plain_proportions(like, counts):
    """The mixture of one document, word by word."""
    def maximise(share):
        before = -math.inf
        for n in range(ROUNDS + 1):
            total = [sum(p * x for p, x in zip(share, row)) for row in like]
            now = sum(c * math.log(t) for c, t in zip(counts, total))
            if now - before < SETTLED or sum(p > 0 for p in share) < 2 or n == ROUNDS:
                return share, now
            share = [sum(c * p * row[j] / t for c, row, t in zip(counts, like, total)) / sum(counts) for j, p in enumerate(share)]
            before = now

    share, fit = maximise([1 / len(like[0])] * len(like[0]))
    while sum(p > 0 for p in share) > 1:
        smallest = -min((p, -j) for j, p in enumerate(share) if p > 0)[1]
        fewer = [0 if j == smallest else p for j, p in enumerate(share)]
        fewer, less = maximise([p / sum(fewer) for p in fewer])
        if less + 0.5 * math.log(max(sum(counts), 2)) < fit:
            break
        share, fit = fewer, less
    return share


def test_mixtures_equal_plain_loops():
    r = np.random.default_rng(4)
    sizes = np.array([1, 3, 40, 200, 80, 60])
    like = np.exp(-6 * r.random((sizes.sum(), 5))).astype(np.float32)
    like[44:244, 2] *= 20  # mostly one language
    like[244:284, 0] *= 30  # two halves
    like[284:324, 3] *= 30
    counts = r.integers(1, 5, sizes.sum())
    got = proportions(like, sizes, counts)
    at = 0
    for n, size in enumerate(sizes):
        expected = plain_proportions(like[at: at + size].astype(float).tolist(), counts[at: at + size].tolist())
        assert [p > 0 for p in expected] == (got[n] > 0).tolist()
        assert np.abs(got[n] - expected).max() < 1e-3
        at += size
    assert got[3].argmax() == 2 and sorted(np.flatnonzero(got[4]).tolist()) == [0, 3]


def many_languages(r, n):
    """Texts in made-up languages, each with letters of its own preference."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for lang in range(n):
        own = r.sample(letters, 6)
        words = ["".join(r.choices(own, k=r.randrange(3, 8))) for _ in range(40)]
        rows += [(f"l{lang:03d}", " ".join(r.choices(words, k=60))) for _ in range(3)]
    return rows


@pytest.mark.parametrize("group", [256, 40])
def test_languages_in_groups(spark, group):
    """Three hundred languages, more than a group holds; a mixture may span groups."""
    rows = many_languages(random.Random(3), 300)
    df = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "doc_id long, lang string, text string")
    model = train(df, group)
    assert sum(len(names) for names, _ in model) == 300 and len(model) == -(-300 // group)
    got = {r.doc_id: r for r in identify(df, model).collect()}
    assert sum(got[n].lang_pred == lang for n, (lang, _) in enumerate(rows)) >= 0.99 * len(rows)
    half = spark.createDataFrame([(1, f"{rows[0][1]} {rows[-1][1]}"), (2, ""), (3, None), (4, "Ж" * 9)], "doc_id long, text string")
    mixed = {r.doc_id: r for r in identify(half, model).collect()}
    assert {x.split(":")[0] for x in mixed[1].languages.split(",")} == {"l000", "l299"}
    assert mixed[2].lang_pred == mixed[3].lang_pred == UNKNOWN and mixed[2].score == 0
    kept = {r.doc_id for r in keep_identified(df.select("doc_id", "text").union(half), model).collect()}
    one = {r.doc_id for r in keep_identified(df.select("doc_id", "text").union(half), train(df, 1000)).collect()}
    assert kept == one and len(kept) > 0.99 * len(rows)


def test_ties_go_to_the_first_language(spark):
    rows = spark.createDataFrame([("some words here", "b"), ("some words here", "a"), ("some words here", "c")], "text string, lang string")
    got = identify(spark.createDataFrame([(1, "words here some")], "doc_id long, text string"), train(rows)).first()
    assert got.lang_pred == "a"


def test_a_text_is_judged_in_the_languages_of_its_mixture(spark):
    first = {"a": "some words here and there ", "b": "ganz andere sachen stehen dort "}
    rows = spark.createDataFrame([(t * 50, lang) for lang, t in first.items()], "text string, lang string")
    ((names, shared),) = train(rows)
    usual = {name: x for name, x in zip(names, zip(*shared.value[1:]))}
    judged = lambda texts, usual: _results([t.encode() for t in texts], names, Likelihoods(shared.value[0]), None, True, usual)
    texts = [first["a"], "zzqx kkjw vvpq " * 20, first["a"] + first["b"], "1 2"]
    assert judged(texts, usual) == [True, False, True, False]
    # A language that the mixture has not selected tells nothing.
    assert judged([first["a"]], usual | {"b": (0.0, 1e9)}) == [True] and judged([first["a"]], usual | {"a": (1e3, 0.0)}) == [False]
