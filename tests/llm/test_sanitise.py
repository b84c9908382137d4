"""Personal data against a plain version with Python's re, and the words that give entities away."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from printfold.llm.sanitise import base_spans, joined, sanitise, with_spans

# The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in hit.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def plain(text):
    spans = [(m.start(), n, m.end(), kind) for n, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if valid(kind, m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = df.select("doc_id", joined(base_spans(F.coalesce("text", F.lit("")))).alias("s")).collect()
    for r in got:
        assert r.s == plain(texts[r.doc_id]), texts[r.doc_id]


def test_base_spans_of_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    texts = [r.text for r in rows]
    assert any(plain(t) for t in texts)
    check(spark, texts)


def test_base_spans_at_edges(spark):
    check(spark, [
        None, "", "a@b.c", "a@b.com_c@d.org", "a@b.c..d@e.f", "x@y", "a@b.c@d.e", "@@a@b.c.", "é😀a.b+c@d-e.f é x@y.z",
        "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255 01.002.0003.4", "1.2.3.4", "99999999999999999999999.1.1.1",
        "4111 1111 1111 1111", "4111-1111-1111-1111 5500000000000004", "4111  1111 1111 1111", "+1 (555) 123-4567.",
        "+1234567890123456", "+49 30 1234567 +1 555 0100 22", "+4111111111111111", "0" * 14, "0 " * 14, "1" * 5000,
        "1 " * 5000, "+1" + "-" * 3000 + "2", "a" * 20000 + "@", ("user@host.org " * 400), "4111111111111111" * 2,
        "a@b" + ".c" * 700, "x a@b" + ".cc" * 100_000 + ". b@c.d", "a@b" + ".c" * 501 + "@d.e",
    ])


@pytest.mark.parametrize("seed", range(3))
def test_base_spans_at_random(spark, seed):
    r = random.Random(seed)
    check(spark, ["".join(r.choices("a1.@+- 0(_é4", k=r.randrange(1, 60))) for _ in range(2000)])


def planted():
    """A word that occurs with one address only, in different contexts; and common words."""
    r = random.Random(5)
    common = ["the", "of", "and", "report", "letter", "house", "river", "stone", "cloud", "green"]
    rows = [" ".join(r.choices(common, k=30)) for _ in range(200)]
    for n in range(5):
        rows.append(" ".join(r.choices(common, k=10)) + f" Zorblax wrote boss@corp.example about {common[n]} " + " ".join(r.choices(common, k=10)))
    return [(i, t) for i, t in enumerate(rows)]


def test_words_that_give_an_entity_away(spark):
    df = spark.createDataFrame(planted(), "doc_id long, text string").withColumns(
        {c: F.lit("kept") for c in ("tie", "base", "term", "entity", "_tie", "m")})
    rows = {r.doc_id: r for r in with_spans(df).collect()}
    for i in range(200):
        assert rows[i].base == [] and rows[i].added == []
    for i in range(200, 205):
        words = {m.hit for m in rows[i].added}
        assert {"Zorblax", "wrote", "about"} == words and len(rows[i].base) == 1
    clean = {r.doc_id: r for r in sanitise(df).collect()}
    assert clean[3].text == rows[3].text and clean[3].tie == clean[3].base == clean[202]._tie == "kept"
    assert "[EMAIL]" in clean[202].text and "Zorblax" not in clean[202].text and "corp" not in clean[202].text


def test_copies_give_nothing_away(spark):
    text = "Xanadu office of boss@corp.example near Quimby square"
    rows = [(i, text) for i in range(50)] + [(100 + i, f"plain text number {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.added == [] for r in with_spans(df).collect())


def test_generalised_words_keep_their_shape(spark):
    rows = planted() + [(300 + i, f"Zorblax wrote about nothing {i}") for i in range(8)] + [(400 + i, "Zorblax wrote one text") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert "[Word]" in text[201] and "Zorblax" in text[300]


def test_nulls_repeats_and_empty_table(spark):
    rows = [(1, None), (None, "a@b.cc"), (None, "a@b.cc"), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert df.count() == sanitise(df).count() == with_spans(df).count()
    got = sanitise(df).collect()
    assert sorted("-" if r.text is None else r.text for r in got) == ["", "-", "[EMAIL]", "[EMAIL]"]
    assert with_spans(df.limit(0)).count() == 0


def test_query_digest(spark):
    from printfold.llm.query_pii import op5_pii

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op5_pii(spark, folder).collect():
        expected = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert r.n_email == expected.count("email:") and r.n_phone == expected.count("phone:")


def test_far_short_and_numbered_words_of_two_contexts(spark):
    r = random.Random(7)
    common = [f"common{n}" for n in "abcdefghijklmnop"]
    text = lambda n: " ".join(r.choices(common, k=n))
    rows = [text(40) for _ in range(200)]
    rows += [f"{text(9)} Li {text(9)} agent47 {text(40)} wrote@corp.example {text(9)}" for _ in range(2)]
    near = f"{text(20)} Quimby {text(20)} lone@corp.example {text(9)}"
    rows += [near, near + " common", near + " more"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    added = {x.doc_id: {m.hit for m in x.added} for x in with_spans(df).collect()}
    assert added[200] == added[201] == {"Li", "agent47"}
    assert all(not added[i] for i in (*range(200), 202, 203, 204))


def plain_spans(rows, around=5, support=2, evidence=1.0, generalise=0.7, remove=0.9):
    """The added spans of every text, by counting in plain loops."""
    word = re.compile(r"[^\W_]{2,}")
    def entities(text):
        out = []
        for m, kind in ((m, k) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])):
            digits = re.sub("[^0-9]", "", m[0])
            out.append((m.start(), m.end(), kind, digits if kind in ("card", "phone") else m[0].lower()))
            value = {"email": m[0].lower().split("@")[-1], "ip": ".".join(m[0].split(".")[:3]), "card": digits[:6], "phone": digits[:5]}[kind]
            out.append((m.start(), m.end(), kind + " group", value))
        return out

    def words(text):
        return [w for w in word.findall(text.lower()) if re.search(r"[^\W\d_]", w)]

    texts = sorted({t or "" for t in rows})
    found = {t: entities(t) for t in texts}
    n_term, n_entity, context = {}, {}, {}
    for t in texts:
        for w in set(words(t)):
            n_term[w] = n_term.get(w, 0) + 1
        names = {e[2:] for e in found[t]}
        for e in names:
            n_entity[e] = n_entity.get(e, 0) + 1
        masked, at = "", 0
        for start, end, kind, _ in sorted(e for e in found[t] if " group" not in e[2]):
            if start >= at:
                masked += t[at:start] + "[|]"
            at = max(at, end)
        masked = words(masked + t[at:]) if names else []
        for i, w in enumerate(masked):
            for e in names:
                mine = context.setdefault((e, w), {})
                mine.setdefault(t, []).append(tuple(masked[max(i - around, 0): i + around + 1]))
    n = len(texts)
    telling = {}
    for (e, w), by_text in context.items():
        both, ic = len(by_text), math.log(n / n_entity[e])
        if both < support or ic <= 0:
            continue
        pmi = ic - math.log(max(n_term.get(w, both) / both, 1))
        if both * pmi >= evidence * math.log(n) - 1e-9 and pmi / ic >= generalise - 1e-12:
            # The smallest context is by hash; texts of equal words about agree in any.
            if len({c for cs in by_text.values() for c in cs}) >= support:
                telling[e, w] = pmi / ic
    out = {}
    for t in texts:
        mine = {}
        for e in {x[2:] for x in found[t]}:
            for w in set(words(t)):
                if (e, w) in telling:
                    mine[w] = max(mine.get(w, 0), telling[e, w])
        out[t] = {(m.start(), m.end(), "word" if mine[m[0].lower()] >= remove else "word-shape") for m in word.finditer(t)
                  if m[0].lower() in mine and not any(m.start() < e and s < m.end() for s, e, *_ in found[t])}
    return out


def test_added_spans_equal_plain_counts(spark):
    """Addresses named once under a domain named often; names of people at the domain; copies."""
    r = random.Random(12)
    common = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(6)]
    text = lambda n: " ".join(r.choices(common, k=n))
    rows = [text(r.randrange(10, 60)) for _ in range(300)]
    for n in range(12):
        rows.append(f"{text(12)} Quorvex {text(5)} staff{n}@quorvex.example {text(8)} Harbour {text(4)}")
        rows.append(f"{text(9)} Zenda {text(6)} 10.77.3.{n} {text(7)} router{n}")
        rows.append(f"{text(9)} Ostrava {text(3)} +42 0123 456{n:03d} {text(7)}")
    rows += [f"{text(30)} Harbour {text(9)}" for _ in range(5)] + [rows[300]] * 40 + [None, "", f"{text(6)} lonely@nowhere.example Unique"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    expected = plain_spans(rows)
    got = {x.doc_id: {(m.start, m.end, m.kind) for m in x.added} for x in with_spans(df).collect()}
    for n, t in enumerate(rows):
        assert got[n] == expected[t or ""], t
    planted = {"Quorvex": 0, "Zenda": 0, "Ostrava": 0}
    for x in with_spans(df).where("size(added) > 0").collect():
        for m in x.added:
            planted[m.hit] = planted.get(m.hit, 0) + 1
    assert planted["Quorvex"] == 12 + 40 and planted["Zenda"] == 12 and planted["Ostrava"] == 12 and "Unique" not in planted


def test_chance_pairs_prove_nothing(spark):
    """A word that met a large group in two texts is left alone; one that is always there is not."""
    r = random.Random(2)
    rows = [f"{' '.join(f'w{r.randrange(4000)}' for _ in range(12))} a{n}@big.example" for n in range(400)]
    rows += [" ".join(f"w{r.randrange(4000)}" for _ in range(12)) for _ in range(1600)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    loose = with_spans(df, evidence=0.0).agg(F.sum(F.size("added"))).first()[0]
    assert with_spans(df).agg(F.sum(F.size("added"))).first()[0] < loose / 5
