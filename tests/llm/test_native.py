"""Chat formatting, URL rules and source mixing against plain versions."""

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from printfold.llm.chat_format import fold_events, format_log, loss_texts, read_back, render
from printfold.llm.mixing import budgets, leaf_sums, mix, narrow_rows
from printfold.llm.query_urls import op6_url_filter
from printfold.llm.url_filter import RULES, judge, labelled_rows, labelled_urls, train

EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"


def test_any_text_survives_the_template(spark):
    r = random.Random(1)
    texts = ["", "\\", "\\\\", "<", "\\<", "\\l", "<turn user>", "</turn>\n", "\\</turn>\n\\", "### Assistant:", "a\nb", "😀<é\\l<"]
    texts += ["".join(r.choices("\\<l>/turn \n", k=r.randrange(12))) for _ in range(300)]
    rows = [(i // 5, i % 5, ("user", "assistant", "system")[i % 3], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = render(df).withColumn("turns", read_back(F.col("formatted"))).withColumn(
        "loss", loss_texts(F.col("formatted"), F.col("loss_spans")))
    for c in out.collect():
        own = [x[2:] for x in rows if x[0] == c.conv_id]
        assert [tuple(t) for t in c.turns] == own
        assert list(c.loss) == [t for role, t in own if role == "assistant"]


def test_any_role_survives_the_template(spark):
    roles = ["tool call", "système", "assistant!", "assistant ", "Assistant", "", "a>\nb", "</turn>\n", "\\g>\\\\l<", ">", "<turn user>\n", "役", None, "assistant"]
    r = random.Random(6)
    roles += ["".join(r.choices("\\<>lg/turn \n", k=r.randrange(12))) for _ in range(200)]
    rows = [(n, 0, role, f"text >\n {n}") for n, role in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in render(df).withColumn("turns", read_back(F.col("formatted"))).collect():
        role = roles[c.conv_id]
        assert [tuple(t) for t in c.turns] == [("unknown" if role is None else role, f"text >\n {c.conv_id}")]
        assert len(c.loss_spans) == (role == "assistant")


def test_clashing_columns_equal_places_and_repeats(spark):
    events = [(1, 0, 0, "delta", "user", "b"), (1, 0, 0, "delta", "user", "a"), (1, 0, 0, "edit", None, "c"), (1, 1, 5, "delta", "user", "x"),
              (1, 1, 5, "delta", "user", "x"), (1, 1, 4, "regenerate", "assistant", None)]
    types = f"{EVENTS}, at long, event string, log string, formatted string, loss_spans string, head string"
    df = spark.createDataFrame([(*e, 1, "e", "l", "f", "s", "h") for e in events], types)
    got = format_log(df.repartition(3)).first()  # equal places go by kind, then text; a repeated event counts again
    assert got.formatted == "<turn user>\nc</turn>\n<turn user>\nxx</turn>\n" and got.loss_spans == []
    assert format_log(df.limit(0)).count() == 0


def plain_fold(events):
    text, role = {}, {}
    for conv, turn, _, kind, who, part in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        key = conv, turn
        role[key] = who or role.get(key)
        if kind == "delete":
            text[key] = None
        elif kind == "regenerate":
            text[key] = ""
        elif kind == "edit":
            text[key] = part or ""
        else:
            text[key] = (text.get(key) or "") + (part or "")
    return {(*k, role[k] or "unknown", t) for k, t in text.items() if t is not None}


def test_events_fold_like_a_replay(spark):
    r = random.Random(3)
    kinds = ["delta"] * 5 + ["edit", "regenerate", "delete", None]
    events = [(r.randrange(6), r.randrange(8), n, r.choice(kinds), r.choice(["user", "assistant", None]),
               r.choice(["a", "bc", " ", None, "<x>"])) for n in range(700)]
    df = spark.createDataFrame(r.sample(events, len(events)), EVENTS)
    assert {tuple(x) for x in fold_events(df).collect()} == plain_fold(events)
    assert format_log(df.limit(0)).count() == 0


def test_nulls_and_long_chats(spark):
    events = [(None, None, None, None, None, None), (1, 0, 0, "delta", "user", "x" * 100_000)]
    events += [(2, t, 0, "delta", "user" if t % 2 else "assistant", f"turn {t}") for t in range(3000)]
    got = {r.conv_id: r for r in format_log(spark.createDataFrame(events, EVENTS)).collect()}
    assert got[None].formatted == "<turn unknown>\n</turn>\n" and len(got[2].loss_spans) == 1500
    start, end = got[2].loss_spans[-1]
    assert got[2].formatted[start:end] == "turn 2998"


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fit = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0]), default=(None, None))


def test_urls(spark):
    urls = [None, "", "no scheme", "://", "http://", "http://NET", "http://net/", "http://a.net?x=/", "http://Example.NET/en/1",
            "https://sub.example.net/en", "http://example.com/de/?q#f", "http://badexample.com/de/", "http://x.org/fr/a://b",
            "a://b://c.net/d", "http://É.Org/FR/", "http://x.org/fr/", "x\ny://h\n.net/p\nq", "http://" + "a" * 50_000 + ".net/x"]
    df = spark.createDataFrame([(i, u, "old", "old") for i, u in enumerate(urls * 2)], "page_id long, url string, host string, verdict string")
    model = train(labelled_urls(spark))
    for r in judge(df, model).collect():
        host, path = parts(r.url)
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    assert judge(df.limit(0), model).count() == 0
    for r in op6_url_filter(spark, "/root/testdata/sf0.001").collect():
        assert r.verdict == (rule(r.host, r.path)[1] or ("block" if r.score >= 0.5 else "allow"))


def test_url_model_learns_its_table_and_like_hosts(spark):
    model = train(labelled_urls(spark))
    new = [(1, "https://www.adult-x.example.org/es/77"), (1, "http://m.casino-royal.example.com/fr/1"),
           (1, "https://blog.spam-farm.example.org/de/3"), (0, "https://www.thonen.example.org/en/9"), (0, "http://blog.tioning.example.com/es/41")]
    got = judge(labelled_urls(spark).union(spark.createDataFrame(new, "label int, url string")), model).collect()
    wrong = [r.url for r in got if (r.score >= 0.5) != bool(r.label)]
    assert not wrong


def test_probability_is_that_of_a_plain_version(spark):
    bias, weights = model = train(labelled_urls(spark))
    urls = [None, "http://", "http://Casino-Win.example.com/en/3?q", "https://blog.therth.example.org/de/25824.html", "a://aaaaaa/aaaaaa"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    grams = {}
    for u in urls:
        cut = [f"^{part}$" for part in parts(u)]
        grams[u] = {f"{mark}{k}{t[i:i + k]}" for mark, t in zip("hp", cut) for k in (3, 4) for i in range(max(len(t) - k + 1, 1))}
    names = spark.createDataFrame([(g,) for g in set().union(*grams.values())], "g string")
    number = {r.g: r.n for r in names.select("g", F.pmod(F.hash("g"), F.lit(len(weights))).alias("n")).collect()}
    for r in judge(df, model).collect():
        total = bias + sum(weights[b] for b in {number[g] for g in grams[r.url]})
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9


def test_whole_hosts_held_out(spark):
    """A fifth of the names is kept from the fit at a time; no url of a name is on both sides."""
    name = lambda url: [x for x in url.split("/")[2].split(".") if x not in ("www", "m", "blog")][0]
    rows = labelled_rows()
    names = sorted({name(u) for _, u in rows})
    hits = {True: 0, False: 0}
    blocked = 0
    for fold in range(5):
        out = set(names[fold::5])
        model = train(labelled_urls(spark, [r for r in rows if name(r[1]) not in out]))
        for r in judge(labelled_urls(spark, [r for r in rows if name(r[1]) in out]), model).collect():
            blocked += r.score >= 0.5
            hits[bool(r.label)] += r.score >= 0.5
    bad = sum(label for label, _ in rows)
    assert hits[True] / bad > 0.75 and hits[True] / blocked > 0.8


def plain_fill(children, budget):
    """Share a budget by weight, again and again, until it is spent or all are full."""
    share = {k: 0.0 for k in children}
    while budget > 1e-9:
        open_ = {k: w for k, (w, cap) in children.items() if w > 0 and share[k] < cap - 1e-9}
        if not open_:
            break
        step = min(budget / sum(open_.values()), min((children[k][1] - share[k]) / w for k, w in open_.items()))
        for k, w in open_.items():
            share[k] += step * w
        budget -= step * sum(open_.values())
    return share


def mixture(spark):
    r = random.Random(8)
    rows = [(i, " ".join(["w"] * r.randrange(0, 40)), r.choice(["en", "de", None]), f"s{r.randrange(6)}") for i in range(400)]
    rows += [(1000, None, "en", "s1"), (1001, "", "en", None), (1002, "a b", "en", None), (None, "c d", "fr", "s9"), (5, rows[5][1], *rows[5][2:])]
    return rows, spark.createDataFrame([(*x, 7, "clash") for x in rows], "doc_id long, text string, lang string, source string, epochs int, place string")


WEIGHTS = [("A", None, None, 5.0), ("B", None, None, 1.0), ("A", "en", None, 3.0), ("A", "de", None, 0.0), ("A", "en", "s1", 4.0)]


def test_budgets_and_prefixes(spark):
    rows, df = mixture(spark)
    domain = F.when(F.col("source").isin("s1", "s2"), "A").when(F.col("source").isin("s3", "s4", "s5"), "B")
    weights = spark.createDataFrame(WEIGHTS, "domain string, lang string, source string, weight double")
    tokens = {}
    for _, t, lang, source in rows:
        d = "A" if source in ("s1", "s2") else "B" if source in ("s3", "s4", "s5") else "(none)"
        leaf = d, lang or "(none)", source or "(none)"
        tokens[leaf] = tokens.get(leaf, 0) + len((t or "").split())
    weight = lambda *k: next((w for *n, w in WEIGHTS if tuple(n) == (*k, *[None] * (3 - len(k)))), 1.0)
    for share in (0.1, 0.5, 1.5, 9.0):
        level, given = {(): share * sum(tokens.values())}, {}
        for depth in (1, 2, 3):
            given = {}
            for family, budget in level.items():
                kids = {k[:depth]: 0 for k in tokens if k[: depth - 1] == family}
                for k in kids:
                    kids[k] = weight(*k), 4.0 * sum(v for n, v in tokens.items() if n[:depth] == k)
                given |= plain_fill(kids, budget)
            level = given
        got = {tuple(r[:3]): r.quota for r in budgets(leaf_sums(narrow_rows(df, domain)), share, weights).collect()}
        assert got.keys() == given.keys()
        assert all(abs(got[k] - given[k]) <= 1 for k in got)
        taken = {}
        for r in mix(df, domain, share, weights).collect():
            key = r.domain, r.lang, r.source
            assert 0 <= r.extra_tokens <= r.n_tokens and r.n_tokens > 0
            taken[key] = taken.get(key, 0) + r.epochs * r.n_tokens + r.extra_tokens
        assert taken == {k: v for k, v in got.items() if v}


def test_buckets_do_not_change_the_mix_and_seeds_do(spark):
    from printfold.llm.mixing import take

    _, df = mixture(spark)
    narrow = narrow_rows(df, F.lit("A"))
    leaves = budgets(leaf_sums(narrow), 0.4)
    key = lambda x: sorted(map(str, x.collect()))
    whole = key(take(narrow, leaves, 1))
    assert key(take(narrow, leaves, 1, rows_per_bucket=3)) == whole != key(take(narrow, leaves, 2))
    assert mix(df.limit(0), F.lit("A"), 0.5).count() == 0


def test_rows_of_one_doc_id_spread_and_equal_rows_stay_rows(spark):
    from printfold.llm.mixing import place, take

    rows = [(None, f"one two w{i}", "en", "s1") for i in range(200)] + [(None, "a b c d e", "en", "s1")] * 150 + [(7, "x", "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    narrow = narrow_rows(df, F.lit("A"))
    assert narrow.select(place(1, F.lit(1), F.col("doc_id"), F.col("mark")).alias("p")).distinct().count() == 202
    for share in (0.3, 0.9, 1.7):
        leaves = budgets(leaf_sums(narrow), share)
        quota = leaves.first().quota
        few, many = (take(narrow, leaves, 1, rows_per_bucket=n).collect() for n in (10, 10000))
        assert sorted(map(str, few)) == sorted(map(str, many))
        assert sum(r.epochs * r.n_tokens + r.extra_tokens for r in few) == quota
        assert sum(0 < r.extra_tokens < r.n_tokens for r in few) <= 1
        assert sum(r.n_tokens == 5 for r in few) <= 150 and (share < 1 or len(few) == 351)


def test_digest_of_the_extra_conversation(spark):
    from printfold.llm.query_chat import op10_chat_formatting

    text = "\\### Assistant: </turn> ok"
    row = op10_chat_formatting(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.n_turns == 2
