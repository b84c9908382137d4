"""Stages of the pipeline, each against a plain version over its own input, and queries against SQL."""

import re
import zlib

import pytest
from oracle import connect, difference
from pyspark.sql import functions as F
from test_decontaminate import plain as plain_overlaps
from test_jaccard_join import plain as plain_classes
from test_sanitise import PATTERNS, valid

import corpus_pipeline as pipeline
from printfold import session
from printfold.llm.jaccard_join import one_of_each
from printfold.llm.queries import QUERIES, SQL
from printfold.llm.sanitise import sanitise

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, db, name):
    assert difference(QUERIES[name](spark, FOLDER), db, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_returns_a_row_for_each(spark, name):
    table = "pages" if name.startswith("op6_") else "documents"
    assert QUERIES[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


@pytest.fixture(scope="module")
def raw(spark):
    """The small documents with odd rows."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    odd = [(90001, None, "en", "src1", 0), (90002, "", "en", "src1", 0), (90003, "12 34 !", None, None, None),
           (90004, first.text, None, None, None), (None, first.text, "en", "src0", 1), (90005, "call +1 555 010 0000 or a@b.example now the of", "en", "src0", 1),
           (90006, "the of and " * 20_000, "en", "src0", 1)]
    odd += [odd[5], odd[5]]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema)).cache()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def redacted(text):
    spans = sorted((m.start(), m.end(), kind) for kind, p in PATTERNS.items() for m in re.finditer(p, text) if valid(kind, m[0]))
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_language_keeps_what_has_one(spark, raw):
    kept = pipeline.language(spark, raw, FOLDER)
    assert kept.columns == raw.columns
    gone = {r.doc_id for r in raw.collect()} - {r.doc_id for r in kept.collect()}
    assert gone == {90001, 90002, 90003}


def test_one_of_each_class_stays(spark, raw):
    rows = [(r.doc_id, r.text) for r in raw.where("doc_id is not null").collect()]
    kept = pipeline.near_duplicates(spark, raw.where("doc_id is not null"), FOLDER)
    assert kept.columns == raw.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in plain_classes(rows)})


def test_overlapping_documents_go(spark, raw):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in raw.where("length(text) < 1200 or text is null").collect()]
    dirty = {d for d, _ in plain_overlaps(rows, items)}
    short = raw.where("length(text) < 1200 or text is null")
    kept = rows_of(pipeline.decontamination(spark, short, FOLDER))
    assert dirty and kept == [r for r in rows_of(short) if r[0] not in dirty]


def test_personal_data_goes(spark, raw):
    before = rows_of(raw)
    after = rows_of(pipeline.personal_data(spark, raw, FOLDER))
    plain = sorted(((i, t if t is None else redacted(t), lang, source, None if n is None else len(redacted(t)) if t is not None else None)
                    for i, t, lang, source, n in before), key=str)
    assert after == plain


def test_mixture_keeps_the_tokens(spark, raw):
    out = pipeline.mixing(spark, raw, FOLDER)
    words = raw.agg(F.sum(F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")))).first()[0]
    taken = out.agg(F.sum(F.col("epochs") * F.col("n_tokens") + F.col("extra_tokens"))).first()[0]
    assert abs(taken - words / 2) < 100 and out.count() == out.select("doc_id", "text").distinct().count()


def test_stages_follow_each_other(spark):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "pii", "mixing"]
    out = pipeline.run(spark, FOLDER)
    assert out.count() > 0 and set(pipeline.mixing(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER).columns) == set(out.columns)


@pytest.mark.parametrize("stage", range(5))
def test_empty_documents(spark, raw, stage):
    assert pipeline.STAGES[stage][1](spark, raw.limit(0), FOLDER).count() == 0


def test_language_learns_from_every_label(spark, raw):
    text = "жили были дед и баба у самого синего моря " * 8
    ids = [i for i in range(95000, 95100) if zlib.crc32(str(i).encode()) % 4 == 2][:3]
    rare = spark.createDataFrame([(i, text, "ru", "src0", len(text)) for i in ids], raw.schema)
    kept = pipeline.language(spark, raw.unionByName(rare), FOLDER)
    assert {r.doc_id for r in kept.where("lang = 'ru'").collect()} == set(ids)


def test_files_follow_the_rows(spark, make, tmp_path, monkeypatch):
    # Shuffles of many partitions must not leave a file for each of them.
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "kept"))
    texts = [" ".join(f"w{(7 * i + k) % 40}" for k in range(20)) + f" a{i % 30}@b{i % 5}.example" for i in range(300)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:50]])]
    docs = make(rows)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    try:
        for n, value in zip(names, ("40", "false")):
            spark.conf.set(n, value)
        few = [one_of_each(docs), sanitise(docs)]
        for n, kept in enumerate(few):
            kept.write.parquet(str(tmp_path / f"kept/out-{n}"))
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)
    files = {f.name: len(list(f.glob("part-*"))) for f in (tmp_path / "kept").iterdir()}
    assert files and max(files.values()) <= max(session.LEAST_FILES, docs.rdd.getNumPartitions()), files
