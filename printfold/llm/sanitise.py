"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: e-mail and ip addresses, card and phone numbers. An entity is
taken at two levels, as its whole value and as the group it belongs to (domain, first three numbers of an
address, first six digits of a card, first five of a phone number), so that one named once is judged with
its group. Then the corpus tells which other words give an entity away. For an entity or group e and a
word t anywhere in a text that names it, with numbers of texts n, the disclosure is the pointwise mutual
information of t and e relative to the information content of e:

    pmi(t, e) / ic(e) = 1 - log(n(t) / n(t, e)) / log(N / n(e))

It is 1 when t occurs with e only, and 0 when t is independent of it. Words at or above ``remove`` are
removed in the texts that name e, words at or above ``generalise`` are replaced by their shape; of both
levels the higher disclosure counts. Copies of a text are one text. As a rare word meets a large group by
chance, n(t, e) * pmi(t, e) must be ``evidence`` * log(N) at least: with 1, what it takes to name one text
among all. A pair must be seen in ``support``
texts in which the ``around`` terms on either side of t differ, so that near copies prove nothing away
from where they differ: from one text nothing can be estimated, as all rare words there measure
the same. A word is a run of two or more letters and digits, with a letter.

Defined results: a null text is empty; spans of one kind never overlap; base spans stay whatever the
method finds, and a word span that touches one is not added; repeated rows each get their spans; an
empty table gives no rows; other columns are kept by ``sanitise``.

Base patterns are written for Java so that no long run of characters is retried or recursed over.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from printfold.llm.bits import maybe_among
from printfold.session import in_files, work_dir

FILE_TEXTS, FILE_KEYS = 2_000, 50_000  # whole texts, or numbers, in a file
KINDS = ("email", "ip", "card", "phone")
WORD = "word"
AROUND, SUPPORT, EVIDENCE, GENERALISE, REMOVE = 5, 2, 1.0, 0.7, 0.9

# Where a run of the first class begins, or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A whole chain of digits with single separators, of 14 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"(?<![\p{L}\p{N}])(?=\p{N}*+\p{L})[\p{L}\p{N}]{2,}+"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    from_right = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    values = F.transform(F.filter(from_right, lambda d: d.isNotNull()), lambda d, i: F.when(i % 2 == 0, d).otherwise(
        d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid_ip(text: Column) -> Column:
    return F.forall(F.split(text, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))


def _valid_phone(text: Column) -> Column:
    return F.length(_digits(text)).between(10, 15)


def _matches(text: Column, pattern, can: Column, valid=None) -> Column:
    """array<struct<start,end,hit>> of a pattern's valid matches, in code points.

    The text is parted at the matches; positions add up from the lengths of parts and matches.
    """
    if isinstance(pattern, str):
        pattern = F.lit(pattern)
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    parts, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.zip_with(F.transform(F.slice(parts, 1, F.size(hits)), lambda p: F.char_length(p)), hits,
                       lambda n, h: F.struct(n.alias("gap"), h.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + F.char_length(x["hit"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), x["hit"].alias("hit")))).alias("out"))

    found = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    if valid:
        found = F.filter(found, lambda m: valid(m["hit"]))
    return F.when(can, found).otherwise(none)


def base_spans(text: Column) -> Column:
    """array<struct<start,end,kind,hit>> of personal data, by start, then kind as listed."""
    digit = text.rlike("[0-9]")
    found = (
        _matches(text, EMAIL, F.contains(text, F.lit("@"))),
        _matches(text, IP, digit & text.rlike(r"[0-9]\.[0-9]"), _valid_ip),
        _matches(text, CARD, digit & text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), lambda h: luhn(_digits(h))),
        _matches(text, PHONE, F.contains(text, F.lit("+")), _valid_phone),
    )
    tagged = [_tag(m, i) for i, m in enumerate(found)]
    return F.transform(F.sort_array(F.concat(*tagged)), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"),
        F.element_at(F.array(*map(F.lit, KINDS)), m["nth"] + 1).alias("kind"), m["hit"].alias("hit")))


def _tag(matches: Column, nth: int) -> Column:
    return F.transform(matches, lambda m: F.struct(
        m["start"].alias("start"), F.lit(nth).alias("nth"), m["end"].alias("end"), m["hit"].alias("hit")))


def entity(kind: Column, hit: Column) -> Column:
    """One name for every spelling of an entity."""
    plain = F.when(kind.isin("card", "phone"), _digits(hit)).otherwise(F.lower(hit))
    return F.xxhash64(kind, plain)


def group(kind: Column, hit: Column) -> Column:
    """The name of what an entity belongs to."""
    value = (F.when(kind == "email", F.lower(F.element_at(F.split(hit, "@"), -1)))
             .when(kind == "ip", F.substring_index(hit, ".", 3))
             .when(kind == "card", F.substring(_digits(hit), 1, 6)).otherwise(F.substring(_digits(hit), 1, 5)))
    return F.xxhash64(F.concat(kind, F.lit(" group")), value)


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def with_key(docs: DataFrame) -> DataFrame:
    """(id, tie, text): rows of equal id and text share a key, and so their spans."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("_text", text).withColumn("_tie", F.xxhash64("_text")).withColumn(
        "_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))


def mentions(keyed: DataFrame) -> DataFrame:
    """(_id, _tie, _text, _base, entities) of the rows that name any; entities are of both levels, each once."""
    rows = keyed.select("_id", "_tie", "_text").withColumn("_base", base_spans(F.col("_text"))).where(F.size("_base") > 0)
    levels = F.flatten(F.transform("_base", lambda m: F.array(entity(m["kind"], m["hit"]), group(m["kind"], m["hit"]))))
    return rows.withColumn("entities", F.array_distinct(levels))


def term_contexts(found: DataFrame, around=AROUND) -> DataFrame:
    """(_tie, entities, terms) of every text that names any, once: its terms, each with its smallest context.

    A text is parted once, whatever it names. Sorted terms are written, so that repeats lie beside each other.
    """
    spark = found.sparkSession
    texts = found.groupBy("_tie").agg(*[F.first(c).alias(c) for c in ("_text", "_base", "entities")])
    masked = F.transform("_base", lambda m: m.withField("kind", F.lit("|")))
    context = lambda t, i: F.struct(t.alias("term"), F.xxhash64(F.slice(
        "_all", F.greatest(i - around, F.lit(0)) + 1, F.least(i, F.lit(around)) + around + 1)).alias("context"))
    terms = texts.select("_tie", "entities", terms_of(redact(F.col("_text"), masked)).alias("_all"))
    rows = _written(spark, in_files(terms, found.count(), FILE_TEXTS))
    rows = _written(spark, rows.select("_tie", "entities", F.sort_array(F.transform("_all", context)).alias("_all")))
    first = F.filter("_all", lambda t, i: (i == 0) | (t["term"] != F.get("_all", i - 1)["term"]))
    return rows.select("_tie", "entities", first.alias("terms"))


def distinct_texts(keyed: DataFrame) -> DataFrame:
    """(_text) of every distinct text. Only texts that may be there several times are shuffled."""
    repeated = keyed.groupBy("_tie").count().where("count > 1").select("_tie")
    repeated = _written(keyed.sparkSession, in_files(repeated, keyed.count(), FILE_KEYS))
    several = maybe_among(repeated, "_tie")
    once = keyed.where(several).groupBy("_tie").agg(F.first("_text").alias("_text"))
    return keyed.where(~several).select("_text").unionByName(once.select("_text"))


def disclosing(keyed: DataFrame, contexts: DataFrame, support=SUPPORT, evidence=EVIDENCE, generalise=GENERALISE) -> DataFrame:
    """(entity, term, disclosure) at or above ``generalise``, from counts over all texts."""
    spark = keyed.sparkSession
    named = contexts.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    # One named in fewer texts than are needed cannot qualify, so its words are not counted.
    often = named.where(F.col("n_entity") >= support)
    known = contexts.select("_tie", F.explode("entities").alias("entity")).join(often, "entity").groupBy("_tie").agg(
        F.collect_list(F.struct("entity", "n_entity")).alias("entities"))
    total = keyed.select("_tie").distinct().count()
    n_term = distinct_texts(keyed).select(F.explode(F.array_distinct(terms_of(F.col("_text")))).alias("term")).groupBy("term").agg(
        F.count("*").alias("n_term"))
    # At most n(e) texts have both, so words with more texts than this cannot reach the least disclosure.
    most = lambda n: n * F.pow(total / n, F.lit(1.0 - generalise)) + 0.5
    bound = _written(spark, in_files(known, contexts.count(), FILE_KEYS)).select(F.explode("entities").alias("e")).agg(F.max(most(F.col("e.n_entity")))).first()[0]
    words = contexts.join(known.withColumnRenamed("entities", "known"), "_tie").select("known", F.explode("terms").alias("t"))
    words = words.select("known", "t.term", "t.context").join(n_term.where(F.col("n_term") <= (bound or 0)), "term")
    pairs = words.select("term", "context", "n_term", F.explode("known").alias("e")).where(F.col("n_term") <= most(F.col("e.n_entity")))
    both = pairs.groupBy("e.entity", "e.n_entity", "term", "n_term").agg(
        F.count_distinct("context").alias("contexts"), F.count("*").alias("n_both")).where(F.col("contexts") >= support)
    ic = F.log(total / F.col("n_entity"))
    pmi = ic - F.log(F.greatest(F.col("n_term") / F.col("n_both"), F.lit(1.0)))
    return (
        both.where(F.lit(total) > F.col("n_entity")).where(F.col("n_both") * pmi >= evidence * F.log(F.lit(total)))
        .select("entity", "term", (pmi / ic).alias("disclosure")).where(F.col("disclosure") >= generalise)
    )


def with_spans(docs: DataFrame, around=AROUND, support=SUPPORT, evidence=EVIDENCE, generalise=GENERALISE, remove=REMOVE) -> DataFrame:
    """Rows of ``docs`` with ``base`` and ``added`` spans (start, end, kind, hit) in place of columns so named."""
    spark = docs.sparkSession
    keyed = with_key(docs)
    found = _written(spark, mentions(keyed))
    contexts = _written(spark, term_contexts(found, around))
    told = disclosing(keyed, contexts, support, evidence, generalise)
    telling = _written(spark, in_files(told, contexts.count(), FILE_KEYS, moved=True))
    own = contexts.select("_tie", "entities", F.explode("terms.term").alias("term"))
    told = own.join(telling, "term").where(F.array_contains("entities", F.col("entity"))).groupBy("_tie").agg(
        F.collect_set("term").alias("_terms"),
        F.collect_set(F.when(F.col("disclosure") >= remove, F.col("term"))).alias("_removed"))
    spans = found.groupBy("_id", "_tie").agg(F.first("_base").alias("base")).join(told, "_tie", "left")
    rows = keyed.drop("base", "_terms", "_removed").join(spans, ["_id", "_tie"], "left")
    none = F.array().cast(spans.schema["base"].dataType)
    rows = rows.withColumn("base", F.coalesce("base", none))
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.reverse(F.sort_array("_terms")), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    hits = _matches(F.col("_text"), pattern, F.col("_terms").isNotNull())
    free = F.filter(hits, lambda h: ~F.exists("base", lambda b: (h["start"] < b["end"]) & (b["start"] < h["end"])))
    removed = lambda h: F.array_contains("_removed", F.lower(h["hit"]))
    added = F.transform(free, lambda h: F.struct(
        h["start"].alias("start"), h["end"].alias("end"),
        F.when(removed(h), F.lit(WORD)).otherwise(F.lit(f"{WORD}-shape")).alias("kind"), h["hit"].alias("hit")))
    rows = in_files(rows.withColumn("added", added), keyed.count(), FILE_TEXTS)
    return rows.drop("_id", "_tie", "_terms", "_removed")


def _written(spark, df: DataFrame) -> DataFrame:
    path = work_dir(spark, "sanitise")
    df.write.parquet(path)
    return spark.read.parquet(path)


def shape(word: Column) -> Column:
    """A word generalised to its letter case."""
    return F.when(F.initcap(word) == word, "[Word]").when(F.upper(word) == word, "[WORD]").otherwise("[word]")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced; spans that overlap are replaced as one, by the first's label."""
    label = lambda m: F.when(m["kind"] == WORD, "").when(
        m["kind"] == f"{WORD}-shape", shape(m["hit"])).otherwise(F.concat(F.lit("["), F.upper(m["kind"]), F.lit("]")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, m):
        gap = F.substr(text, acc["at"] + 1, F.greatest(m["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], m["end"]).alias("at"), F.when(
            m["start"] >= acc["at"], F.concat(acc["out"], F.array(gap, label(m)))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1)))


def sanitise(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with its text sanitised; other columns stay, whatever their names, null texts too."""
    rows = with_spans(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")), **settings)
    everything = F.sort_array(F.concat("base", "added"))
    clean = F.when(F.size(everything) > 0, redact(F.col("_text"), everything)).otherwise(F.col("text"))
    return rows.select(*[clean.alias(c) if c == "text" else F.col(f"_row.{c}").alias(c) for c in docs.columns])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(
        ":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")


def in_order(base: Column, added: Column) -> Column:
    """Base and added spans by start; base kinds come first at one place."""
    order = F.array(*map(F.lit, (*KINDS, WORD, f"{WORD}-shape")))
    keyed = F.transform(F.concat(base, added), lambda m: F.struct(
        m["start"].alias("start"), F.array_position(order, m["kind"]).alias("nth"), m["end"].alias("end"), m["kind"].alias("kind")))
    return F.sort_array(keyed)
