"""Phrases whose words keep company, counted by a three-way quicksort of suffix pointers.

A text is pieces (cut at ``.,;:!?`` and line ends) of words (runs without space and tab), A-Z lower-cased.
Phrases have up to ``LONGEST`` words of one piece; everything is per language.

1. One pass counts words, and finds hot beginnings: two to four words that so many suffixes start with
   that one task should not take them all.
2. A second pass routes every suffix, as its first five words, by its first two words, or by as many as it
   takes to leave the hot beginnings. Equal suffixes of a section of text go as one with their number, in
   packed rows of words and codes. Hot beginnings themselves are counted where they are seen and go as
   sums.
3. A bucket has all suffixes of its beginnings. Multikey quicksort parts their pointers by one word into
   smaller, equal and greater ones; the equal part's size is the count of a phrase, and is parted again by
   the next word. Parts with fewer suffixes than a phrase needs are abandoned.
4. Joins with the counts of both sides of every cut give scores, in decimals of 38 digits.

Which beginnings are hot decides where suffixes go, never what is counted.

Defined results: a null text is empty; a null language is ``und``, together with documents that say so; a
text without words counts nothing; repeated rows count as often as they are there; ties go by score, count
and phrase (in bytes); an empty table gives no rows; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from printfold.llm.chunks import bucket_of, parts
from printfold.llm.words import pieces, slices, texts
from printfold.session import drop_dir, work_dir

LONGEST, LEAST, FIRST = 5, 100, 2000
SECTION = 1 << 20  # words of a language that are packed together
SMALL_BUCKET, LARGE_BUCKET = 1 << 19, 1 << 22  # suffixes
PART_BYTES = 4 << 20  # of texts taken up at once
LOCAL = 16  # suffixes of a section that may make a hot beginning
RANKED = 200_000  # phrases of a language ranked in one task

# What parts pieces and words, and the letters that are lower-cased.
CUTS = b".,;:!?\x0b\x0c\r"
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + CUTS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(CUTS))
END, NONE = 0, -1  # codes of a cut and of the nothing between two blanks


class Codes(dict):
    """Codes of words in order of appearance."""

    def __init__(self):
        super().__init__({b"\n": END, b"": NONE})
        self.words = [b""]

    def __missing__(self, word):
        code = self[word] = len(self.words)
        self.words.append(word)
        return code


class Section:
    """Words of one language, as codes."""

    def __init__(self):
        self.codes, self.held, self.size = Codes(), [], 0

    def add(self, text: bytes):
        for piece in pieces(text):
            found = piece.translate(FOLD).replace(b"\n", b" \n ").split(b" ")
            found = np.fromiter(map(self.codes.__getitem__, found), np.int32, len(found))
            self.held.append(found[found != NONE])
            self.size += len(self.held[-1])
        self.held.append(np.zeros(1, np.int32))

    def suffixes(self):
        """The first words from every place that has two in its piece, zeros after a piece's end."""
        codes = np.concatenate([*self.held, np.zeros(LONGEST, np.int32)])
        at = np.lib.stride_tricks.sliding_window_view(codes, LONGEST)
        for start in range(0, len(at), SECTION):
            part = at[start: start + SECTION]
            part = part[(part[:, 0] != END) & (part[:, 1] != END)]
            for k in range(2, LONGEST):
                part[part[:, k - 1] == END, k] = END
            yield part

    def counts(self):
        return np.bincount(np.concatenate(self.held), minlength=len(self.codes.words))

    def phrase(self, codes) -> bytes:
        return b" ".join(self.codes.words[c] for c in codes)


def sections(batches):
    """(lang, Section) of the documents of a task, each flushed once it is full."""
    held = {}
    for batch in (part for whole in batches for part in slices(whole, "text", PART_BYTES)):
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, texts(batch.column("text"))):
            section = held.setdefault(lang, Section())
            section.add(text)
            if section.size >= SECTION:
                yield lang, held.pop(lang)
        if sum(s.size for s in held.values()) >= 2 * SECTION:
            yield from held.items()
            held = {}
    yield from held.items()


def pairs(left, right):
    return left.astype(np.int64) << 32 | right


# --- 1. words and hot beginnings --------------------------------------------------------------

COUNTS = "lang string, words int, phrase string, f long"


def _count(batches):
    for lang, section in sections(batches):
        counts = section.counts()
        seen = np.flatnonzero(counts[1:]) + 1
        found = [(1, section.codes.words[c], counts[c]) for c in seen]
        for part in section.suffixes():
            for length, begin, count in beginnings(part):
                found += [(length, section.phrase(b), c) for b, c in zip(begin, count)]
        for start in range(0, len(found), 100_000):
            length, phrase, count = zip(*found[start: start + 100_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(length), pa.string()), pa.array(length, pa.int32()),
                 pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(count, pa.int64())],
                names=["lang", "words", "phrase", "f"])


def beginnings(part):
    """(length, beginnings, counts) of those that ``LOCAL`` suffixes or more start with."""
    rows, key = part, pairs(part[:, 0], part[:, 1])
    for length in range(2, LONGEST):
        distinct, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        full = count >= LOCAL
        yield length, rows[first[full], :length].tolist(), count[full].tolist()
        if length == LONGEST - 1:
            return
        stay = full[inverse] & (rows[:, length] != END)
        rows, key = rows[stay], pairs(inverse[stay], rows[stay, length])


# --- 2. routing -------------------------------------------------------------------------------

CELLS = "bucket int, lang string, depth int, words binary, codes binary, counts binary"


def hashed(hashes, rows, depth, lang):
    """A number of the first ``depth`` words of every row."""
    total = np.full(len(rows), xxhash.xxh3_64_intdigest(lang, seed=depth), np.uint64)
    for k in range(depth):
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[rows[:, k]]
    return total


def equal_ones(rows):
    """Distinct rows in order, and how often each is there."""
    order = np.lexsort((rows[:, 4], pairs(rows[:, 2], rows[:, 3]), pairs(rows[:, 0], rows[:, 1])))
    rows = rows[order]
    new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])) if len(rows) else order
    return rows[new], np.diff(np.append(new, len(rows)))


def depths(section, rows, hot):
    """The number of words that route each row, and the rows of every hot beginning: (beginning, rows)."""
    depth = np.full(len(rows), 2)
    at, key, found = np.arange(len(rows)), pairs(rows[:, 0], rows[:, 1]), []
    above = {}
    for length in range(2, LONGEST):
        known = {}
        for begin in hot.get(length, ()):
            codes = [section.codes.get(w) for w in begin]
            if None in codes:
                continue
            head = codes[0] if length == 2 else above.get(tuple(codes[:-1]))
            if head is not None:
                known[tuple(codes)] = head << 32 | codes[-1]
        if not known or not len(at):
            break
        keys = np.array(sorted(known.values()))
        place = np.searchsorted(keys, key)
        hit = keys[np.minimum(place, len(keys) - 1)] == key
        at, place = at[hit], place[hit]
        depth[at] = length + 1
        above = {codes: int(np.searchsorted(keys, k)) for codes, k in known.items()}
        names = {n: codes for codes, n in above.items()}
        order = np.argsort(place, kind="stable")
        cuts = np.flatnonzero(np.diff(place[order])) + 1
        found += [(names[int(place[g[0]])], at[g]) for g in np.split(order, cuts) if len(g)]
        key = pairs(place, rows[at, length]) if length < LONGEST - 1 else None
    return depth, found


def _route(hot: dict, buckets: int):
    """Suffixes as packed rows, by bucket, language and number of routing words.

    Rows of depth 0 have counts of hot beginnings.
    """

    def run(batches):
        for lang, section in sections(batches):
            name, mine = lang.encode(), hot.get(lang, {})
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in section.codes.words], np.uint64)
            for part in section.suffixes():
                if not len(part):
                    continue
                rows, counts = equal_ones(part)
                depth, found = depths(section, rows, mine)
                cells = [_sums(section, hashes, lang, found, counts, buckets)] if found else []
                for d in np.unique(depth):
                    at = np.flatnonzero(depth == d)
                    bucket = bucket_of(hashed(hashes, rows[at], int(d), name), buckets)
                    order = np.argsort(bucket, kind="stable")
                    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                    cells += [_cells(section, lang, int(d), [(int(bucket[g[0]]), at[g]) for g in np.split(order, cuts)], rows, counts)]
                yield from cells

    return run


def _batch(lang, depth, cells):
    bucket, words, codes, counts = zip(*cells)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array([lang] * len(cells), pa.string()), pa.array([depth] * len(cells), pa.int32()),
         pa.array(words, pa.binary()), pa.array(codes, pa.binary()), pa.array(counts, pa.binary())],
        names=["bucket", "lang", "depth", "words", "codes", "counts"])


def _cells(section, lang, depth, parted, rows, counts):
    """A row per bucket: its words, and its suffixes by column as numbers of its words."""
    out = []
    for bucket, at in parted:
        mine = rows[at]
        used, local = np.unique(np.append(mine, END), return_inverse=True)  # END is the first of them
        local = local.reshape(-1)[:-1].reshape(mine.shape)
        width = np.uint16 if len(used) <= 1 << 16 else np.uint32
        words = b" ".join(section.codes.words[c] for c in used[1:])
        out.append((bucket, words, local.T.astype(width).tobytes(), counts[at].astype(np.uint32).tobytes()))
    return _batch(lang, depth, out)


def _sums(section, hashes, lang, found, counts, buckets):
    grouped = {}
    for begin, at in found:
        row = np.array([begin])
        bucket = int(bucket_of(hashed(hashes, row, len(begin), lang.encode()), buckets)[0])
        grouped.setdefault(bucket, []).append((section.phrase(begin), int(counts[at].sum())))
    return _batch(lang, 0, [
        (bucket, b"\n".join(p for p, _ in sums), b"", np.array([c for _, c in sums], np.uint64).tobytes())
        for bucket, sums in grouped.items()])


# --- 3. multikey quicksort --------------------------------------------------------------------


def frequent(columns, weights, depth, least):
    """(pointer, length, count) of the beginnings of at least ``depth`` words that weigh enough.

    ``columns`` are the words of every suffix by place, END beyond its last; pointers go into them.
    """
    out = []
    todo = [(np.arange(len(weights)), 0)] if weights.sum() >= least else []
    while todo:
        at, place = todo.pop()
        key = columns[place][at]
        pivot = np.sort(key[:: max(1, len(key) // 9)])[min(len(key), 9) // 2]
        for part in (at[key < pivot], at[key > pivot]):
            if len(part) and weights[part].sum() >= least:
                todo.append((part, place))
        same = at[key == pivot]
        count = int(weights[same].sum())
        if pivot == END or count < least:
            continue
        if place + 1 >= depth:
            out.append((int(same[0]), place + 1, count))
        if place + 1 < len(columns):
            todo.append((same, place + 1))
    return out


def _sort(least):
    def run(table: pa.Table) -> pa.Table:
        found = []
        keys = list(zip(table.column("lang").to_pylist(), table.column("depth").to_pylist()))
        for lang, depth in sorted(set(keys)):
            mine = table.filter(pa.array([k == (lang, depth) for k in keys]))
            if depth == 0:
                found += [(lang, p.count(b" ") + 1, p, c) for p, c in _summed(mine).items() if c >= least]
                continue
            codes, columns, weights = _suffixes(mine)
            for at, length, count in frequent(columns, weights, depth, least):
                found.append((lang, length, b" ".join(codes.words[c[at]] for c in columns[:length]), count))
        lang, length, phrase, count = zip(*found) if found else ((),) * 4
        return pa.table({
            "lang": pa.array(lang, pa.string()), "words": pa.array(length, pa.int32()),
            "phrase": pa.array(phrase, pa.binary()).cast(pa.string()), "f": pa.array(count, pa.int64())})

    return run


def _summed(table):
    total = {}
    for phrases, counts in zip(table.column("words").to_pylist(), table.column("counts").to_pylist()):
        for phrase, count in zip(phrases.split(b"\n"), np.frombuffer(counts, np.uint64).tolist()):
            total[phrase] = total.get(phrase, 0) + count
    return total


def _suffixes(table):
    """Codes of the words of a table of cells, the suffixes by column, and how often each is there."""
    codes, weights, held = Codes(), [], []
    for words, packed, counts in zip(*(table.column(c).to_pylist() for c in ("words", "codes", "counts"))):
        listed = words.split(b" ")
        renamed = np.fromiter(map(codes.__getitem__, listed), np.int32, len(listed))
        renamed = np.concatenate([np.zeros(1, np.int32), renamed])
        counts = np.frombuffer(counts, np.uint32)
        width = np.uint16 if len(renamed) <= 1 << 16 else np.uint32
        held.append(renamed[np.frombuffer(packed, width).reshape(LONGEST, len(counts))])
        weights.append(counts)
    return codes, list(np.concatenate(held, axis=1)), np.concatenate(weights).astype(np.int64)


# --- 4. phrases and scores --------------------------------------------------------------------


def counted(docs: DataFrame, least=LEAST, small_bucket=SMALL_BUCKET, large_bucket=LARGE_BUCKET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words of all languages (lang, phrase, f), phrases with ``least`` (lang, words, phrase, f), and totals (lang, n)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    seen, phrases = work_dir(spark, "collocations-words"), work_dir(spark, "collocations-phrases")
    found = rows.mapInArrow(_count, COUNTS).groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    # Counts of longer ones are of the sections that have enough, so they are at most the whole.
    found.where(f"words = 1 or f >= {small_bucket // 4}").write.parquet(seen)
    counts = spark.read.parquet(seen)
    words = counts.where("words = 1").drop("words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    suffixes = totals.agg(F.sum("n")).first()[0] or 0
    buckets = parts(suffixes, small_bucket, large_bucket)
    hot = hot_beginnings(counts, max(suffixes // (4 * buckets), small_bucket // 4)) if buckets > 1 else {}
    cells = rows.mapInArrow(_route(hot, buckets), CELLS)
    cells.groupBy("bucket").applyInArrow(_sort(least), COUNTS).write.parquet(phrases)
    return words, spark.read.parquet(phrases), totals


def hot_beginnings(counts: DataFrame, size: int) -> dict:
    """For each language and length, the beginnings of ``size`` suffixes or more.

    Of any length at most the number of all suffixes divided by ``size`` can come to the driver, four a bucket.
    """
    hot = {}
    for row in counts.where("words > 1").where(F.col("f") >= size).toLocalIterator():
        hot.setdefault(row.lang, {}).setdefault(row.words, []).append(row.phrase.encode().split(b" "))
    return hot


def not_inside(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one has inside it each time.

    Counts cannot grow with length, so it is enough to look at phrases with one word more.
    """
    w = F.split("phrase", " ")
    inside = F.array(*[F.array_join(F.slice(w, start, F.col("words") - 1), " ") for start in (1, 2)])
    parts = phrases.where("words > 2").select("lang", F.explode(inside).alias("phrase"), "f").distinct()
    return phrases.join(parts, ["lang", "phrase", "f"], "left_anti")


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) by the cut with the least score, the shortest first part among equals."""
    w = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), w.alias("w"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, LONGEST), " ").alias("rest"))
    for part, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)), ["lang", part])
    cuts = cuts.join(totals, "lang")
    score = F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0)))"
                   " div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(least).select(
        "lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def collocations(docs: DataFrame, least=LEAST, limit=FIRST, **buckets) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``limit`` best phrases of every language.

    ``small_bucket`` and ``large_bucket`` are the suffixes of a bucket while there are few and many buckets.
    """
    spark = docs.sparkSession
    words, phrases, totals = counted(docs, least, **buckets)
    counts = phrases.select("lang", "phrase", "f").unionByName(words.where(F.col("f") >= least))
    path = work_dir(spark, "collocations-scored")
    scored(not_inside(phrases), counts, totals).write.parquet(path)
    rows = spark.read.parquet(path)
    # A language's phrases are ranked in parts first, so that no task sorts them all.
    most = rows.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    part = F.pmod(F.xxhash64("phrase"), F.lit(max(1, -(-most // RANKED))))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    best = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = best.where(F.col("rank") <= limit).drop("part").withColumn("rank", rank).where(F.col("rank") <= limit)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
