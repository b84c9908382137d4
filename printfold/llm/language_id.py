"""Language identification by mixture inference.

Each language has a model of byte trigrams within words (lower case, letters only), counted over all
training rows. A document is a mixture: every word comes from one language, with the likelihood its
trigrams give it. Expectation-maximisation estimates the proportions, each document until its log
likelihood gains less than ``SETTLED`` in a round (or ``ROUNDS`` are over); then the smallest language is
dropped for as long as the likelihood, less half the logarithm of the number of words for each
language, does not fall. The prediction is the largest proportion, which is also the score.

A model has ``BUCKETS`` numbers for each language. Models come in groups of ``GROUP`` languages, by name;
there may be any number of groups. The documents pass one group after the other, which adds its languages
to those selected so far; of these only the likelihoods of the document's own words are carried on.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is every text when
there was nothing to learn from; ties go to the language that sorts first; repeated rows get equal
results; training ignores null texts and languages; an empty table gives no rows; other columns pass
through, but those that have the name of an added one are replaced.
"""

import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from printfold.llm.words import pieces, slices, texts
from printfold.session import drop_dir, in_files, work_dir

BUCKETS, SLICES, GROUP = 1 << 16, 64, 256
SMOOTHING, ROUNDS, SETTLED = 0.5, 100, 0.01
CHUNK_BYTES, TABLE_WORDS = 1 << 20, 100_000
UNKNOWN = "und"
BACKGROUND, CHANCE = -float(np.log(BUCKETS)), 2.0  # log likelihood of a trigram in no language; deviations
MIX = np.uint32(0x9E3779B1)

# ASCII that is no letter becomes a blank; other bytes stay.
_BLANK = bytes(range(128)).translate(None, string.ascii_letters.encode())
LETTERS = bytes.maketrans(_BLANK, b" " * len(_BLANK))
ADDED = ("lang_pred", "score", "languages")


def cleaned(text: bytes) -> bytes:
    return text.decode(errors="replace").lower().encode().translate(LETTERS)


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode(errors="replace"))


def trigrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams around every byte that is no blank, and the places of those bytes."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    at = np.flatnonzero(b[1:-1] != 32) + 1
    code = (b[at - 1] << np.uint32(16)) | (b[at] << np.uint32(8)) | b[at + 1]
    return (code * MIX) >> np.uint32(16), at


# --- training ---------------------------------------------------------------------------------


def train(rows: DataFrame, group=GROUP) -> list:
    """Groups of (languages, broadcast (log likelihoods, means, variances)) from (text, lang); the counts of all rows.

    The driver holds the numbers of one group at a time.
    """
    spark = rows.sparkSession
    path = work_dir(spark, "languages")
    parts = rows.where("text is not null and lang is not null").select("text", "lang").mapInArrow(
        _count, "lang string, slice int, counts binary")
    names = sorted(r.lang for r in rows.where("lang is not null").select("lang").distinct().collect())
    counted = parts.groupBy("lang", "slice").applyInArrow(_sum, "lang string, slice int, counts binary")
    in_files(counted, len(names) * SLICES, SLICES).write.parquet(path)
    sums = spark.read.schema("lang string, slice int, counts binary").parquet(path)
    groups = []
    for start in range(0, len(names), group):
        mine = names[start: start + group]
        logs = _model(mine, sums if len(names) <= group else sums.where(F.col("lang").between(mine[0], mine[-1])))
        groups.append((mine, spark.sparkContext.broadcast((logs, *_usual(logs)))))
    drop_dir(spark, path)
    return groups


def _model(names, sums):
    width = BUCKETS // SLICES
    counts = np.zeros((len(names), BUCKETS), np.float64)
    for r in sums.toLocalIterator():
        counts[names.index(r.lang), r.slice * width: (r.slice + 1) * width] = np.frombuffer(r.counts, np.int64)
    total = counts.sum(1, keepdims=True)
    return np.log((counts + SMOOTHING) / (total + SMOOTHING * BUCKETS)).astype(np.float32)


def _count(batches):
    counts = {}
    for batch in batches:
        for part in slices(batch, "text", CHUNK_BYTES):
            by = {}
            for text, lang in zip(texts(part.column("text")), part.column("lang").to_pylist()):
                by.setdefault(lang, []).append(cleaned(text))
            for lang, found in by.items():
                for piece in pieces(b" " + b" ".join(found) + b" "):
                    found = np.bincount(trigrams(b" " + piece + b" ")[0], minlength=BUCKETS)
                    counts[lang] = counts[lang] + found if lang in counts else found
            if len(counts) > GROUP:
                yield from _slices(counts)
                counts = {}
    yield from _slices(counts)


def _slices(counts):
    for lang, found in counts.items():
        blobs = [x.astype(np.int64).tobytes() for x in np.split(found, SLICES)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * SLICES), pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())],
            names=["lang", "slice", "counts"])


def _sum(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
    return pa.table({"lang": table.column("lang")[:1], "slice": table.column("slice")[:1],
                     "counts": pa.array([total.tobytes()], pa.binary())})


# --- prediction -------------------------------------------------------------------------------


class Likelihoods:
    """Log likelihoods of words under each language; forgets all when full."""

    def __init__(self, logs):
        self.logs, self.index = logs.T.copy(), {}
        self.limit = max(1000, TABLE_WORDS * 8 // max(8, len(logs)))
        self.rows = np.zeros((0, logs.shape[0]), np.float32)

    def of(self, words: list) -> np.ndarray:
        new = set(words).difference(self.index)
        if len(self.index) + len(new) > self.limit:
            self.index, self.rows, new = {}, self.rows[:0], set(words)
        if new:
            new = list(new)
            found = trigrams(b" " + b" ".join(new) + b" ")[0]
            starts = np.concatenate([[0], np.cumsum([len(w) for w in new])[:-1]])
            sums = np.add.reduceat(self.logs[found], starts)
            self.index.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.rows = np.concatenate([self.rows, sums])
        return self.rows[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))]


def _maximise(like, counts, sizes, share):
    """Proportions and log likelihoods of documents, whose distinct words follow each other in ``like``."""
    out, fit = share.copy(), np.zeros(len(sizes))
    left, before = np.arange(len(sizes)), np.full(len(sizes), -np.inf)
    for n in range(ROUNDS + 1):
        starts = np.cumsum(sizes) - sizes
        each = np.repeat(share, sizes, axis=0)
        each *= like
        total = each.sum(1) + 1e-30
        now = np.add.reduceat(np.log(total) * counts, starts, dtype=np.float64)
        moving = (now - before >= SETTLED) & ((share > 0).sum(1) > 1) & (n < ROUNDS)
        out[left[~moving]], fit[left[~moving]] = share[~moving], now[~moving]
        if not moving.any():
            return out, fit
        each *= (counts / total)[:, None]
        share = np.add.reduceat(each, starts, axis=0)
        share /= share.sum(1, keepdims=True)
        before = now
        if not moving.all():
            rows = np.repeat(moving, sizes)
            like, counts, sizes, share = like[rows], counts[rows], sizes[moving], share[moving]
            left, before = left[moving], before[moving]


def proportions(like: np.ndarray, sizes: np.ndarray, counts=None) -> np.ndarray:
    """Proportions of the selected languages for each document.

    ``like`` has a row for each distinct word of each document, ``sizes`` are their numbers and ``counts`` how
    often each is there (once if unset).
    """
    k = like.shape[1]
    counts = np.ones(len(like), np.float32) if counts is None else counts.astype(np.float32)
    share = np.full((len(sizes), k), 1 / k, np.float32)
    share, fit = _maximise(like, counts, sizes, share)
    words = np.add.reduceat(counts, np.cumsum(sizes) - sizes)
    penalty = 0.5 * np.log(np.maximum(words, 2))
    active = np.flatnonzero((share > 0).sum(1) > 1)
    while len(active):
        chosen = np.zeros(len(sizes), bool)
        chosen[active] = True
        rows = np.repeat(chosen, sizes)
        fewer = share[active].copy()
        smallest = fewer.shape[1] - 1 - np.where(fewer > 0, fewer, 2)[:, ::-1].argmin(1)  # of equals, the last
        fewer[np.arange(len(active)), smallest] = 0
        fewer /= fewer.sum(1, keepdims=True)
        fewer, less = _maximise(like[rows], counts[rows], sizes[active], fewer)
        better = less + penalty[active] >= fit[active]
        active = active[better]
        share[active], fit[active] = fewer[better], less[better]
        active = active[(share[active] > 0).sum(1) > 1]
    return share


def identify(docs: DataFrame, model: list) -> DataFrame:
    """``docs`` with lang_pred, score and languages (``name:share`` of the selected, largest first)."""
    kept = docs.drop(*ADDED)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    rows = kept
    for n, (names, shared) in enumerate(model or [([], None)]):
        last = n >= len(model) - 1
        extra = "lang_pred string, score double, languages string" if last else f"{CARRIED} array<string>, {CARRIED}_logs binary"
        rows = rows.mapInArrow(_identify(names, shared, len(kept.columns), last), f"{fields}, {extra}")
    return rows


CARRIED = "_languages_so_far"


def _identify(names, shared, width, last, usual=None):
    """What adds to batches the columns of ``identify`` or, given ``usual``, keeps the rows whose mixture fits."""
    def run(batches):
        table = Likelihoods(shared.value[0]) if names else None
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                before = [part.column(i).to_pylist() for i in range(width, part.num_columns)] or None
                found = _results(texts(part.column("text")), names, table, before, last, usual)
                if last and usual is not None:
                    kept = pa.RecordBatch.from_arrays(part.columns[:width], names=part.schema.names[:width])
                    yield kept.filter(pa.array(found, pa.bool_()))
                    continue
                types = (pa.string(), pa.float64(), pa.string()) if last else (pa.list_(pa.string()), pa.binary())
                extra = [pa.array(x, t) for x, t in zip(zip(*found), types)]
                added = ADDED if last else (CARRIED, f"{CARRIED}_logs")
                yield pa.RecordBatch.from_arrays(part.columns[:width] + extra, names=[*part.schema.names[:width], *added])

    return run


def _results(found, names, table, before, last, usual=None):
    """(prediction, score, languages) of every text, or what is to be carried on: (languages, logs).

    Given ``usual``, the mean and variance of each language, the last result is whether a text's mixture fits.
    """
    out = [([], b"") if not last else (UNKNOWN, 0.0, "") if usual is None else False] * len(found)
    words = [Counter(cleaned(t).split()) if names and has_letter(t) else {} for t in found]
    rows = [i for i, w in enumerate(words) if w]
    if not rows:
        return out
    sizes = np.array([len(words[i]) for i in rows])
    counts = np.concatenate([np.fromiter(words[i].values(), np.int64, len(words[i])) for i in rows])
    logs = np.concatenate([table.of(list(words[i])) for i in rows])
    listed = [names] * len(rows)
    if before is not None:  # those selected from earlier groups come first, which their names do too
        old = [np.frombuffer(before[1][i], np.float32).reshape(len(words[i]), -1) for i in rows]
        most = max(o.shape[1] for o in old)
        padded = np.concatenate([np.pad(o, ((0, 0), (0, most - o.shape[1])), constant_values=-np.inf) for o in old])
        logs = np.concatenate([padded, logs], axis=1)
        listed = [before[0][i] + [None] * (most - len(before[0][i])) + names for i in rows]
    share = proportions(np.exp(logs - logs.max(1, keepdims=True)), sizes, counts)
    ends = np.cumsum(sizes)
    for n, (i, row) in enumerate(zip(rows, share.astype(float))):
        order = sorted(np.flatnonzero(row), key=lambda j: (-row[j], j))
        if last and usual is not None:
            mine = logs[ends[n] - sizes[n]: ends[n], order]
            out[i] = _known(_fitted(mine, [listed[n][j] for j in order], words[i], usual))
        elif last:
            chosen = ",".join(f"{listed[n][j]}:{row[j]:.3f}" for j in order)
            out[i] = listed[n][order[0]], min(float(row[order[0]]), 1.0), chosen
        else:
            order = sorted(order)
            out[i] = [listed[n][j] for j in order], np.ascontiguousarray(logs[ends[n] - sizes[n]: ends[n], order]).tobytes()
    return out


# --- documents --------------------------------------------------------------------------------


def held_out(doc_id):
    """Whether a document is kept from training; a null id is not held out, nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame):
    """The model of documents (doc_id, text, lang) that are not held out."""
    return train(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("text", "lang"))


def keep_identified(docs: DataFrame, model) -> DataFrame:
    """The rows of ``docs`` in languages the model knows, in whatever mixture.

    Every document's mixture is estimated as in ``identify``. Words of a selected language fit it as its training
    texts do; others fit none better than ``BACKGROUND``. A document is dropped when its words, each in its best
    selected language, are nearer to the background by more than chance explains in a text of its length.
    """
    if not model:
        return docs.where(F.lit(False))
    usual = {name: x for names, shared in model for name, x in zip(names, zip(*(v.tolist() for v in shared.value[1:])))}
    rows, fields = docs, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    for n, (names, shared) in enumerate(model):
        last = n == len(model) - 1
        schema = docs.schema if last else f"{fields}, {CARRIED} array<string>, {CARRIED}_logs binary"
        rows = rows.mapInArrow(_identify(names, shared, len(docs.columns), last, usual), schema)
    return rows


def _usual(logs):
    """Mean and variance of the log likelihood of a training trigram, for each language."""
    counts = np.exp(logs.astype(np.float64))
    counts -= counts.min(1, keepdims=True)  # in proportion to those of training
    total = np.maximum(counts.sum(1), 1e-300)
    mean = np.where(counts.any(1), (counts * logs).sum(1) / total, BACKGROUND)
    return mean, (counts * (logs - mean[:, None]) ** 2).sum(1) / total


def _fitted(logs, chosen, words: Counter, usual):
    """(letters, log likelihood, mean, variance) of a text's different words in their best selected language.

    The first two are of all times a word is there. ``logs`` has a column for each of the ``chosen`` languages.
    """
    best = logs.argmax(1)
    times = np.fromiter(words.values(), np.float64, len(words))
    letters = np.fromiter(map(len, words), np.float64, len(words))
    mean, variance = np.array([usual[name] for name in chosen]).T
    return letters * times, logs.max(1).astype(np.float64) * times, mean[best], variance[best]


def _known(fitted) -> bool:
    """Whether the words of a text fit the languages better than the background."""
    n, fit, mean, variance = fitted
    bound = (n * (mean + BACKGROUND) / 2).sum()
    return bool(np.maximum(fit, n * BACKGROUND).sum() >= bound - CHANCE * (n * variance).sum() ** 0.5)
