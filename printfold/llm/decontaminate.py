"""Benchmark decontamination by spaced seeds.

Tokens are words in lower case with only their letters and digits; words without any are no tokens. A
document is contaminated by a benchmark item when some ``WINDOW`` consecutive tokens of the item agree
with as many consecutive tokens of the document in all but ``SUBSTITUTIONS`` places. An item shorter
than that must occur whole, with substitutions in proportion to its length, rounded down. One under
``SHORTEST`` tokens is too common a phrase for that: it must be a whole line, or a whole document.

Each mask selects some places of a run of tokens and ignores the others. Equal hashes of selected
tokens are hits; around each, item and document are laid over each other and every window compared.
The masks are such that any two substitutions in a window miss at least one of them, and so for one
substitution in a shorter item (every other place), so no window is lost. Equal hashes are only
candidates, so a collision costs time and adds nothing.

The benchmark side is broadcast in parts of a bounded number of tokens; a larger benchmark has more
parts, and the documents pass each of them. A long item is cut into segments that overlap by less than a
window, so that a window lies in one of them. Hits are compared in slices of items that have a bounded
number of them.

Defined results: a null or empty text has no tokens and is clean; a null item id is an id of its own
(null), and ids may have any type; repeated rows of a document or item give one row, with the largest
counts; an empty table on either side gives no hits; other columns pass through ``clean`` unchanged.
"""

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from printfold.llm.words import Table, slices, texts, values

WINDOW, SUBSTITUTIONS, SHORTEST = 13, 2, 5
# Places that each mask selects.
MASKS = ((0, 1, 2, 3, 5, 6, 7), (0, 1, 4, 7, 8, 9, 10), (0, 3, 4, 5, 7, 10, 11))
PART_TOKENS = 2_000_000
CHUNK_BYTES, TABLE_WORDS = 4 << 20, 100_000
SEGMENT = 100_000  # tokens of an item in one part
HITS = 500_000  # compared at once, but never less than one item's
NO_TOKEN = 0xFFFFFFFF  # a word without letters or digits
NOT_LETTERS = regex.compile(r"[^\p{L}\p{N}]+")


def token(word: bytes) -> str:
    return NOT_LETTERS.sub("", word.decode(errors="replace").lower())


def _mixers(n: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b"place", seed=i) | 1 for i in range(n)], np.uint64)


def substitutions(length: int) -> int:
    """Places in which an item of some tokens may differ."""
    return SUBSTITUTIONS * min(length, WINDOW) // WINDOW


class Index:
    """Seeds of one part of the benchmark, a list of texts."""

    def __init__(self, items):
        self.vocabulary, self.rows, self.short, flat, starts = {}, [], {}, [], [0]
        for row, text in enumerate(items):
            found = [t for t in map(token, (text or "").encode().split()) if t]
            codes = [self.vocabulary.setdefault(t, len(self.vocabulary) + 1) for t in found]
            if len(found) >= SHORTEST:
                self.rows.append(row)
                flat += codes
                starts.append(len(flat))
            elif found:
                self.short.setdefault(tuple(codes), []).append(row)
        self.rows = np.array(self.rows, np.int64)
        self.flat, self.starts = np.array(flat, np.uint32), np.array(starts, np.int64)
        lengths = np.diff(self.starts)
        self.seeds = []
        long = np.flatnonzero(lengths >= WINDOW)
        for mask in MASKS:
            at = _concat([np.arange(self.starts[j], self.starts[j + 1] - mask[-1]) for j in long])
            self._add(mask, at, np.repeat(long, lengths[long] - mask[-1]))
        for n in np.unique(lengths[lengths < WINDOW]):
            j = np.flatnonzero(lengths == n)
            if not substitutions(n):
                self._add(tuple(range(int(n))), self.starts[j], j)
                continue
            for first in (0, 1):  # every other place: a substitution is in one of the two
                self._add(tuple(range(0, int(n) - first, 2)), self.starts[j] + first, j)

    def _add(self, mask, at, item):
        if len(at):
            hashes = self._hash(self.flat, at, mask)
            order = np.argsort(hashes, kind="stable")
            self.seeds.append((mask, hashes[order], at[order], item[order]))

    @staticmethod
    def _hash(tokens, at, mask):
        total = np.zeros(len(at), np.uint64)
        for place, mixer in zip(mask, _mixers(len(mask))):
            total = (total ^ (total >> np.uint64(29))) * mixer + tokens[at + place]
        return total * mixer

    def table(self) -> Table:
        get = self.vocabulary.get

        def rule(word):
            t = token(word)
            return get(t, 0) if t else NO_TOKEN

        return Table(rule, TABLE_WORDS)

    def find(self, docs: list, table: Table):
        """(document, item, token place in document, matches) of every window that agrees, in parts.

        An item's windows all come in one part.
        """
        rows = [values(text, table, np.uint32) for text in docs]
        rows = [r[r != NO_TOKEN] for r in rows]
        if self.short:
            yield self._whole_lines(docs, rows, table)
        sizes = np.array([len(r) + 1 for r in rows], np.int64)
        flat = _concat([np.append(r, np.uint32(0)) for r in rows]).astype(np.uint32)  # a place between documents
        ends = np.cumsum(sizes) - 1
        known = flat > 0
        hits, weight = [], np.zeros(len(self.starts) - 1, np.int64)
        for mask, hashes, at, item in self.seeds:
            p = np.flatnonzero(known[: max(len(flat) - mask[-1], 0)])
            for place in mask[1:]:
                p = p[known[p + place]]
            h = self._hash(flat, p, mask)
            low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            hit = np.flatnonzero(high > low)
            hits.append((p[hit], low[hit], high[hit]))
            seen = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(seen, low[hit], 1)
            np.add.at(seen, high[hit], -1)
            np.add.at(weight, item, np.cumsum(seen)[:-1])
        group = np.cumsum(weight) // HITS
        for n in np.unique(group[weight > 0]):
            mine = group == n
            diagonals = []
            for (_, _, at, item), (p, low, high) in zip(self.seeds, hits):
                chosen = mine[item]
                before = np.concatenate([[0], np.cumsum(chosen)])
                at, item, start, count = at[chosen], item[chosen], before[low], before[high] - before[low]
                s = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
                diagonals.append(np.stack([np.repeat(p, count) - (at[s] - self.starts[item[s]]), item[s]], 1))
            pairs = np.unique(_concat(diagonals).reshape(-1, 2).astype(np.int64), axis=0)
            yield self._verify(flat, ends, pairs)

    def _whole_lines(self, docs, rows, table):
        """Items of few tokens that are a whole line or document."""
        found = set()
        for doc, (text, tokens) in enumerate(zip(docs, rows)):
            place = 0
            for line in text.split(b"\n"):
                here = [c for c in map(table.__getitem__, line.split()) if c != NO_TOKEN]
                if 0 < len(here) < SHORTEST:
                    for row in self.short.get(tuple(here), ()):
                        found.add((doc, row, place, len(here)))
                place += len(here)
            if 0 < len(tokens) < SHORTEST:
                for row in self.short.get(tuple(tokens.tolist()), ()):
                    found.add((doc, row, 0, len(tokens)))
        return np.array(sorted(found), np.int64).reshape(-1, 4)

    def _verify(self, flat, ends, pairs):
        """Windows along each diagonal; ``pairs`` has where the item would begin and the item."""
        found = []
        for part in np.array_split(pairs, len(pairs) // 20_000 + 1):
            begin, item = part[:, 0], part[:, 1]
            length = self.starts[item + 1] - self.starts[item]
            row = np.repeat(np.arange(len(part)), length)
            place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
            at = begin[row] + place
            inside = (at >= 0) & (at < len(flat))
            there = np.where(inside, flat[np.clip(at, 0, len(flat) - 1)], 0) if len(flat) else at * 0
            same = there == self.flat[self.starts[item[row]] + place]
            total = np.concatenate([[0], np.cumsum(same)])
            size = np.minimum(length, WINDOW)[row]
            fits = place + size <= length[row]
            matches = total[np.minimum(np.arange(len(row)) + size, len(row))] - total[: len(row)]
            short = np.minimum(length, WINDOW)
            enough = (short - SUBSTITUTIONS * short // WINDOW)[row]
            good = np.flatnonzero(fits & (matches >= enough))
            if len(good):
                first = at[good]
                doc = np.searchsorted(ends, np.maximum(first, 0))
                last = first + size[good] - 1
                own = (first >= np.where(doc > 0, ends[np.maximum(doc - 1, 0)] + 1, 0)) & (last < ends[doc])
                start = np.where(doc > 0, ends[np.maximum(doc - 1, 0)] + 1, 0)
                found.append(np.stack([doc, self.rows[item[row[good]]], first - start, matches[good]], 1)[own])
        return _concat(found).reshape(-1, 4).astype(np.int64)


def _concat(arrays):
    return np.concatenate(arrays) if len(arrays) else np.zeros(0, np.int64)


def segments(benchmark: DataFrame, tokens=SEGMENT) -> DataFrame:
    """(item_id, item_key, segment, text): items cut so that every window is in one segment."""
    words = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")
    found = F.filter(words, lambda w: w.rlike(r"[\p{L}\p{N}]"))
    rows = benchmark.select("item_id", F.xxhash64("text").alias("item_key"), found.alias("words"))
    last = F.greatest(F.size("words") - WINDOW, F.lit(0))
    rows = rows.withColumn("segment", F.explode(F.sequence(F.lit(0), F.floor(last / tokens).cast("int"))))
    part = F.slice("words", F.col("segment") * tokens + 1, F.lit(tokens + WINDOW - 1))
    return rows.select("item_id", "item_key", "segment", F.array_join(part, " ").alias("text"))


def indexes(benchmark: DataFrame, part_tokens=PART_TOKENS):
    """(names, broadcast index) of the benchmark (item_id, text), one part after the other.

    A part is collected whole; it has about ``part_tokens`` tokens, and segments are shorter than that. Names
    are an Arrow table (item_id, item_key, segment), a row for each text of the index.
    """
    cut = segments(benchmark, min(SEGMENT, part_tokens))
    total = cut.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    parts = max(1, -(-total // part_tokens))
    part = F.pmod(F.xxhash64("item_id", "item_key", "segment"), F.lit(parts))
    for n in range(parts):
        rows = cut.where(part == n).toArrow()
        index = Index(rows.column("text").to_pylist())
        yield rows.select(["item_id", "item_key", "segment"]), benchmark.sparkSession.sparkContext.broadcast(index)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, windows, best, first): windows that agree, the most matching tokens in one,
    and the token place in the document where the first begins."""
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, text_key bigint, item_id {item_type}, item_key bigint, segment int, "
              "windows bigint, best bigint, first bigint")
    found = None
    for names, index in indexes(benchmark):
        rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(_report(names, index), schema)
        found = rows if found is None else found.unionByName(rows)
    counts = F.max("best").alias("best"), F.min("first").alias("first")
    # Rows of one text and segment say the same; segments of an item add up; other texts of one id do not.
    once = found.groupBy("doc_id", "text_key", "item_id", "item_key", "segment").agg(F.max("windows").alias("windows"), *counts)
    whole = once.groupBy("doc_id", "text_key", "item_id", "item_key").agg(F.sum("windows").alias("windows"), *counts)
    return whole.groupBy("doc_id", "item_id").agg(F.max("windows").alias("windows"), *counts)


def _report(names, index):
    def run(batches):
        own, table = index.value, index.value.table()
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                for hits in own.find(texts(part.column("text")), table):
                    if len(hits):
                        yield _counted(part, names, hits)

    return run


def _counted(part, names, hits):
    pair, row = np.unique(hits[:, :2], axis=0, return_inverse=True)
    row = row.reshape(-1)
    best, first = np.zeros(len(pair), np.int64), np.full(len(pair), np.iinfo(np.int64).max)
    np.maximum.at(best, row, hits[:, 3])
    np.minimum.at(first, row, hits[:, 2])
    named = names.take(pa.array(pair[:, 1])).combine_chunks()
    columns = {c: part.column(c).take(pa.array(pair[:, 0])) for c in ("doc_id", "text_key")}
    columns |= {c: named.column(c).combine_chunks() for c in named.column_names}
    columns |= {"windows": pa.array(np.bincount(row), pa.int64()), "best": pa.array(best), "first": pa.array(first)}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates."""
    for _, index in indexes(benchmark):
        docs = docs.mapInArrow(_drop(index), docs.schema)
    return docs


def _drop(index):
    def run(batches):
        own, table = index.value, index.value.table()
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                keep = np.ones(part.num_rows, bool)
                for hits in own.find(texts(part.column("text")), table):
                    keep[hits[:, 0]] = False
                yield part.filter(pa.array(keep))

    return run
