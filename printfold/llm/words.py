"""Words of whole texts as numbers, for operators that work on arrays inside tasks.

Words are runs of anything but blanks (x20, x09 to x0D), as ``bytes.split`` parts them. Tables from
words to numbers are dictionaries that work out a missing entry; they forget everything when full, so
that a task's memory does not grow with the vocabulary.
"""

import numpy as np
import pyarrow as pa
import xxhash

TABLE_WORDS = 400_000
PIECE_BYTES = 1 << 20


class Table(dict):
    """Values of words by ``rule``."""

    def __init__(self, rule, limit=TABLE_WORDS):
        super().__init__()
        self.rule, self.limit = rule, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.rule(word)
        return value


def hash_table():
    return Table(xxhash.xxh3_64_intdigest)


def pieces(text: bytes):
    """A text in pieces of bounded size, cut at blanks."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = max(text.rfind(blank, at, at + PIECE_BYTES) for blank in (b" ", b"\n", b"\t"))
        if cut <= at:  # a word longer than a piece
            found = [i for i in (text.find(blank, at) for blank in (b" ", b"\n", b"\t")) if i > at]
            if not found:
                break
            cut = min(found)
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def values(text: bytes, table: Table, dtype) -> np.ndarray:
    """The table's value of every word of a text."""
    if len(text) <= PIECE_BYTES:
        found = text.split()
        return np.fromiter(map(table.__getitem__, found), dtype, len(found))
    return np.concatenate([np.fromiter(map(table.__getitem__, w), dtype, len(w)) for w in map(bytes.split, pieces(text))])


def slices(batch: pa.RecordBatch, column: str, limit: int):
    """Parts of a batch whose texts have about ``limit`` bytes, at least a row each."""
    sizes = texts(batch.column(column), len)
    start = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def texts(column, get=lambda t: t) -> list:
    """UTF-8 bytes of every text, or what ``get`` makes of them; null is empty."""
    return [get(t) if t is not None else get(b"") for t in column.cast(pa.binary()).to_pylist()]
