import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def some_texts():
    """Random texts of a small vocabulary, with copies, shared passages and odd cases; (doc_id, text)."""
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(r.choices(vocabulary, k=n))
    rows = [text(r.randrange(5, 120)) for _ in range(60)]
    passage = text(40)
    rows += [f"{text(20)} {passage} {text(n)}" for n in range(0, 30, 3)]
    near = text(100).split()
    for n in range(12):
        changed = list(near)
        for _ in range(n % 4):
            changed[r.randrange(100)] = f"x{n}"
        rows.append(" ".join(changed))
    rows += [rows[3], rows[3], rows[65], "\t" + rows[4].replace(" ", "\n "), "", "   ", "one", "one two three", text(3000)]
    out = [(3 * i, t) for i, t in enumerate(rows)]
    r.shuffle(out)
    return [*out, (5000, None), (5001, "é" * 9000), (5002, text(13))]


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents, with columns whose names clash with results."""

    def run(rows, types="doc_id long, text string"):
        extra = "lang string, source string, n_chars long, score double, chunk int, node int, label string, target string"
        return spark.createDataFrame([(*r, "en", "s1", 1, 2.0, 3, 4, "l", "t") for r in rows], f"{types}, {extra}")

    return run
