import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def docs_rows():
    """Nulls, empty and blank texts, control strings, ties, near copies, repeated lines, a long text."""
    words = [f"w{(k * k + 7 * k) % 997}{'aeiou'[k % 5]}" for k in range(6000)]
    base = " ".join(words[:300])
    near = base.replace(words[150], "changed")
    shared = "This line stands in several documents.\n"
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "One  two\tTHREE"),
            (7, base), (8, near), (9, base.upper()), (10, " ".join(words)), (11, "x" * 5000),
            (12, "a<|endoftext|>b <|startoftext|> İΣß\x1c\x85\u2003é e\u0301 it's 123 ½ 日本語\U0001f600"),
            (13, shared + "own line of thirteen\n" + shared), (14, shared.upper() + "tail"),
            (15, "  " + shared + "\n\nshort\nshort"), (16, "#$%& " * 60), (17, "same three words " * 40),
            (18, base), (19, "WOW!! " * 30 + " ".join(words[400:430]))]
    return rows + [(100 + k, " ".join(words[40 * k:40 * k + 90]) + f"\n{shared}end {k}") for k in range(20)]


@pytest.fixture(scope="session")
def documents(spark, docs_rows):
    """The rows with columns whose names clash with the operators' own."""
    kind = ("doc_id long, text string, kept boolean, row int, doc int, piece string, shard int, `_text` string, "
            "n_words int, component string, label int")
    return spark.createDataFrame([(*r, None, 1, 2, "p", 3, None, 4, "c", None) for r in docs_rows], kind).repartition(3)
