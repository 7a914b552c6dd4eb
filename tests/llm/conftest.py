import random

import pytest

WORDS = "the of and a to in Haus mit für élan très rojo uno dos idiot ТЕСТ 水 x1 foo-bar, end.".split()
LONG = "This line is long enough to count as shared text."


def make_docs(seed: int = 3, n: int = 120):
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared lines, odd and long texts, nulls, repeated rows."""
    rng = random.Random(seed)
    rows = []

    def text(words: int) -> str:
        lines, line = [], []
        for _ in range(words):
            line.append(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "42"]))
            if rng.random() < 0.1:
                lines.append(" ".join(line))
                line = []
        return "\n".join([*lines, " ".join(line)])

    for i in range(n):
        kind = i % 12
        if kind == 1 and rows:
            body = rows[rng.randrange(len(rows))][1]
        elif kind == 2 and rows:
            body = (rows[rng.randrange(len(rows))][1] or "") + " more"
        elif kind in (3, 4):
            body = text(30) + "\n" + LONG + "\n" + text(5)
        elif kind == 5:
            body = f"  {LONG.upper()}\t\n" + text(10)
        elif kind == 6:
            body = rng.choice(["", " ", "\n\n", "  two  spaces ", "tab\there\x0b\x0c", "\x00nul", "é" * 50, "▁▁x ▁", "<|endoftext|> a b", "a b c"])
        else:
            body = text(rng.randrange(1, 120))
        rows.append((i * 3, body, "en", rng.choice(["a", "b", "b", "b", "é", "", None]), len(body or "")))
    rows.append((9001, None, None, None, None))
    rows.append((9002, None, "en", "b", 0))
    rows.append((None, LONG + "\nno id", "en", "b", 5))
    rows.append((9003, (LONG + " ") * 2000, "en", "b", 7))  # one very long line
    rows.append((9004, text(20000), "en", "b", 7))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The documents with columns named like those that operators add or use."""
    from pyspark.sql import functions as F

    names = (
        "size key copies fingerprint component_id score evidence predicted n_lines n_dropped _cleaned digest _id _text word cell cut row "
        "ids decoded keep_id component batch kept _drops _plan whole last"
    ).split()
    return docs.select("*", *[F.lit(n).alias(n) for n in names])


@pytest.fixture(scope="session")
def repeated(docs):
    return docs.unionAll(docs)
