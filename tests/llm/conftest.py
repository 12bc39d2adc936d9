import random

import pytest

SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, gram string, u string, n string, rep string"


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def prose():
    """Texts with exact and near copies, shared passages, repeated text, odd white space, and edge cases."""
    rng = random.Random(3)
    base = [" ".join(words(rng, rng.randint(1, 220))) for _ in range(60)]
    passage, long = " ".join(words(rng, 60)), words(rng, 3000)
    out = list(base)
    out += [f"{a} {passage} {b}" for a, b in zip(base[:8], base[8:16], strict=True)]  # a shared passage in different contexts
    out += [base[3]] * 4
    for k in range(12):  # near copies of near copies
        w = base[20 + k % 3].split()
        for _ in range(1 + k // 3):
            w[rng.randrange(len(w))] = "other"
        out.append(" ".join(w))
    out += [" ".join(long), " ".join(long[500:1500]), "ab " * 400, "x" * 700, "the same line\n" * 30]
    out += [None, "", " \t\n", "one", "one", "Two WORDS", "two words", "é ß\x0bü\x1fö 日本語 " * 30, "ÀÉ \U0001f600 " * 5]
    return out


@pytest.fixture(scope="session")
def edge_docs(spark, prose):
    """The texts under ids, with a row repeated, an id repeated with another text, null ids, and columns with clashing names."""
    rows = [(i, t) for i, t in enumerate(prose)] + [(3, prose[3]), (5, "another text of id five"), (None, prose[3]), (None, None)]
    full = [(i, t, "en" if k % 3 else None, f"s{k % 2}", None if t is None else len(t), "g", "u", "n", "r") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
