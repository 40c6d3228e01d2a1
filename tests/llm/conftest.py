import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, fp string, part int, word string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """Nulls, empty, blank, very long, repeated and near texts, ties, and columns with clashing names."""
    rng = random.Random(3)
    base = prose(rng, 300)
    words = base.split()
    near = [" ".join(w if i != k else "zzz" for i, w in enumerate(words)) for k in (10, 150, 290)]
    shared = prose(rng, 60)
    texts = [base, *near, base, None, "", "  \n\t ", base.replace(" ", "  "), "one two", shared, "x y " + shared + " q", "spam " * 400, "spam " * 400, prose(rng, 20000), shared + "\n" + shared]
    texts += ["Line Number One Here\nother " + prose(rng, 5), " line number one here \n\nx", "ümlaut É\x85 nbsp same line again", "ümlaut É\x85 nbsp same line again\nTail of it"]
    texts += [prose(rng, rng.randint(1, 80)) for _ in range(30)]
    rows = [(i, t, "en", None, None, "clash", 1, "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC)
