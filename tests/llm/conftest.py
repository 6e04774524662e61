import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names the operators use inside
          "mark long, words string, token string, n int, line string, removed int, label int, "
          "kept string, m string, Mark2 string")


def rows_of(pairs, lang="en", source="s"):
    return [(d, t, lang, source, None if t is None else len(t)) + (1, "x", "y", 2, "z", 3, 4, "k",
                                                                   "m", None) for d, t in pairs]


@pytest.fixture(scope="session")
def frame(spark):
    """Makes a documents frame with clashing extra columns from (id, text) pairs."""
    def make(pairs, lang="en", source="s"):
        return spark.createDataFrame(rows_of(pairs, lang, source), SCHEMA)
    return make


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
                    for _ in range(n))


@pytest.fixture(scope="session")
def edge_pairs():
    """Nulls, empties, a very long text, copies, ties, repeated rows, shared passages."""
    rng = random.Random(5)
    passage, other = sentence(rng, 60), sentence(rng, 50)
    long = sentence(rng, 30_000)
    near = passage.split()
    near[30] = "changed"
    return [
        (1, passage), (2, passage), (2, passage), (3, " ".join(near)), (4, None), (None, passage),
        (None, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "one"), (9, "a b c"),
        (10, long), (11, sentence(rng, 20) + " " + passage + " " + sentence(rng, 20)),
        (12, "x " * 500), (13, other + "\n" + other), (13, sentence(rng, 40)),
        (14, "a b c d\nA b c d\nb a d c e\n\na b c d\nunique line of words here"),
        (15, "été 中文   naïve " + other), (16, sentence(rng, 34)),
        (17, sentence(rng, 35)), (None, "a b c"),
    ]
