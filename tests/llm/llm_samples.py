import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n, vocabulary=None):
    """n invented words; rare enough that long runs don't repeat by chance."""
    vocabulary = vocabulary or WORDS
    return [rng.choice(vocabulary) + str(rng.randint(0, 99)) for _ in range(n)]


@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text) pairs with further columns whose names clash
    with those that operators make."""

    def make(pairs):
        rows = [(i, t, "en", 7, "x", 0, 1.5) for i, t in pairs]
        ddl = "doc_id bigint, text string, lang string, n_words int, key string, tag int, score double"
        return spark.createDataFrame(rows, ddl)

    return make


#: Null and empty texts, blanks, repeated rows, one very long text, null ids.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (4, "one"),
    (5, "word " * 60_000),
    (None, "a text without an id " * 30),
    (6, "naïve café — 東京 😀 ok"),
]
