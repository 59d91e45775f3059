import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture
def frame(spark):
    """A documents table from (doc_id, text) rows, with an extra column of an unlucky name."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, runs int")

    return make
