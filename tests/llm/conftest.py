import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from {doc_id: text} or from (doc_id, text) pairs, with a column too many."""

    def build(texts):
        pairs = texts.items() if isinstance(texts, dict) else texts
        rows = [(i, t, None, None, len(t) if t else None, "x") for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA + ", words string")

    return build


def made_words(seed, count, kinds=400):
    import random

    random_ = random.Random(seed)
    return [f"w{random_.randrange(kinds)}" for _ in range(count)]
