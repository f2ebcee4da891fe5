import pytest


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    from aurum.llm.common import ship
    ship(spark)


@pytest.fixture()
def table(spark):
    """documents-like rows: (doc_id, text) tuples plus columns whose names clash with internal ones."""
    def make(rows, extra=("id", "rid", "t", "k", "n", "score", "kept", "label")):
        fields = ", ".join(f"{c} string" for c in extra)
        data = [(i, x, "en", "s", None if x is None else len(x), *(["?"] * len(extra))) for i, x in rows]
        return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {fields}")
    return make
