import pytest

from curbside.llm.storage import ship_package

#: Columns that an operator might use itself, under other types than its own.
CLASHING = ("score", "chunk", "row", "id", "part", "n", "rep", "token", "bucket", "node", "component", "held_out", "position")


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with languages, sources and columns of clashing names."""

    def make(rows, langs=None):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
        langs = langs or [None] * len(rows)
        data = [(i, t, g, None, None if t is None else len(t), *("x" for _ in CLASHING)) for (i, t), g in zip(rows, langs, strict=True)]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture(scope="session")
def definition():
    import public_tokenizers

    from curbside.llm.bpe import read_definition

    return read_definition(public_tokenizers.path("word_bpe_49k.json"))
