import pytest

from patronage.llm.byte_bpe import vocabulary


@pytest.fixture()
def edge_rows():
    """Rows of the documents table with nulls, empty, long, repeated and odd
    texts, and further columns whose names clash with the operators' own."""
    long = " ".join(f"wort{i % 977} über" for i in range(6000))
    rows = [(0, "The quick brown fox, twice."), (1, None), (2, ""), (3, "  \t\n "), (None, "No id here, but text."), (5, "The quick brown fox, twice."),
            (5, "The quick brown fox, twice."), (7, long), (8, "naïve ﬁancée <|endoftext|> 中文 👍🏽 é"), (9, "one"), (10, "a b"),
            (11, "x" * 3000), (12, "A  B \n C"), (13, "İstanbul ΟΔΟΣ's 3²")]
    return [(i, t, "fp", 1.5, "task", "rows") for i, t in rows]


EDGE_SCHEMA = "doc_id bigint, text string, fp string, score double, bucket string, hash string"


@pytest.fixture()
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, EDGE_SCHEMA).repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def library():
    """(byte-level, word) tokenizers of the library."""
    from tokenizers import Tokenizer
    return tuple(Tokenizer.from_file(vocabulary(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
