import pytest

from stockflow.llm.queries import tokenizer_path

# Names that the operators use inside, as extra columns of the input.
CLASHING = [
    "fp", "key", "pair", "first", "root", "row", "base", "near", "terms", "size", "shard", "slot", "_h", "_id", "_row",
    "_range", "_part", "length", "piece", "_n", "offset", "bucket", "borrowed", "ord", "b", "p", "any", "top", "rate",
    "toxic", "score", "dir", "best", "lines", "ids", "term", "count", "v", "dim", "block", "kept_id",
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"

SENTENCE = "the quick brown fox of the north jumps over a lazy dog and it is said to be in the town by the river"
LONG = " ".join(f"word{i % 977} the {i % 13}" for i in range(40_000))
EDGE_ROWS = [
    (1, None, "en", "s", None),
    (2, "", "en", "s", 0),
    (3, SENTENCE, "en", "s", len(SENTENCE)),
    (3, SENTENCE, "en", "s", len(SENTENCE)),
    (4, SENTENCE, None, None, len(SENTENCE)),
    (5, LONG, "en", "s", len(LONG)),
    (None, "a row without an id é 😀", "fr", "s", 23),
    (7, " \t\n ", "en", "s", 4),
    (8, "One two. Three", "en", "s", 14),
]


def clashing(df):
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def edge_docs(spark):
    return clashing(spark.createDataFrame(EDGE_ROWS, COLUMNS))


@pytest.fixture(scope="session")
def no_docs(spark):
    return clashing(spark.createDataFrame([], COLUMNS))


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def bpe_path():
    return tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def piece_path():
    return tokenizer_path("piece_bpe_32k.model")
