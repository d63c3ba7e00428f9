import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# extra columns whose names the operators use inside
EXTRA = "kept string, fp string, part string, component string, _id string, h string, ids string, level int"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
LONG = " ".join(f"{WORDS[i % 12]}{i % 997}" for i in range(40000))


def edge_rows():
    plain = "The quick brown fox jumps over the lazy dog and runs away from it."
    return [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \n\t ", None, "a", 4),
            (4, plain, "en", "a", 66), (4, plain, "en", "a", 66), (4, "Another text.", "en", "a", 13),
            (5, plain, None, None, None), (6, LONG, "en", "a", len(LONG)), (None, "Text without an id.", "de", "b", 19),
            (None, None, None, None, None), (7, "12345 !!! 67 |", "fr", "b", 14), (8, "word", "en", "b", 4),
            (9, "a\nb\na\n\nb", "en", "b", 8), (-5, "Straße ñandú 漢字 👩‍👩 é́   \x1c <|endoftext|>", "es", "b", 40)]


@pytest.fixture(scope="session")
def workers(spark):
    from ridelake.llm.common import prepare
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def edges(workers):
    rows = [r + ("k", "f", "p", "c", "i", "h", "x", 3) for r in edge_rows()]
    return workers.createDataFrame(rows, f"{DOCS}, {EXTRA}")


@pytest.fixture(scope="session")
def empty(workers):
    return workers.createDataFrame([], f"{DOCS}, {EXTRA}")


@pytest.fixture(scope="session")
def small(workers):
    """The smallest documents table, as Spark and pandas frames."""
    df = workers.read.parquet(f"{SF}/documents.parquet")
    return df, df.toPandas()
