"""Small document tables with awkward rows."""

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long, TEXT_ string, h long, sig string"


def awkward_rows():
    """Nulls in every column, empty and blank texts, equal rows, one id twice, long text, clashing column names."""
    line = "this line is long enough to be one of those that repeat in many documents"
    rows = [(k, f"Word{k} and some more words that follow {k}.\n{line}\nlast line {k}", "en", "a", 1, "x", 1, "s") for k in range(8)]
    rows += [(None, f"no id\n{line}", None, None, None, None, None, None), (20, None, "de", "b", None, None, 2, None), (21, "", None, "b", 0, "", 3, ""), (22, " \n\t\n ", "de", None, 3, "", 3, ""), (23, "x", "de", "b", 1, "", 3, "")]
    rows += [(30, f"twice\n{line}", "en", "a", 1, "x", 1, "s")] * 2 + [(31, "one", "en", "a", 1, "x", 1, "s"), (31, "two words", "fr", "a", 1, "x", 1, "s")]
    rows += [(40, "long " * 30_000 + "ending", "en", "c", 1, "x", 1, "s"), (41, "<|endoftext|> ### É\u0130\u4e2d\u6587 'tis  two  spaces\n\n\nx", "fr", "c", 1, "x", 1, "s")]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DDL).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DDL)
