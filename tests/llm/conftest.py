import pytest

from tests.conftest import SF, SMOKE, spark  # noqa: F401

#: awkward texts: null, empty, blank, short, repeated, very long, odd characters
AWKWARD = [None, "", " \n\t ", "one", "a b c d", "a b c d", "x " * 50, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich",
           "日本語 текст ﬁ İ", "w" * 5000, "the quick brown fox jumps over the lazy dog " * 3000, "1 2 3 !!! ###"]


@pytest.fixture(scope="session")
def awkward(spark):  # noqa: F811
    rows = [(None if i == 4 else i, t, "en", "s", 0, "clash", 1.5) for i, t in enumerate(AWKWARD)] + [(5, AWKWARD[5], "en", "s", 0, "clash", 1.5)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, score double")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
