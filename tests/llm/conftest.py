import pytest

#: Rows that every operator has to stand: nulls, blanks, repeats, ties, a very long text, and
#: extra columns named like what operators add themselves.
ODD = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en"),
    (2, "one two three four five six seven eight nine ten eleven twelve", "en"),
    (2, "one two three four five six seven eight nine ten eleven twelve", "en"),
    (3, None, "en"),
    (4, "", None),
    (5, " \n\t ", "fr"),
    (None, "a text without an id, me@example.com", "de"),
    (7, "x", None),
    (8, "wörd éa ñ ß 你好 😀 " * 3, "de"),
    (9, "long " * 30_000, "en"),
    (10, "Q" * 200_000, "en"),
    (11, "call +1 (132) 555-1352 or 4111 1111 1111 1111 from 10.0.0.1", None),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, fp long, shard int, length long, __key string"


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, lang, "s", None if t is None else len(t), 5, "k", 6, 7, 8, "z") for i, t, lang in ODD]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def folder(tmp_path):
    """Write tables by name into a folder like the input's."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
