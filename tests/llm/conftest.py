"""Awkward documents that every operator has to take."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, print string, words string, found string"
LONG = "Über the river " * 9000 + "\n" + "x" * 40_000 + " end"


def awkward():
    """(doc_id, text, lang): nulls in every column, empty and long texts, repeated rows and ids, odd white space."""
    return [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en"),
        (2, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en"),
        (2, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en"),
        (3, "Der schnelle braune Fuchs springt über den faulen Hund am Fluß.", "de"),
        (3, "Other text for the same id.", None),
        (4, None, "en"),
        (5, "", None),
        (6, " \n\t ", "en"),
        (None, "no id at all here", "en"),
        (None, None, None),
        (7, "\x1c\x85 it's 12²  'll d ÀÉ 你好 \U0001f600 <|endoftext|> [INST] </s>", "en"),
        (8, LONG, "en"),
        (9, "word", "de"),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, text, lang, None, None, 5, "p", "w", "f") for i, text, lang in awkward()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture
def store(tmp_path):
    """A folder of tables like the ones that queries read."""

    def save(**tables):
        for name, frame in tables.items():
            frame.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return save
