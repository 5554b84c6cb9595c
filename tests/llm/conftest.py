import os
import re

import duckdb
import pytest

SMOKE = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def table(name, sf_dir=SMOKE):
    """A test table as a list of dicts, read without Spark."""
    path = f"{sf_dir}/{name}.parquet"
    con = duckdb.connect()
    cur = con.execute(f"select * from '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    cols = [d[0] for d in cur.description]
    return [dict(zip(cols, r)) for r in cur.fetchall()]


# nulls in every column, empty, blank and very long texts, ties, repeated rows
_LONG = " ".join(f"w{i % 997} x{i % 31}" for i in range(40_000))
_PROSE = "The first line has several words in it.\nThe second line is here, too, with words.\nA third line follows them both."
EDGE_ROWS = [
    (1, _PROSE, "en", "a", 10), (1, _PROSE, "en", "a", 10),           # a repeated row
    (2, _PROSE, "en", "b", 10),                                       # a copy
    (2, "another text under the same id", "en", "b", 5),              # a tie in doc_id
    (3, None, "en", "a", None), (4, "", None, None, 0), (5, " \n\t ", "fr", "b", 4),
    (6, _LONG, "fr", None, len(_LONG)), (None, "a text without an id", "en", "a", 3), (None, None, None, None, None),
    (7, "Ünïcödé ñandú 東京 🙂  two  spaces nbsp\r\nand\ttabs", "de", "b", 9), (8, "x", "de", "b", 1), (9, "123 456 !!!", "es", "a", 11),
]
# names that operators use inside or return
CLASHES = ("fp", "tie", "row", "node", "block", "role", "rate", "copies", "shuffle_key", "score", "labels", "component_id", "best_id",
           "text_hash", "n_words", "kept", "removed_lines", "runs_doc_id", "n_tokens", "start", "length", "lang_pred", "mix_source", "words")


@pytest.fixture(scope="session")
def edge(spark):
    df = spark.createDataFrame(EDGE_ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHES:
        from pyspark.sql import functions as F

        df = df.withColumn(c, F.lit(f"extra {c}"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMOKE}/documents.parquet")


@pytest.fixture(scope="session")
def rows():
    return table("documents")
