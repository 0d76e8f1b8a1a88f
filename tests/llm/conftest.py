import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts():
    rows = duckdb.connect().execute(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY doc_id")
    return [r[0] for r in rows.fetchall()]


@pytest.fixture
def docs(spark):
    """Documents of (id, text), with further columns whose names operators use."""

    def build(*rows, more="n_words string, score string, ids string, fp string"):
        extra = len(more.split(","))
        full = [(*row, *["x"] * extra) for row in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {more}")

    return build


ODD = [(1, None), (2, ""), (None, "a b"), (3, " \n\t "), (4, "same"), (4, "same"), (5, "é😀 ñ\x00x")]


@pytest.fixture
def odd():
    return [*ODD, (6, "word " * 40_000), (7, "x" * 50_000)]
