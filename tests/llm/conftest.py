import pytest

NAMES = "doc_id long, text string, lang string, source string, n_chars long, h string, place int, label string, item int, block long, k1 long, slice int, counts string, component string"


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows of (doc_id, text[, source])) with extra columns whose names operators use inside."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "h", 1, "l", 2, 3, 4, 5, "c", "x") for r in rows]
        return spark.createDataFrame(full, NAMES)

    return make


@pytest.fixture(scope="session")
def sample():
    """Texts of the smallest tables, and edge cases."""
    import duckdb

    rows = duckdb.connect().execute("SELECT doc_id, text, source FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY 1").fetchall()
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    edge = [(None, "a b c d e f", None), (9001, None, None), (9002, "", "s"), (9003, " \n\t ", "s"), (9004, "one two", "s"), (9005, "one two", None),
            (9006, long, "s"), (9007, long + " more", "s"), (9007, "other text of the same id here now", "s"), (9008, "é É ü\x00x ×中 文", "s"), (9008, "é É ü\x00x ×中 文", "s")]
    return rows + edge
