import pytest

SMALL_SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, n_bytes string, \
label int, __id string, __hash string, __text string, `a.b` string"


@pytest.fixture(scope="session")
def messy(spark):
    """Null, empty, blank, long, tied and repeated documents, with columns whose names clash."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()
    plain = " ".join(words[(i * i + i // 3) % len(words)] for i in range(80)) + "."
    long = " ".join(f"{words[i % 17]}{i * 7919 % 9973}" for i in range(60_000))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, plain, "en", "b"),
            (5, plain, "en", "b"), (6, long, "en", "b"), (7, "Ünïcödé ßtraße 漢字 😀 " * 5, "de", None),
            (8, "one", "fr", "a"), (8, "one", "fr", "a"), (None, plain, None, "c"), (9, "12 34 !!", "es", "c"),
            (10, plain.upper(), "en", "c"), (11, "x" * 5000, "en", "a")]
    return spark.createDataFrame([(*r, 0, "s", "b", 7, "i", "h", "t", "d") for r in rows], DOCS).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


