import pytest

SMALL = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"

#: Extra columns whose names the operators also use inside.
CLASHES = "row long, digest string, rank int, k int, id long, label string, fp long, at int, keep_id long, first int"
COLUMNS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"


def frame(spark, rows):
    """Documents from (doc_id, text[, lang[, source]]), with clashing columns."""
    full = []
    for r in rows:
        r = tuple(r) + (None,) * (4 - len(r))
        full.append(r + (len(r[1] or ""),) + (1, "x", 2, 3, 4, "y", 5, 6, 7, 8))
    return spark.createDataFrame(full, COLUMNS)


LONG = " ".join(f"w{i % 977} x{i % 89}" for i in range(30_000))
EDGES = [
    (1, "a b  c"), (2, "a b\tc"), (3, None), (4, ""), (5, "   "), (None, "a b c"), (6, "a b c"), (6, "a b c"),
    (7, LONG), (8, LONG + " tail"), (9, "¡Ñandú! ǅ ²³ Ⅳ"), (10, "x" * 5000), (11, "\n\n \t"), (12, "12345 678"),
    (None, None), (13, "l'été où naïve"), (14, "\U0001F600\U0001F600 emoji\x1c sep\x85 end"),
]


@pytest.fixture(scope="session")
def edges(spark):
    return frame(spark, EDGES).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, []).cache()
