import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, fp string, component_id string, verdict string,"
    " spans string, key string, chunk string, size string, words string, kept_id string"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and blank texts, ties, repeated rows, a very long
    text, no ids, and columns named like those that operators use inside."""
    plain = "This is a plain line of text that ends well. It has a second sentence, too, and some more words here."
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \n\t ", None, "s", 4),
        (4, plain, "en", None, len(plain)),
        (5, plain, "en", "s", len(plain)),
        (5, plain, "en", "s", len(plain)),
        (6, "é ü ñ 日本 🙂 İ K", "xx", "s", 3),
        (7, LONG, "en", "s", len(LONG)),
        (None, plain + " no id", "en", "s", 1),
        (None, None, None, None, None),
        (8, "Write to a.b@c.example.org or +1 (988) 555-2485. MIT License\nmit license 10.2.3.4", "en", "s", 1),
    ]
    clash = ("c",) * 9
    return spark.createDataFrame([(*r, *clash) for r in rows], ODD_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter(F.lit(False))


def documents(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]
