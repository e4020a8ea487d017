import pytest
from text_helpers import SMALL



@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    from cartwake.llm.common import on_workers

    on_workers(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, odd characters."""
    long = " ".join(f"w{i % 7001}" for i in range(60_000))
    rows = [
        (1, "Alpha beta, gamma. <|endoftext|> don't Été H̱ ΣΑΣ", "en", "b", 9, "x"),
        (1, "Alpha beta, gamma. <|endoftext|> don't Été H̱ ΣΑΣ", "en", "b", 9, "x"),
        (1, "another text of the same id", None, "a", None, None),
        (2, None, None, None, None, None),
        (None, "no id here but some words", "en", "a", 1, "y"),
        (None, None, None, None, None, None),
        (3, "", "en", "a", 0, "z"),
        (4, " \t\r\n\x0b\x0c ", "en", "😀".encode("utf-16", "surrogatepass").decode("utf-16"), 0, "z"),
        (5, long, "en", "b", len(long), "z"),
        (6, "x", "en", "a", 1, "z"),
        (7, " café  \U0001f600 1,000.50 ... a.b", "fr", "b", 1, "z"),
    ]
    # The last four columns have names that operators use themselves.
    kinds = "doc_id long, text string, lang string, source string, n_chars long, fp string"
    df = spark.createDataFrame(rows, kinds)
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("own") for n in ("score", "n_words", "row", "size", "uses", "start", "hit_runs", "licenses", "n_lines", "rejected_by", "label", "bucket", "component_id", "root")})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
