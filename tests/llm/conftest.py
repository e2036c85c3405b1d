
import pytest

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Texts that trip naive code: null, empty, blank, one word, ties, very long.
ODD = [None, "", "   \n\t", "one", "one", "two words", "Two  WORDS", "a b c", "a b c",
       "<|endoftext|> in <|endoftext|>text", "né à Zürich 漢字 🙂", "x" * 50_000,
       "long " * 30_000, "  leading and trailing  ", " nbsp ", "tab\tnew\nline\r\nend"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en", None if i % 5 == 0 else f"src{i % 3}", len(t or "")) for i, t in enumerate(ODD)]
    rows += [rows[3], (None, "null id text", "en", "src0", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, docs):
    """Extra columns under the names that operators use for their own."""
    from pyspark.sql import functions as F
    names = ["size", "bytes", "tokens", "rows", "block", "bin", "chunk", "shard", "slot", "piece",
             "start", "length", "ids", "offset", "rank", "key", "score", "label", "digest", "bands",
             "sketch", "n", "host", "hash", "keep", "component", "target", "draws", "words", "number"]
    return docs.limit(30).withColumns({x: F.lit("clash") for x in names})


