import pytest

EXTRA = {"source": "s", "n_chars": 1, "text_": "clash", "shard": 9, "slot": 9, "label": 1, "gram": "g", "start": 5, "n": 7}


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang]) rows; with columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    def make(rows, extra=True):
        data = [(r[0], r[1], r[2] if len(r) > 2 else "en") for r in rows]
        df = spark.createDataFrame(data, "doc_id long, text string, lang string")
        if extra:
            for name, value in EXTRA.items():
                df = df.withColumn(name, F.lit(value))
        return df
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    """The documents of the smallest test tables, as a dictionary too."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd_texts():
    long_word = "x" * 5000
    return [None, "", " ", "\n\n", "a", "A a", "one two three", "  two  spaces \n and\tlines ", "é漢字 ٣ <|endoftext|> ok",
            long_word, "word " * 3000, "same text here again", "same text here again", "tail space ", "don't it's we'll",
            "0" * 300, "mixed 123,456.78   nbsp　wide"]
