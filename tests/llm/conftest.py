import datetime as dt

import pytest
from pyspark.sql import functions as F

from llm_cases import ODD


@pytest.fixture
def documents(spark):
    """Build documents from (doc_id, text) pairs, with the other columns of the table and one that clashes."""
    def build(pairs, **columns):
        schema = "doc_id long, text string"
        df = spark.createDataFrame([(i, t) for i, t in pairs], schema)
        return df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"),
                         F.char_length("text").cast("long").alias("n_chars"),
                         F.lit(dt.date(2024, 1, 1)).alias("kept"), F.lit("x").alias("spans"), F.lit(1).alias("size"))
    return build


@pytest.fixture
def odd(documents):
    pairs = list(enumerate(ODD)) + [(None, "no id at all"), (3, "word"), (3, "another text with the id three")]
    return documents(pairs)
