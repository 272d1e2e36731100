import pytest

#: Names that the operators use inside; as extra columns of the input they must do no harm.
CLASHING = "digest kept row hot size head th rid n node band component first copy h y score held_out shard ids".split()

ROWS = [
    (5, "Alpha beta gamma"),
    (9, "aLPHA BETA gamma"),
    (9, "alpha beta gamma"),  # the same doc_id twice
    (9, "alpha beta gamma"),  # and the whole row again
    (2, None),
    (3, ""),
    (None, ""),
    (None, "a text without an id"),
    (4, " \t\r\n "),
    (6, "ÄÖ äö"),
    (7, "äö ÄÖ"),
    (8, "word " * 30_000),  # a very long one
    (1, "<|endoftext|> a b c  d\x1ce"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every oddity, and extra columns whose names clash."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit(None).cast("string") if i % 3 else F.lit(i) for i, c in enumerate(CLASHING)})


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
