import random

import pytest
from pyspark.sql import types as T

#: Names that operators might be tempted to use for columns of their own.
CLASHING = ["row", "key", "digest", "best", "ties", "salt", "fp", "packed", "cut", "rest", "void", "score", "size", "hash", "doc", "gone"]


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) pairs, with further columns of clashing names."""
    def make(pairs):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                               T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in CLASHING)])
        return spark.createDataFrame([(i, t, None if t is None else len(t), *CLASHING) for i, t in pairs], schema)
    return make


@pytest.fixture(scope="session")
def odd_pairs():
    """Nulls in every column, empty and long texts, ties, repeated rows, characters of all lengths."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared, base, long = prose(60), prose(80), prose(30000)
    pairs = [(i, prose(rng.randint(1, 120))) for i in range(20)]
    pairs += [(100, None), (101, ""), (102, " \n\t "), (None, None), (None, "no id"), (None, "no id"), (103, long), (104, long + " "),
              (105, "same"), (105, "same"), (106, " sa me"), (107, "s a m e"), (108, base), (108, base), (109, base),
              (110, prose(20) + " " + shared + " " + prose(20)), (111, prose(9) + "\n" + shared), (112, shared + " " + shared),
              (113, "日本語 🤦 é   ½ <|endoftext|> </s>"), (114, "A B C"), (115, "a\nb\r\nc"), (116, "x" * 5000), (117, "la " * 500)]
    return pairs
