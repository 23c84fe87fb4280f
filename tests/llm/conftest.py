import random

import pytest
from pyspark.sql import types as T

from tidemark.llm import common

WORDS = [a + b for a in ("ba", "ke", "lu", "mo", "né", "ri", "so", "ta") for b in ("dra", "fel", "gor", "hin", "lop", "mar")]
COLUMNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", "", ".", ",")) for _ in range(words))


def rows_for(texts):
    return [(k, t, "en", f"src{k % 3}", len(t) if t is not None else None) for k, t in texts]


@pytest.fixture(scope="session")
def odd_texts():
    """Plain, null, empty, blank and very long texts, copies, near copies, and a repeated row."""
    base = prose(1, 200)
    near = base.split()
    near[50] = "changed"
    texts = [(k, prose(100 + k, 30 + k)) for k in range(20)]
    texts += [(30, None), (31, ""), (32, " \n\t "), (33, "one"), (34, "A b\x0bC  d\n\n e"), (35, prose(7, 9000))]
    texts += [(40, base), (41, base), (42, " ".join(near)), (43, base.upper()), (44, base), (44, base)]
    return texts


@pytest.fixture(scope="session")
def documents(spark, odd_texts):
    common.find_package(spark)
    return spark.createDataFrame(rows_for(odd_texts), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    common.find_package(spark)
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def clashing(documents):
    """The documents with columns of names the operators use themselves, and a row of nulls."""
    from pyspark.sql import functions as F

    names = ("id", "key", "row", "shard", "score", "toxicity", "entries", "rate", "_tokens", "_key", "_at", "start", "length", "block")
    nulls = documents.limit(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in documents.schema))
    return documents.unionByName(nulls).withColumns({n: F.lit("x") for n in names})
