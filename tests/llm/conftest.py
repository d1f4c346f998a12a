import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType())]
)


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text, lang, source) rows; missing ends are null. Extra columns clash with working names."""

    def make(rows, extra=True):
        df = spark.createDataFrame([tuple(r) + (None,) * (4 - len(r)) for r in rows], DOCS).repartition(3)
        if extra:
            from pyspark.sql import functions as F

            for name in ("row", "f", "n", "keys", "node", "start", "size", "found", "kept"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


WORDS = "amber birch cedar delta ember frost grove haven iris jade koi lotus maple north olive pearl quartz ridge stone tulip umber violet willow".split()


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))
