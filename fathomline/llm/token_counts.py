"""Delta-maintained token counts.

Totals by source, language and tokenizer version are sums over a ledger of committed batches.
A batch holds signed counts: +1 document and its tokens for an insert, the negative for a delete, and
the difference for a revised count. It is written under its own name and counts once its commit
marker is there; committing the same batch again changes nothing.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import col
from fathomline.session import scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VERSION = "byte_bpe_50k"
# Fixed value: the pattern this vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ["source", "lang", "tokenizer"]
LEDGER = "source string, lang string, tokenizer string, docs long, tokens long"


def encoding(vocabulary: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counter(vocabulary: str = VOCABULARY):
    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoding(vocabulary)
        for batch in texts:
            yield pd.Series([len(encoder.encode_ordinary(t)) if t else 0 for t in batch], dtype="int64")

    return count


def counted(docs: DataFrame, vocabulary: str = VOCABULARY, version: str = VERSION, text: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens) of every row; null and empty texts have 0 tokens."""
    tokens = counter(vocabulary)(col(text)).alias("tokens")
    return docs.select("doc_id", "source", "lang", F.lit(version).alias("tokenizer"), tokens)


def inserts(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, F.lit(1).cast("long").alias("docs"), "tokens")


def deletes(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed rows that turn the old counts into the new ones; a document that changed its source or language moves."""
    return deletes(old).unionByName(inserts(new))


class Ledger:
    """A folder with one table per committed batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """Committed batches; a batch whose write was cut off has no marker and is not one."""
        root = self._path(self.folder)
        if not self._files.exists(root):
            return []
        names = [str(s.getPath().getName()) for s in self._files.listStatus(root)]
        return sorted(n for n in names if self._files.exists(self._path(f"{self.folder}/{n}/_SUCCESS")))

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Add a batch of signed rows (source, lang, tokenizer, docs, tokens); False if it was committed before."""
        if batch in self.batches():
            return False
        sums = signed.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.folder}/{batch}")
        return True

    def totals(self) -> DataFrame:
        """Totals per source, language and tokenizer; null keys are groups of their own, groups with nothing left have no row."""
        paths = [f"{self.folder}/{b}" for b in self.batches()]
        rows = self.spark.read.schema(LEDGER).parquet(*paths) if paths else self.spark.createDataFrame([], LEDGER)
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter((F.col("docs") != 0) | (F.col("tokens") != 0))


def op2_token_counts(docs: DataFrame) -> DataFrame:
    """Totals over all documents, loaded in two batches of which the first is sent twice."""
    spark = docs.sparkSession
    ledger = Ledger(spark, scratch_path(spark, "token-ledger"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    for batch in (0, 1, 0):
        ledger.commit(f"load-{batch}", inserts(counted(docs.filter(half == batch))))
    return ledger.totals()
