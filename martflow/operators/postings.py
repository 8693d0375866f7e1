"""Stored postings for text search (C7, C8, G5): texts are tokenized once, when they are stored.

Three tables lie below a path:

* ``postings``: ``term, doc, tf, length, weight``, a row per term of a document, in ranges of
  (term, doc) and sorted, so that a query's terms are found by the files' own statistics and
  a term that a third of the documents have is many files;
* ``terms``: ``term, docs, df``, its documents, and those by weight;
* ``corpus``: documents and length, by weight (one row).

A query reads the terms that it asks for and nothing else.  The few rows of ``terms`` tell
how many postings each has, so an intersection starts with the rarest, and what is left is
broadcast to the next while it is at most :data:`BROADCAST_DOCS` documents.

Documents are distinct in ``doc``; ``weight`` is how often the corpus holds one.  A document
without a token counts in the corpus and is found by nothing; null texts have no tokens.  A
query without a token finds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions import text
from martflow.operators.search import BM25_B, BM25_K1

BROADCAST_DOCS = 500_000    # ids, some 16 bytes each when broadcast


def write_postings(docs: DataFrame, path: str, doc: str, text_col: str, weight: Column, files: int | None = None) -> "Postings":
    """Store the documents' postings below ``path``; ``files`` of the postings table (the
    session's number of shuffle partitions without it)."""
    path, spark = path.rstrip("/"), docs.sparkSession
    rows = docs.select(F.col(doc).alias("doc"), text.tokens(text_col).alias("tokens"), weight.cast("long").alias("weight"))
    each = rows.select("doc", "weight", F.size("tokens").alias("length"), F.explode("tokens").alias("term"))
    # counted in the task that reads the document already, so a row per term is shuffled
    counted = each.groupBy("term", "doc", "length", "weight").agg(F.count(F.lit(1)).cast("int").alias("tf"))
    ranges = (files,) if files else ()
    (counted.repartitionByRange(*ranges, "term", "doc").sortWithinPartitions("term", "doc")
            .select("term", "doc", "tf", "length", "weight").write.parquet(f"{path}/postings"))
    stored = spark.read.parquet(f"{path}/postings")
    (stored.groupBy("term").agg(F.count(F.lit(1)).alias("docs"), F.sum("weight").alias("df"))
           .repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{path}/terms"))
    rows.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("n"),
             F.coalesce(F.sum(F.col("weight") * F.size("tokens")), F.lit(0)).alias("length")).write.parquet(f"{path}/corpus")
    return Postings(spark, path)


class Postings:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def _query(self, q: str) -> list[str]:
        """The query's tokens, by the analyzer of the texts."""
        return self.spark.range(1).select(text.query_tokens(q).alias("t")).first()["t"]

    def _terms(self, tokens: list[str]) -> dict:
        """The rows of ``terms`` for a query's tokens, at most one for each."""
        return {r["term"]: r for r in self._read("terms").where(F.col("term").isin(tokens)).collect()} if tokens else {}

    def _of(self, *terms: str) -> DataFrame:
        return self._read("postings").where(F.col("term").isin(list(terms)))

    def _none(self) -> DataFrame:
        return self._read("postings").select("doc", "weight").where(F.lit(False))

    def _all(self, tokens: list[str], known: dict) -> DataFrame:
        if not tokens or len(known) < len(tokens):
            return self._none()
        rarest, *others = sorted(tokens, key=lambda t: (known[t]["docs"], t))
        found = self._of(rarest).select("doc", "weight")
        small = known[rarest]["docs"] <= BROADCAST_DOCS     # as is every intersection with it
        for t in others:
            side = found.select("doc")
            found = self._of(t).select("doc", "weight").join(F.broadcast(side) if small else side, "doc", "left_semi")
        return found

    def few(self, q: str) -> bool:
        """Whether so few documents can have every token of ``q`` that they may be broadcast."""
        tokens = self._query(q)
        known = self._terms(tokens)
        return len(known) < len(tokens) or min((r["docs"] for r in known.values()), default=0) <= BROADCAST_DOCS

    def match_all(self, q: str) -> DataFrame:
        """``doc, weight`` of the documents that have every token of ``q``."""
        tokens = self._query(q)
        return self._all(tokens, self._terms(tokens))

    def match_any(self, q: str) -> DataFrame:
        """``doc, weight`` of the documents that have a token of ``q``."""
        tokens = self._query(q)
        if not tokens:
            return self._none()
        return self._of(*tokens).select("doc", "weight").distinct()

    def bm25(self, q: str, require_all: bool = True) -> DataFrame:
        """``doc, weight, score``, BM25 of the documents that have all tokens of ``q`` (or
        any of them), from postings and their counts alone."""
        tokens = self._query(q)
        known = self._terms(tokens)
        rows = self._of(*tokens) if tokens else self._read("postings").where(F.lit(False))
        if require_all:
            found = self._all(tokens, known).select("doc")
            small = known and min(r["docs"] for r in known.values()) <= BROADCAST_DOCS
            rows = rows.join(F.broadcast(found) if small else found, "doc", "left_semi")
        corpus = self._read("corpus").first()
        tfs = [F.max(F.when(F.col("term") == t, F.col("tf"))).alias(f"tf{k}") for k, t in enumerate(tokens)]
        docs = rows.groupBy("doc", "weight", "length").agg(*(tfs or [F.lit(0).alias("tf0")]))
        score, mean = F.lit(0.0), F.lit(corpus["length"] / corpus["n"] if corpus["n"] else None).cast("double")
        for k, t in enumerate(tokens):
            n, tf = F.lit(float(known[t]["df"] if t in known else 0)), F.coalesce(F.col(f"tf{k}"), F.lit(0)).cast("double")
            idf = F.log(F.lit(1.0) + (F.lit(corpus["n"]) - n + 0.5) / (n + 0.5))
            norm = tf + F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * F.col("length") / mean)
            score = score + idf * tf * F.lit(BM25_K1 + 1) / norm
        return docs.select("doc", "weight", score.alias("score"))
