"""A stored triple table that keeps its own statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.graph import JOINED, TripleGraph
from pagemill.operators.skew import HOT_ROWS, HOT_SHARE, hot_in_sketches, key_sketches, merged_sketches
from pagemill.sources.triples import read_triples, write_triples

_SIDES = ("s", "o")


class TripleStore:
    """Triples below `path`/triples, and below `path`/sketches what each append said about its rows.

    A sketch row tells for one predicate the number of rows, the NULLs and the frequent subjects and objects,
    in a size that does not grow with the data. Appends add sketch rows; readers merge them, so no query
    scans triples to find hot values. An append that ends between its two writes leaves statistics behind
    the triples: they steer layouts, and results are the same without them. `rebuild` repairs them.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, triples: DataFrame) -> None:
        """Add triples (s, p, o, lang), which are read twice: hand in a table or a staged result."""
        write_triples(triples, f"{self.path}/triples", mode="append")
        key_sketches(triples, "p", _SIDES).write.mode("append").parquet(f"{self.path}/sketches")

    def rebuild(self) -> None:
        """Take the statistics anew from all triples, and put one row per predicate in the place of the old."""
        fresh = key_sketches(self.triples(), "p", _SIDES)
        fresh.write.mode("overwrite").parquet(f"{self.path}/sketches")

    def triples(self) -> DataFrame:
        return read_triples(self.spark, f"{self.path}/triples")

    def statistics(self) -> DataFrame:
        """One merged sketch row per predicate."""
        return merged_sketches(self.spark.read.parquet(f"{self.path}/sketches"), "p", _SIDES)

    def sizes(self) -> DataFrame:
        """(p, rows) of every predicate, without reading triples."""
        return self.spark.read.parquet(f"{self.path}/sketches").groupBy("p").agg(F.sum("_rows").alias("rows"))

    def graph(
        self, predicates: Sequence[str] = JOINED, share: float = HOT_SHARE, min_rows: int = HOT_ROWS
    ) -> TripleGraph:
        """The graph with the hot values of these predicates, as `TripleGraph.measure` finds them."""
        kept = self.statistics().where(F.col("p").isin(list(predicates)))
        return TripleGraph(self.triples(), hot_in_sketches(kept, "p", _SIDES, share, min_rows))
