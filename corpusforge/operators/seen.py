"""X6 across runs: a persistent table of the URLs that earlier runs met.

A run asks which of its links are new and, when done, commits them.  In front
of the exact anti-join stands a Bloom filter of fixed size, a table of ``blocks``
rows of 512 bits: a link whose bits are not all set is new for sure and never
meets the table of URLs.  The filter only saves work; whatever its fill, the
answer is exact.  It meets the links by block, so the side that is joined is as
small as the filter, and Spark broadcasts it if that is small.

A run is committed by its filter, which is written last: a run that died before
is not counted, and the next commit writes its number anew.  Null URLs are
never seen; repeated links are answered each for itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.operators import html as X
from corpusforge.operators.plan_utils import materialize
from corpusforge.sources.io import finished

BLOCKS = 1 << 16  # 4 MB; one for about every 50 URLs keeps false hits rare
WORDS = 8  # of 64 bits in a block
BITS = 6  # set for each URL


def _bits(url: Column) -> list[Column]:
    """The bits of a URL in its block, by word."""
    a, b = F.xxhash64(url), F.xxhash64(url, F.lit("step"))
    places = [F.pmod(F.xxhash64(a, b, F.lit(i)), F.lit(64 * WORDS)) for i in range(BITS)]
    word = [(p / 64).cast("int") for p in places]
    bit = [F.call_function("shiftleft", F.lit(1).cast("bigint"), (p % 64).cast("int")) for p in places]
    return [reduce(lambda x, y: x.bitwiseOR(y), [F.when(w == k, x).otherwise(F.lit(0).cast("bigint")) for w, x in zip(word, bit, strict=True)]) for k in range(WORDS)]


class SeenUrls:
    """The URLs that committed runs met, in a folder."""

    def __init__(self, spark: SparkSession, root: str, blocks: int = BLOCKS):
        self.spark, self.root, self.blocks = spark, root.rstrip("/"), blocks

    def runs(self) -> list[int]:
        """The numbers of the committed runs."""
        return finished(self.spark, f"{self.root}/filter", "run")

    def _block(self, url: Column) -> Column:
        return F.pmod(F.xxhash64(url, F.lit("block")), F.lit(self.blocks)).cast("int")

    def _urls(self) -> DataFrame:
        urls = self.spark.read.schema("url string, run int").parquet(f"{self.root}/urls")
        return urls.filter(F.col("run").isin(self.runs())).select("url")

    def unseen(self, links: DataFrame, url: str = "url") -> DataFrame:
        """The links whose URL no committed run met."""
        runs = self.runs()
        if not runs:
            return links
        names = [f"w{k}" for k in range(WORDS)]
        held = self.spark.read.parquet(f"{self.root}/filter/run={runs[-1]}").select(F.col("block").alias("_block"), F.array(*names).alias("_held"))
        tagged = links.withColumns({"_block": F.coalesce(self._block(F.col(url)), F.lit(-1)), "_asked": F.array(*_bits(F.col(url)))}).join(held, "_block", "left")
        all_set = reduce(lambda x, y: x & y, [F.get("_held", F.lit(k)).bitwiseAND(F.get("_asked", F.lit(k))) == F.get("_asked", F.lit(k)) for k in range(WORDS)])
        tagged = materialize(tagged.withColumn("_maybe", F.coalesce(all_set, F.lit(False))).select(*links.columns, "_maybe"), "bloom")
        known = self._urls().withColumnRenamed("url", "_seen")
        maybe = tagged.filter("_maybe").join(known, F.col(url) == F.col("_seen"), "left_anti")
        return tagged.filter("NOT _maybe").unionByName(maybe).drop("_maybe")

    def commit(self, links: DataFrame, url: str = "url") -> int:
        """Adds a run's links, which :meth:`unseen` gave; returns its number."""
        runs = self.runs()
        number = max(runs, default=0) + 1
        own = links.filter(F.col(url).isNotNull()).select(F.col(url).alias("url")).distinct()
        own.write.mode("overwrite").parquet(f"{self.root}/urls/run={number}")
        own = self.spark.read.schema("url string").parquet(f"{self.root}/urls/run={number}")
        rows = own.select(self._block(F.col("url")).alias("block"), *[x.alias(f"w{k}") for k, x in enumerate(_bits(F.col("url")))])
        if runs:
            rows = rows.unionByName(self.spark.read.parquet(f"{self.root}/filter/run={runs[-1]}"))
        merged = rows.groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)])
        merged.write.mode("overwrite").parquet(f"{self.root}/filter/run={number}")
        return number


def crawl_run(seen: SeenUrls, listing: DataFrame, fetched: DataFrame, fields=None, region_tag: str = "nav", region_class: str | None = None,
              suffix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One run over listing pages: the links that are new, each by its first sighting, and their articles.  The run is committed.

    Pages of links that earlier runs met are neither joined nor extracted.
    """
    links = X.dedupe_links_first(X.page_links(listing, region_tag, region_class, suffix))
    links = materialize(seen.unseen(links), "new-links")
    articles = materialize(X.articles_of(links, fetched, fields), "new-articles")
    seen.commit(links)
    return links, articles
