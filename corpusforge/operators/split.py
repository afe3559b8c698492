"""Seeded shuffle and train/validation/test split.

Rows are ordered by ``md5('{seed}:{key}')``.  The exact split does not move
them: rows are counted per hash bucket (``16**prefix_hex`` rows at most,
whatever the table size), which shows the two buckets that hold the cut
points; only those buckets' hashes are ranked, which gives two threshold
hashes; every row is then labelled where it is, by comparing its own hash.

The order itself (G1, :func:`global_rank`) is the position in the same order:
``row_number`` inside each bucket plus the bucket's offset, for keys only.

A null key is ordered as the empty string.  Equal keys are ordered by a digest
of the ``tiebreak`` columns; rows equal in those too are told apart by nothing
and get the same label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusforge.sources.io import finished

# The seed and cut points of the reference split.
SEED = 42
TRAIN_FRACTION = 0.7
VALIDATION_END = 0.85


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def shuffle_key(key, seed: int = SEED) -> Column:
    """G1: the seeded sort key ``md5('{seed}:{key}')`` (hex string; a null key counts as '')."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(_c(key).cast("string"), F.lit(""))))


def global_rank(
    df: DataFrame,
    key: str,
    seed: int = SEED,
    prefix_hex: int = 4,
    rank_col: str = "pos",
    tiebreak=(),
) -> DataFrame:
    """Add the 1-based position of each row in the seeded order (G1).  Give it keys, not whole rows: it sorts them."""
    if not 1 <= prefix_hex <= 5:
        raise ValueError("prefix_hex must be in 1..5 (bucket table <= 16**5 rows)")
    h = df.withColumn("_h", shuffle_key(key, seed)).withColumn("_b", F.substring("_h", 1, prefix_hex))
    counts = h.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    # Bounded (<= 16**prefix_hex rows): a single-partition window is fine here.
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_b",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
    )
    within = Window.partitionBy("_b").orderBy("_h", _c(key), *[_c(c) for c in tiebreak])
    out = h.join(F.broadcast(offsets), "_b")
    return out.withColumn(rank_col, (F.col("_off") + F.row_number().over(within)).cast("bigint")).drop("_h", "_b", "_off")


def _bucket_counts(keys: DataFrame, prefix_hex: int) -> DataFrame:
    """``b, cnt``: rows by the first digits of their hash (``16**prefix_hex`` rows at most)."""
    return keys.groupBy(F.substring("h", 1, prefix_hex).alias("b")).agg(F.count(F.lit(1)).alias("cnt"))


def _cut_buckets(counts: DataFrame, train: float, val_end: float) -> DataFrame:
    """``b, off, c1, c2``: the buckets (two at most) that hold a cut point, the rows before them, and the cut points still to be found there."""
    # bounded (<= 16**prefix_hex rows): single-partition windows are fine here
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.select("b", "cnt", F.coalesce(F.sum("cnt").over(before), F.lit(0)).alias("off"), F.sum("cnt").over(Window.partitionBy()).alias("n"))
    held = lambda x: F.floor(F.lit(float(x)) * F.col("n"))
    holds = lambda x: F.when((held(x) > F.col("off")) & (held(x) <= F.col("off") + F.col("cnt")), held(x))
    cut = buckets.select("b", "off", holds(train).alias("c1"), holds(val_end).alias("c2"))
    return cut.filter("c1 IS NOT NULL OR c2 IS NOT NULL")


def _thresholds(keys: DataFrame, cut: DataFrame, prefix_hex: int) -> DataFrame:
    """One row ``t1, t2``: the ``h, tie`` of the last train and the last validation row.

    Equal rows are counted before they are put in order, so a key that a third of all rows have is one row.
    """
    near = keys.withColumn("b", F.substring("h", 1, prefix_hex)).join(F.broadcast(cut), "b")
    near = near.groupBy("b", "off", "c1", "c2", "h", "tie").agg(F.count(F.lit(1)).alias("same"))
    upto = F.col("off") + F.sum("same").over(Window.partitionBy("b").orderBy("h", "tie"))
    ranked = near.withColumn("upto", upto)
    pick = lambda c: F.min(F.when(F.col("upto") >= F.col(c), F.struct("h", "tie")))
    return ranked.agg(pick("c1").alias("t1"), pick("c2").alias("t2"))


def _hash_and_tie(key: str, seed: int, tiebreak) -> tuple[Column, Column]:
    return shuffle_key(key, seed), F.md5(F.to_json(F.struct(*[_c(c) for c in tiebreak]))) if tiebreak else F.lit("")


def _label(h: Column, tie: Column, t1: tuple[Column, Column], t2: tuple[Column, Column]) -> Column:
    """The split of a row by its place against the two thresholds (null ones are before everything)."""
    upto = lambda t: F.coalesce((h < t[0]) | ((h == t[0]) & (tie <= t[1])), F.lit(False))
    return F.when(upto(t1), "train").when(upto(t2), "validation").otherwise("test")


def split_exact(df: DataFrame, key: str, seed: int = SEED, prefix_hex: int = 4, tiebreak=()) -> DataFrame:
    """Exact 70/15/15 split in the seeded order, as a ``split`` column (no row is shuffled)."""
    if not 1 <= prefix_hex <= 5:
        raise ValueError("prefix_hex must be in 1..5 (bucket table <= 16**5 rows)")
    h, tie = _hash_and_tie(key, seed, tiebreak)
    keys = df.select(h.alias("h"), tie.alias("tie"))
    cuts = _thresholds(keys, _cut_buckets(_bucket_counts(keys, prefix_hex), TRAIN_FRACTION, VALIDATION_END), prefix_hex)
    t1, t2 = ((cuts.select(f"{name}.h").scalar(), cuts.select(f"{name}.tie").scalar()) for name in ("t1", "t2"))
    return df.withColumn("split", _label(h, tie, t1, t2))


class GrowingSplit:
    """G2 under appends: the exact split of a table that grows, without reading old rows again.

    A folder holds, by append, the rows' seeded hashes (``keys``, by their first
    two digits), bucket counts (``counts``) and the two thresholds.  An append
    adds its own keys and counts; the merged counts show the buckets that
    now hold the cut points, and only their keys are read.  Rows between an old and
    a new threshold change their label, and no others do: :meth:`changes` reads
    the keys of that range alone.  An append that failed is not counted and
    written anew by the next one.

    The key must tell rows apart, or ``tiebreak`` columns with it; equal rows
    get equal labels.  A null key counts as ''.
    """

    PREFIX = 4

    def __init__(self, spark: SparkSession, root: str, key: str, seed: int = SEED, tiebreak=()):
        self.spark, self.root, self.key, self.seed, self.tiebreak = spark, root.rstrip("/"), key, seed, tuple(tiebreak)

    def appends(self) -> list[int]:
        """The numbers of the finished appends."""
        return finished(self.spark, f"{self.root}/thresholds", "append")

    def _keys(self, upto: int, prefixes: list[str]) -> DataFrame:
        keys = self.spark.read.schema("key string, h string, tie string, append int, b2 string").parquet(f"{self.root}/keys")
        return keys.filter(F.col("append").isin([a for a in self.appends() if a <= upto] + [upto]) & F.col("b2").isin(prefixes))

    def append(self, df: DataFrame) -> int:
        """Adds rows; returns the number of the append."""
        number = max(self.appends(), default=-1) + 1
        h, tie = _hash_and_tie(self.key, self.seed, self.tiebreak)
        rows = df.select(_c(self.key).cast("string").alias("key"), h.alias("h"), tie.alias("tie"), F.substring(h, 1, 2).alias("b2"))
        folder = f"{self.root}/keys/append={number}"
        rows.repartition("b2").write.mode("overwrite").partitionBy("b2").parquet(folder)
        own = self.spark.read.schema("key string, h string, tie string, b2 string").parquet(folder)
        before = [f"{self.root}/counts/append={number - 1}"] if number else []
        counts = _bucket_counts(own, self.PREFIX)
        for path in before:  # the counts of an append are those of all rows so far
            counts = counts.unionByName(self.spark.read.parquet(path)).groupBy("b").agg(F.sum("cnt").alias("cnt"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/counts/append={number}")
        cut = self.spark.read.schema("b string, cnt bigint").parquet(f"{self.root}/counts/append={number}")
        cut = _cut_buckets(cut, TRAIN_FRACTION, VALIDATION_END)
        prefixes = sorted({r.b[:2] for r in cut.collect()})  # two rows at most
        found = _thresholds(self._keys(number, prefixes), cut, self.PREFIX)
        found.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/thresholds/append={number}")
        return number

    def thresholds(self, number: int) -> list[tuple]:
        """The last train and the last validation row's ``h, tie`` after an append; None where there is none."""
        r = self.spark.read.parquet(f"{self.root}/thresholds/append={number}").first()
        return [tuple(t) if t else (None, None) for t in (r.t1, r.t2)]

    def label(self, df: DataFrame, number: int | None = None) -> DataFrame:
        """``df`` with ``split`` as of an append, the last one by default."""
        h, tie = _hash_and_tie(self.key, self.seed, self.tiebreak)
        t1, t2 = self.thresholds(max(self.appends()) if number is None else number)
        return df.withColumn("split", _label(h, tie, *[tuple(F.lit(x).cast("string") for x in t) for t in (t1, t2)]))

    def changes(self, number: int) -> DataFrame:
        """``key, tie, old, new``: the rows of earlier appends whose label the append changed."""
        old, new = self.thresholds(number - 1), self.thresholds(number)
        ranges = [sorted((a, b)) for a, b in zip(*[[(t[0] or "", t[1] or "") for t in ts] for ts in (old, new)], strict=True)]
        digits = "0123456789abcdef"
        prefixes = [x + y for x in digits for y in digits if any(a[0][:2] <= x + y <= b[0][:2] for a, b in ranges)]
        keys = self._keys(number - 1, prefixes)
        near = F.lit(False)
        for a, b in ranges:
            near = near | F.col("h").between(a[0], b[0])
        label = lambda ts: _label(F.col("h"), F.col("tie"), *[tuple(F.lit(x).cast("string") for x in t) for t in ts])
        return keys.filter(near).select("key", "tie", label(old).alias("old"), label(new).alias("new")).filter("old <> new")


def hash_unit(key, seed: int = SEED) -> Column:
    """A uniform value in [0, 1) from the first 32 bits of the seeded md5."""
    return F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def split_hash(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """One-pass split by hash threshold (no shuffle; sizes approximate,
    assignment stable when rows are appended)."""
    u = hash_unit(key, seed)
    label = F.when(u < TRAIN_FRACTION, "train").when(u < VALIDATION_END, "validation").otherwise("test")
    return df.withColumn("split", label)


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows per split plus the ``total`` row.  An exact split's sizes follow
    from the row count alone, so nothing is ranked."""
    n = F.count(F.lit(1))
    cut1, cut2 = F.floor(F.lit(TRAIN_FRACTION) * F.col("n")).cast("bigint"), F.floor(F.lit(VALIDATION_END) * F.col("n")).cast("bigint")
    sizes = {"train": cut1, "validation": cut2 - cut1, "test": F.col("n") - cut2, "total": F.col("n")}
    rows = F.array(*[F.struct(F.lit(k).alias("split"), v.alias("n")) for k, v in sizes.items()])
    return df.agg(n.alias("n")).select(F.explode(rows).alias("r")).select("r.*").filter("n > 0 OR split = 'total'")
