"""Operator 5, embedding near-dedup: cross-polytope hashing.

A unit vector is turned by three rounds of random signs and a fast Hadamard
transform; its hash is the axis it then lies nearest to, with its sign.  A table
takes three such hashes; a vector goes into its own bucket of each table and,
as probes, into those where one hash is the second nearest axis instead.  Pairs
that meet in a bucket are verified by their cosine in double precision.

``n_links`` counts every linked partner once: a pair counts in the first table,
and there the smallest bucket, that both vectors are in.

Scale: equal vectors of a label collapse to one representative, with their
number, before any hashing; partners count with that number, and copies are
linked to the representative by a join.  Buckets hold one label's distinct
vectors, and are worked through in blocks of about ``block`` vectors, each pair
of blocks a group of its own.  A group gives at most one count per vector and
the links that join its components, never all pairs.  With 12 tables of 4 buckets, a pair of 64-dimensional vectors at the
threshold is missed less than once in 10,000, closer ones practically never.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and those without label or vec_id, link with nothing;
rows that repeat vec_id, label and vector are one vector (every row is given
its result), those that repeat the vec_id alone add up under it; vectors of
different length never link; extra columns are not read; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.graph import components
from corpusforge.operators.plan_utils import materialize

THRESHOLD = 0.93
TABLES = 12
HASHES = 3  # in a table
PROBES = 1 + HASHES
BLOCK = 1000
SEED = 5


@lru_cache(8)
def _signs(dim: int) -> np.ndarray:
    """Random signs of the three rounds of every rotation."""
    rng = np.random.default_rng([SEED, dim])
    return rng.choice(np.array([-1.0, 1.0]), (TABLES * HASHES, 3, dim))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the last axis (a power of two), without scaling."""
    n, h = x.shape[-1], 1
    while h < n:
        x = x.reshape(*x.shape[:1], n // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(x.shape[0], n)
        h *= 2
    return x


def buckets(x: np.ndarray) -> np.ndarray:
    """For each unit vector, table and probe: the bucket (rows x TABLES x PROBES), sorted within a table."""
    dim = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    out = np.empty((len(x), TABLES, PROBES), np.int64)
    for t in range(TABLES):
        near = []
        for k in range(HASHES):
            y = x
            for signs in _signs(dim)[t * HASHES + k]:
                y = hadamard(y * signs)
            top = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            size = np.take_along_axis(np.abs(y), top, 1)
            top = np.where((size[:, :1] >= size[:, 1:]), top, top[:, ::-1])
            near.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
        for probe in range(PROBES):
            code = np.zeros(len(x), np.int64)
            for k in range(HASHES):
                code = code * (2 * dim) + near[k][:, 1 if probe == k + 1 else 0]
            out[:, t, probe] = code * TABLES + t
    return np.sort(out, axis=2)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision (scaled first, so that no square overflows)."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def hashed(vector: Column) -> Column:
    """Struct of the vector's bytes, its number of components and its buckets; null where it cannot be compared."""

    @F.arrow_udf("vec binary, dim int, buckets array<bigint>")
    def run(column: pa.Array) -> pa.Array:
        raw, dims, codes = ([None] * len(column) for _ in range(3))
        by_dim: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, v in enumerate(column):
            if v.is_valid and len(v.values) and not v.values.null_count:
                x = v.values.to_numpy(zero_copy_only=False)
                if np.isfinite(x).all() and x.any():
                    by_dim.setdefault(len(x), []).append((i, x))
        for dim, found in by_dim.items():
            unit = _unit(np.stack([x for _, x in found]))
            for (i, x), code in zip(found, buckets(unit).reshape(len(found), -1), strict=True):
                raw[i], dims[i], codes[i] = x.tobytes(), dim, code
        out = [pa.array(raw, pa.binary()), pa.array(dims, pa.int32()), pa.array(codes, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(out, names=["vec", "dim", "buckets"], mask=pa.array([r is None for r in raw], pa.bool_()))

    return run(vector)


def _first_meeting(a: np.ndarray, b: np.ndarray, bucket: int) -> np.ndarray:
    """True for the pairs (rows of a and b) that meet first in ``bucket``: in no earlier table, and in no smaller bucket of its table."""
    table = bucket % TABLES
    earlier = (a[:, :table, :, None] == b[:, :table, None, :]).any(axis=(1, 2, 3))
    here = a[:, table, :, None] == b[:, table, None, :]
    return ~earlier & ~(here & (a[:, table, :, None] < bucket)).any(axis=(1, 2))


def _linked(x: np.ndarray, block: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose cosine reaches the threshold (of different blocks only, if ``cross``)."""
    found = []
    for lo in range(0, len(x), 256):
        i, j = np.nonzero(x[lo:lo + 256] @ x.T >= THRESHOLD)
        i += lo
        use = (i < j) & (block[i] != block[j]) if cross else i < j
        found.append((i[use], j[use]))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _group(rows: list, bucket: int, cross: bool) -> list[tuple]:
    """Counts of linked partners, and links that join components, of one group."""
    n, dim = len(rows), rows[0].dim
    kind = f"f{len(rows[0].vec) // dim}"  # single or double precision, as in the table
    x = _unit(np.frombuffer(b"".join([r.vec for r in rows]), kind).reshape(n, dim))
    i, j = _linked(x, np.array([r.block for r in rows]), cross)
    if not len(i):
        return []
    # a pair counts where it meets first
    some, at = np.unique(np.concatenate((i, j)), return_inverse=True)
    code = np.array([rows[k].buckets for k in some]).reshape(-1, TABLES, PROBES)
    first = np.concatenate([_first_meeting(code[a], code[b], bucket) for a, b in zip(*(np.array_split(y, 1 + len(i) // 100_000) for y in np.split(at, 2)), strict=True)])
    i, j = i[first], j[first]
    copies = np.array([r.copies for r in rows], np.int64)
    count = np.zeros(n, np.int64)
    np.add.at(count, i, copies[j])
    np.add.at(count, j, copies[i])
    parent, links = list(range(n)), []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[rb] = ra
            links.append((rows[a].id, rows[b].id))
    return [(None, None, rows[k].key, int(count[k])) for k in np.flatnonzero(count)] + [(a, b, None, 0) for a, b in links]


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over a partition sorted by group."""
    key, held, out = None, [], []
    rows = chain.from_iterable(pdf.itertuples(index=False) for pdf in batches)
    for r in chain(rows, [None]):
        now = r and (r.label, r.dim, r.bucket, r.bi, r.bj)
        if now != key:
            if len(held) > 1:
                out += _group(held, key[2], key[3] != key[4])
            key, held = now, []
        if len(out) > 10_000 or r is None:
            yield pd.DataFrame(out, columns=["a", "b", "key", "n"]).astype({"a": "Int64", "b": "Int64", "n": "Int64"})
            out = []
        held.append(r)


def vector_links(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b, key, n`` from distinct vectors ``id, key, copies, label, vec, dim, buckets``: links (with b) and counts of partners of a key (b null)."""
    keys = ["label", "dim", "bucket"]
    flat = rows.select("key", "label", "dim", F.explode("buckets").alias("bucket"))
    sizes = flat.groupBy(*keys).agg(F.count("*").alias("size")).filter("size > 1")
    member = flat.join(sizes, keys).withColumn("blocks", F.ceil(F.col("size") / block))
    member = member.withColumn("block", F.expr("pmod(xxhash64(key), blocks)")).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    member = member.select("key", *keys, "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))
    # the vectors come last, only for those that share a bucket
    full = member.join(rows.select("id", "key", "copies", "vec", "buckets"), "key")
    full = full.repartition(*keys, "bi", "bj").sortWithinPartitions(*keys, "bi", "bj", "id", "key")
    return full.mapInPandas(_groups, "a bigint, b bigint, key binary, n bigint")


def distinct_vectors(rows: DataFrame, members: DataFrame) -> DataFrame:
    """One row per ``key`` of ``rows`` (``key, label, v``): the smallest id and the number of its ``members`` (``id, key``), and its hashes."""
    sizes = members.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    one = rows.select("key", "label", "v").dropDuplicates(["key"])
    return one.select("key", "label", hashed(F.col("v")).alias("h")).filter("h IS NOT NULL").join(sizes, "key").select("id", "key", "copies", "label", "h.*")


def vector_classes(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    rows = table.filter(table[label].isNotNull() & table[vec_id].isNotNull())
    rows = rows.select(rows[vec_id].cast("bigint").alias("id"), rows[label].alias("label"), rows[vector].alias("v"))
    # equal in key: equal in label and vector
    rows = rows.withColumn("key", F.unhex(F.md5(F.to_json(F.struct("label", "v")))))
    members = materialize(rows.select("id", "key").distinct(), "members")
    vectors = materialize(distinct_vectors(rows, members), "vectors")
    found = materialize(vector_links(vectors), "vector-links")
    partners = found.filter("b IS NULL").groupBy("key").agg(F.sum("n").alias("n"))
    each = vectors.select("key", F.col("id").alias("first"), "copies").join(partners, "key", "left")
    each = materialize(each.select("key", "first", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")).filter("n > 0"), "partners")
    linked = materialize(members.join(each, "key").select("id", "first", "n"), "linked")
    counts = linked.groupBy("id").agg(F.sum("n").alias("n_links"))
    links = found.filter("b IS NOT NULL").select("a", "b").unionByName(linked.select(F.col("id").alias("a"), F.col("first").alias("b")))
    classes = components(links).withColumnRenamed("node", "id")
    out = table.select(table[vec_id].cast("bigint").alias("vec_id")).join(counts.join(classes, "id"), F.col("vec_id") == F.col("id"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
