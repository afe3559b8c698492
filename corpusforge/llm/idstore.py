"""Operator 13, token-id output: raw id shards under a minimal perfect hash index.

``write_ids`` encodes every text, appends the end id and writes the ids, and
nothing else, to shards: documents in ascending key order, little-endian, in
16 bits if the vocabulary fits and in 32 else.  A document's key is its id and
a copy number (0, but for rows that repeat an id).  Keys are dealt by digest to
index files of about ``PART_KEYS``; each holds a minimal perfect hash of its keys
(levels of bit arrays; a key that meets no other in a level has its bit there, and the
bits before it are its slot) and, by slot, the key's fingerprint, shard, offset
and length.  A look-up reads a word per level and one slot, whatever the number
of documents, and a slot with another fingerprint tells that the key is not there.

Scale: one shuffle, of the texts into key order; a key that a third of all rows
have is cut by further sort columns.  Shards are as large as Spark makes their partitions.
Index files, shards and look-ups are tasks of their own; the driver sees the
number of documents.  A repeated task writes the same file again.

The folder holds ``shard-*.ids``, ``index-*.mph``, ``format.json``, and as
Parquet ``keys`` (key, copy) and ``shards`` (shard, documents, ids, and ids in the shards before).

Defined results: a null text is empty and gives the end id alone; rows without
an id come last; rows that repeat an id are documents of their own, by text
digest; keys that were not written are not found; extra columns are not read;
an empty table gives no shard, no index file and an empty table.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusforge.llm import encode
from corpusforge.llm import words as W
from corpusforge.llm.files import folder, whole_file
from corpusforge.session import scratch_path

END_ID = 0
PART_KEYS = 100_000  # keys in an index file, about
LOAD = 2  # bits of a level for each key that comes to it
MAX_LEVELS = 64
FLUSH = 1 << 22  # bytes of ids handed on at once

MAGIC = b"IDSMPH01"
HEADER = struct.Struct("<8sQQQ")  # magic, keys, levels, 64-bit words of all levels
SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u4")])
U = np.uint64


# ---------------------------------------------------------------------------
# keys and their minimal perfect hash
# ---------------------------------------------------------------------------
def key_digest(key, copy: int = 0) -> bytes:
    return hashlib.md5(f"{'n' if key is None else f'k{key}'}\n{copy}".encode(), usedforsecurity=False).digest()


def key_digest_column(key: Column, copy: Column) -> Column:
    """:func:`key_digest` as hexadecimal text."""
    return F.md5(F.concat(F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n")), F.lit("\n"), copy.cast("string")))


def _part(hexdigest: Column, parts: int) -> Column:
    return (F.conv(F.substring(hexdigest, 1, 8), 16, 10).cast("bigint") % parts).cast("int")


def _halves(digests: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(digests, ">u8").reshape(-1, 2).astype(U)
    return both[:, 0], both[:, 1]


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return (W.mix(a + (b | U(1)) * U(level + 1)) % U(size)).astype(np.int64)


def _fingerprint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (W.mix(a ^ (b << U(1))) >> U(32)).astype(np.uint32)


def build_index(digests: bytes, shard: np.ndarray, offset: np.ndarray, n: np.ndarray) -> bytes:
    """An index file: header, sizes of the levels, their bits, set bits before each word, slots."""
    a, b = _halves(digests)
    rest, levels = np.arange(len(a)), []
    while len(rest):
        if len(levels) == MAX_LEVELS:
            raise ValueError("keys are not distinct")
        size = -(-LOAD * len(rest) // 64) * 64
        at = _place(a[rest], b[rest], len(levels), size)
        taken = np.bincount(at, minlength=size)
        levels.append(np.packbits(taken == 1, bitorder="little").view("<u8"))
        rest = rest[taken[at] != 1]
    words = np.concatenate(levels) if levels else np.empty(0, "<u8")
    count = np.bitwise_count(words)
    before = (np.cumsum(count, dtype=np.int64) - count).astype("<u4")
    sizes = np.array([len(x) for x in levels], "<u8")
    head = HEADER.pack(MAGIC, len(a), len(levels), len(words)) + sizes.tobytes() + words.tobytes() + before.tobytes()
    slots = np.zeros(len(a), SLOT)
    at = Index(lambda start, size: head[start:start + size]).slots(a, b)
    slots["fingerprint"][at], slots["shard"][at], slots["offset"][at], slots["n"][at] = _fingerprint(a, b), shard, offset, n
    return head + slots.tobytes()


class Index:
    """Reads an index file through ``read(start, size)``; nothing is held but the header, and :meth:`load`ed parts."""

    def __init__(self, read):
        magic, self.n, levels, self.words = HEADER.unpack(read(0, HEADER.size))
        if magic != MAGIC:
            raise ValueError("not an index file")
        self.read, at = read, HEADER.size
        self.first_word = np.cumsum([0, *np.frombuffer(read(at, 8 * levels), "<u8").tolist()], dtype=np.int64)
        self.at_bits = at + 8 * levels
        self.at_before = self.at_bits + 8 * self.words
        self.at_slots = self.at_before + 4 * self.words

    def _values(self, start: int, kind: str | np.dtype, at: np.ndarray) -> np.ndarray:
        """Numbers at places of an array in the file: all of it read at once for many, one by one for a few."""
        kind = np.dtype(kind)
        if len(at) > 4:
            lo, hi = int(at.min()), int(at.max()) + 1
            return np.frombuffer(self.read(start + lo * kind.itemsize, (hi - lo) * kind.itemsize), kind)[at - lo]
        return np.frombuffer(b"".join(self.read(start + i * kind.itemsize, kind.itemsize) for i in at.tolist()), kind)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has its bit."""
        out, rest = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level in range(len(self.first_word) - 1):
            if not len(rest):
                break
            at = _place(a[rest], b[rest], level, int(64 * (self.first_word[level + 1] - self.first_word[level])))
            word, bit = self.first_word[level] + (at >> 6), (at & 63).astype(U)
            bits = self._values(self.at_bits, "<u8", word)
            hit = (bits >> bit) & U(1) == 1
            inside = np.bitwise_count(bits[hit] & ((U(1) << bit[hit]) - U(1)))
            out[rest[hit]] = self._values(self.at_before, "<u4", word[hit]) + inside.astype(np.int64) if hit.any() else 0
            rest = rest[~hit]
        return out

    def find(self, digests: bytes) -> np.ndarray:
        """The slots' contents, of :data:`SLOT`; ``n`` is 0 for keys that are not there."""
        a, b = _halves(digests)
        slot, out = self.slots(a, b), np.zeros(len(a), SLOT)
        some = np.flatnonzero(slot >= 0)
        if len(some):
            found = self._values(self.at_slots, SLOT, slot[some])
            right = found["fingerprint"] == _fingerprint(a[some], b[some])
            out[some[right]] = found[right]
        return out


# ---------------------------------------------------------------------------
# writing
# ---------------------------------------------------------------------------
def _shard_name(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.ids"


def _index_name(folder: str, part: int) -> str:
    return f"{folder}/index-{part:06d}.mph"


def _shard_writer(root: str, path: str, end_id: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Writes a partition, sorted by key, as one shard; gives every document's place."""
        fs, where = folder(root)
        shard, ordinal, offset, last = TaskContext.get().partitionId(), 0, 0, None
        first = next(batches, None)
        if first is None:
            return
        with whole_file(fs, _shard_name(where, shard)) as out:
            while first is not None:
                keys, places = first.column(0), []
                for key, text in zip(keys.to_pylist(), first.column(1).to_pylist(), strict=True):
                    ids = np.append(encode.encode(path, text or "", added=True), np.uint32(end_id))
                    out.write(ids.astype(kind).tobytes())
                    last = (key, last[1] + 1 if last and last[0] == key else 0)
                    places.append((last[1], ordinal, offset, len(ids)))
                    ordinal, offset = ordinal + 1, offset + len(ids)
                if places:
                    columns = [pa.array(c, pa.int64()) for c in zip(*places, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([shard] * len(places), pa.int32()), keys, *columns], names=["shard", "key", "copy", "ordinal", "offset", "n"])
                first = next(batches, None)

    return run


def _index_writer(root: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, where = folder(root)
        part = int(pdf["part"].iloc[0])
        content = build_index(b"".join(map(bytes.fromhex, pdf["digest"])), *(pdf[c].to_numpy() for c in ("shard", "offset", "n")))
        with whole_file(fs, _index_name(where, part)) as out:
            out.write(content)
        return pd.DataFrame({"part": [part], "keys": [len(pdf)], "bytes": [len(content)]})

    return run


def _shard_table(places: DataFrame) -> DataFrame:
    """Per shard: documents, ids, ids in the shards before, and its first key with the copies of it before the shard.  As small as the list of shards."""
    last = F.max_by(F.struct("key", (F.col("copy") + 1).alias("copies")), "ordinal").alias("last")
    first = F.min_by(F.struct("key"), "ordinal").alias("first")
    s = places.groupBy("shard").agg(F.count("*").alias("documents"), F.sum("n").alias("ids"), first, last)
    by_shard = Window.orderBy("shard")
    s = s.withColumn("base", F.sum("ids").over(by_shard) - F.col("ids"))
    s = s.withColumn("upto", F.sum("last.copies").over(Window.partitionBy("last.key").orderBy("shard")))
    s = s.withColumn("prior", F.lag(F.struct("last.key", "upto")).over(by_shard))
    carried = F.when(F.col("prior").isNotNull() & F.col("prior.key").eqNullSafe(F.col("first.key")), F.col("prior.upto")).otherwise(0)
    return s.select("shard", "documents", "ids", "base", F.col("first.key").alias("first_key"), carried.alias("carried"))


def write_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID,
              root: str | None = None, part_keys: int = PART_KEYS) -> str:
    """Writes the documents' ids and their index; returns the folder (``root``, or a new one under the checkpoint folder)."""
    spark, path = docs.sparkSession, path or encode.vocabulary_path()
    root = root or scratch_path(spark, f"ids-{uuid.uuid4().hex[:12]}")
    fs, where = folder(root)
    fs.create_dir(where, recursive=True)
    kind = "<u2" if encode.vocabulary_size(path) <= 1 << 16 else "<u4"
    # rows equal in id, and in text as well, are told apart by their place in the input
    rows = docs.select(docs[doc_id].alias("key"), docs[text].cast("string").alias("text"))
    rows = rows.withColumns({"t": F.xxhash64("text"), "i": F.monotonically_increasing_id()})
    order = [F.col("key").asc_nulls_last(), F.col("t"), F.col("i")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    schema = f"shard int, key {rows.schema['key'].dataType.simpleString()}, copy bigint, ordinal bigint, offset bigint, n bigint"
    rows.mapInArrow(_shard_writer(root, path, end_id, kind), schema).write.parquet(f"{root}/places")
    places = spark.read.parquet(f"{root}/places")
    _shard_table(places).write.parquet(f"{root}/shards")
    shards = spark.read.parquet(f"{root}/shards")
    copy = F.col("copy") + F.when(F.col("key").eqNullSafe(F.col("first_key")), F.col("carried")).otherwise(0)
    keyed = places.join(shards.select("shard", "first_key", "carried"), "shard").select("key", copy.alias("copy"), "shard", "offset", "n")
    keyed.select("key", "copy").write.parquet(f"{root}/keys")
    parts = max(1, -(-places.count() // part_keys))
    digest = key_digest_column(F.col("key"), F.col("copy"))
    entries = keyed.select(digest.alias("digest"), "shard", "offset", "n").withColumn("part", _part(F.col("digest"), parts))
    entries.groupBy("part").applyInPandas(_index_writer(root), "part int, keys bigint, bytes bigint").write.parquet(f"{root}/parts")
    with whole_file(fs, f"{where}/format.json") as out:
        out.write(json.dumps({"parts": parts, "kind": kind, "end_id": end_id}).encode())
    return root


# ---------------------------------------------------------------------------
# reading
# ---------------------------------------------------------------------------
class Store:
    """Keyed access to a folder from a single process."""

    def __init__(self, root: str):
        self.fs, self.where = folder(root)
        with self.fs.open_input_file(f"{self.where}/format.json") as f:
            self.format = json.loads(f.read())
        self.kind = np.dtype(self.format["kind"])

    def index(self, part: int, whole: bool = False) -> Index | None:
        """An index file, read once as a ``whole`` or place by place; none if it has no keys."""
        name = _index_name(self.where, part)
        if not self.fs.get_file_info(name).is_file:
            return None
        f = self.fs.open_input_file(name)
        if not whole:
            return Index(lambda start, size: f.read_at(size, start))
        content = memoryview(f.read())
        return Index(lambda start, size: content[start:start + size])

    def read(self, shard: int, offset: int, n: int) -> np.ndarray:
        with self.fs.open_input_file(_shard_name(self.where, shard)) as f:
            return np.frombuffer(f.read_at(n * self.kind.itemsize, offset * self.kind.itemsize), self.kind).astype("<u4")

    def get(self, key, copy: int = 0) -> np.ndarray | None:
        """The ids of a document, null if the key was not written."""
        digest = key_digest(key, copy)
        index = self.index(int.from_bytes(digest[:4], "big") % self.format["parts"])
        found = index.find(digest)[0] if index else None
        return self.read(int(found["shard"]), int(found["offset"]), int(found["n"])) if found is not None and found["n"] else None


def _stretches(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each stretch of equal numbers begins and ends."""
    edges = np.flatnonzero(np.diff(x)) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), len(x)], strict=True)


def _finder(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over a partition sorted by index file: where each key's ids are."""
        store, part, index = Store(root), None, None
        for batch in batches:
            if not len(batch):
                continue
            numbers, found = batch.column("part").to_numpy(), np.zeros(len(batch), SLOT)
            for lo, hi in _stretches(numbers):
                if numbers[lo] != part:
                    part = int(numbers[lo])
                    index = store.index(part, whole=True)
                if index is not None:
                    found[lo:hi] = index.find(b"".join(batch.column("digest").slice(lo, hi - lo).to_pylist()))
            places = [pa.array(found[c].astype(np.int64)) for c in ("shard", "offset", "n")]
            out = pa.RecordBatch.from_arrays([batch.column("key"), batch.column("copy"), *places], names=["key", "copy", "shard", "offset", "n"])
            yield out.filter(pa.array(found["n"] > 0))

    return run


def _fetcher(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over a partition sorted by shard and offset: the ids themselves."""
        store = Store(root)
        size = store.kind.itemsize
        for batch in batches:
            shards, offset, n = (batch.column(c).to_numpy() for c in ("shard", "offset", "n"))
            for lo, hi in _stretches(shards) if len(batch) else ():
                with store.fs.open_input_file(_shard_name(store.where, int(shards[lo]))) as f:
                    while lo < hi:
                        ids = []
                        while lo + len(ids) < hi and sum(map(len, ids)) < FLUSH:
                            k = lo + len(ids)
                            ids.append(np.frombuffer(f.read_at(int(n[k]) * size, int(offset[k]) * size), store.kind).astype("<u4").tobytes())
                        part = batch.slice(lo, len(ids))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], names=[*part.schema.names, "ids"])
                        lo += len(ids)

    return run


def read_ids(spark: SparkSession, root: str, keys: DataFrame | None = None) -> DataFrame:
    """``key, copy, start, n_tokens, ids`` (little-endian 32-bit numbers) of those ``keys`` (``key, copy``; by default all) that are there.

    ``start`` counts the ids of all documents before.  Repeated keys are looked up each for itself.
    """
    keys = keys if keys is not None else spark.read.parquet(f"{root}/keys")
    digest = key_digest_column(F.col("key"), F.col("copy"))
    asked = keys.select("key", F.col("copy").cast("bigint").alias("copy"), digest.alias("d"))
    asked = asked.select("key", "copy", F.unhex("d").alias("digest"), _part(F.col("d"), Store(root).format["parts"]).alias("part"))
    kind = keys.schema["key"].dataType.simpleString()
    places = f"key {kind}, copy bigint, shard bigint, offset bigint, n bigint"
    found = asked.repartition("part").sortWithinPartitions("part").mapInArrow(_finder(root), places)
    ids = found.repartition("shard").sortWithinPartitions("shard", "offset").mapInArrow(_fetcher(root), f"{places}, ids binary")
    base = spark.read.parquet(f"{root}/shards").select(F.col("shard").alias("s"), "base")
    return ids.join(base, F.col("shard") == F.col("s")).select("key", "copy", (F.col("base") + F.col("offset")).alias("start"), F.col("n").alias("n_tokens"), "ids")


def id_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the documents' ids and reads them back by key: one row per document."""
    rows = read_ids(docs.sparkSession, write_ids(docs, doc_id, text))
    return rows.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
