"""CSV read by blocks against the unsplit scan."""

import random

import pyarrow as pa
import pytest

from corpusforge.sources import csv_blocks as B
from corpusforge.sources import io

SCHEMA = "k long, a string, b string"


def _values(n, seed):
    rng = random.Random(seed)
    parts = ["x", "a,b", "line\nbreak", 'a "quoted" word', '"', "\n\n", "ế thế", ",", " pad ", "1", '""', "\n\"\n"]
    return [(i, rng.choice([None, "", "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))]), "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))) for i in range(n)]


def _rows(df):
    return sorted((str(r.k), repr(r.a), repr(r.b)) for r in df.collect())


@pytest.mark.parametrize("block", [97, 1000, B.BLOCK])
def test_blocks_equal_the_unsplit_scan(spark, tmp_path, block):
    rows = _values(60, 3) + [(998, "y\n" * 500, 'z"' * 500), (999, None, "end")]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    path = str(tmp_path / "csv")
    io.write_csv(df, path)
    got = B.read_csv_blocks(spark, path, SCHEMA, block)
    assert got.schema == io.read_csv(spark, path, SCHEMA).schema
    assert _rows(got) == _rows(io.read_csv(spark, path, SCHEMA)) and got.count() == len(rows)
    assert block > 97 or got.rdd.getNumPartitions() > 40


def test_odd_files(spark, tmp_path):
    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_bytes(b'k,a,b\n1,x\n\n2,x,y,z,w\nnone,"",\n3,"p\nq",""')  # too few, blank, too many, no number, no break at the end
    (path / "b.csv").write_bytes(b"k,a,b\n")
    (path / "c.csv").write_bytes(b"")
    (path / "_d.csv").write_bytes(b"k,a,b\n9,9,9\n")
    for block in (5, 11, B.BLOCK):
        got = _rows(B.read_csv_blocks(spark, str(path), SCHEMA, block))
        assert got == sorted([("1", "'x'", "None"), ("2", "'x'", "'y'"), ("None", "None", "None"), ("3", "'p\\nq'", "None")])
        assert got == _rows(io.read_csv(spark, str(path), SCHEMA))
    one = B.read_csv_blocks(spark, f"file://{path}/a.csv", SCHEMA, 9)
    assert one.count() == 4
    (tmp_path / "none").mkdir()
    assert B.read_csv_blocks(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def test_every_row_is_owned_once():
    rng = random.Random(5)
    for _ in range(200):
        rows = ["".join(rng.choice(['a', ',', '"x\n"', '"""\n"', 'bc']) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 12))]
        data = "\n".join(rows).encode() + rng.choice([b"", b"\n"])
        block = rng.randint(1, 20)
        out, quotes = b"", 0
        for start in range(0, len(data), block):
            end = min(start + block, len(data))
            out += B.own_rows(pa.BufferReader(data), start, end, quotes % 2 == 1, len(data))
            quotes += data[start:end].count(b'"')
        assert out == data
