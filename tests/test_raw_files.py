"""The data source of raw article files: names, pruning, commit and abort."""

import os

import pytest
from pyspark.sql import functions as F

from corpusforge.sources import raw_files as R

ROWS = [("vtv.vn", 5, "kinh_te", '{"a": 1}'), ("vtv.vn", 5, "kinh_te", '{"a": 2}'), ("a_b/c", 7, None, "x\ny"), (None, 9, "", ""),
        ("", 9, "thế giới", "ế"), ("vtv.vn", None, "x", "none"), ("%", 12, ".json", None)]


def _rows(spark, rows=ROWS):
    return spark.createDataFrame(rows, "source string, epoch long, category string, value string")


def _read(df):
    return sorted((str(r.source), str(r.epoch), str(r.category), r.value) for r in df.collect())


def test_round_trip_and_append(spark, tmp_path):
    path = str(tmp_path / "raw")
    R.save(_rows(spark), path)
    want = [(s, e, c, v or "") if e is not None else (None, None, None, v) for s, e, c, v in ROWS]
    want = sorted((str(s), str(e), str(c), v) for s, e, c, v in want)
    assert _read(R.scan(spark, path)) == want
    R.save(_rows(spark), path)
    assert _read(R.scan(spark, path)) == sorted(want * 2)
    R.save(_rows(spark, ROWS[:1]), path, "overwrite")
    assert _read(R.scan(spark, path)) == [("vtv.vn", "5", "kinh_te", '{"a": 1}')]
    with open(f"{path}/site_3_news.json", "w") as f:  # files from elsewhere count too
        f.write("loose")
    with open(f"{path}/other.json", "w") as f:
        f.write("no parts")
    assert len(_read(R.scan(spark, path))) == 3
    assert _read(R.scan(spark, f"file://{path}", since=3, until=4)) == [("site", "3", "news", "loose")]
    assert _read(R.scan(spark, str(tmp_path / "none"))) == []
    R.save(_rows(spark, []), str(tmp_path / "empty"))
    assert _read(R.scan(spark, str(tmp_path / "empty"))) == []


CASES = [({"sources": ["vtv.vn"]}, "source = 'vtv.vn'"), ({"since": 6, "until": 9}, "epoch >= 6 AND epoch < 9"), ({"categories": ["kinh_te", ""]}, "category IN ('kinh_te', '')"),
         ({"sources": ["%", ""], "since": 9}, "source IN ('%', '') AND epoch >= 9"), ({"sources": []}, "false"), ({"until": 0}, "false")]


def test_options_give_what_filters_give(spark, tmp_path):
    path = str(tmp_path / "raw")
    R.save(_rows(spark), path)
    whole = R.scan(spark, path)
    for options, cond in CASES:
        assert _read(R.scan(spark, path, **options)) == _read(whole.filter(cond)), cond
    # two scans of one folder, and two filters on one scan, in one query
    both = R.scan(spark, path, until=7).unionByName(R.scan(spark, path, since=7))
    assert _read(both) == _read(whole.filter("epoch IS NOT NULL")) == _read(whole.filter("epoch < 7").unionByName(whole.filter("epoch >= 7")))


def test_pruned_files_are_never_opened(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    R.save(_rows(spark), path)
    opened = []
    whole = R.Reader.content
    monkeypatch.setattr(R.Reader, "content", lambda self, fs, p: opened.append(p) or whole(self, fs, p))
    reader = R.Reader({"path": path, "sources": '["vtv.vn"]', "since": "1"})
    assert len([r for p in reader.partitions() for r in reader.read(p)]) == len(opened) == 2
    # through Spark: a file whose content cannot be read fails the scan unless its name is excluded
    os.symlink("/proc/self/mem", f"{path}/broken_1_x.json")
    assert len(_read(R.scan(spark, path, sources=["vtv.vn"]))) == 2
    with pytest.raises(Exception):
        R.scan(spark, path).collect()


def test_failed_tasks_leave_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    R.save(_rows(spark, ROWS[:2]), path)
    bad = spark.range(0, 8, 1, 4).select(F.lit("s").alias("source"), F.col("id").alias("epoch"), F.lit("c").alias("category"),
                                         F.when(F.col("id") == 7, F.raise_error("broken row")).otherwise("v").alias("value"))
    with pytest.raises(Exception):
        R.save(bad, path)
    assert len(_read(R.scan(spark, path))) == 2
    assert len([d for d in os.listdir(path) if d.startswith("job-")]) == 1
    # what a lost task wrote beside a committed one is not read
    job = next(d for d in os.listdir(path) if d.startswith("job-"))
    os.makedirs(f"{path}/{job}/task-0-99")
    with open(f"{path}/{job}/task-0-99/s_1_c.json", "w") as f:
        f.write("again")
    assert len(_read(R.scan(spark, path))) == 2


def test_json_scan_reads_a_committed_folder(spark, tmp_path):
    """S1 and P3 follow the manifests, so what a lost task left is not read, and apply their pattern."""
    from corpusforge.sources import io

    path = str(tmp_path / "raw")
    rows = [("s", 1, "c", '{"content": "one"}'), ("s", 2, "c", '{"content": null}'), ("s", 3, "c", "[1]"), (None, None, None, '{"title": 5}'), ("s", 4, "d", "")]
    R.save(_rows(spark, rows).repartition(3), path)
    job = next(d for d in os.listdir(path) if d.startswith("job-"))
    os.makedirs(f"{path}/{job}/task-0-99")
    with open(f"{path}/{job}/task-0-99/s_1_c.json", "w") as f:
        f.write('{"content": "again"}')
    assert sorted((str(r.content), r._keys) for r in io.scan_raw_json(spark, path).collect()) == [("None", ["content"]), ("one", ["content"])]
    assert [r.content for r in io.scan_raw_json(spark, path, pattern="s_1_*").collect()] == ["one"]
    kept, refused = io.sort_raw_json(spark, path, str(tmp_path / "out"))
    assert kept.count() == 2
    assert sorted((r.reason, r.value) for r in refused.collect()) == [("not JSON", ""), ("not an object", "[1]"), ("title is no text", '{"title": 5}')]


def test_small_files_share_tasks(spark, tmp_path):
    """A folder from elsewhere: files that Spark deals out nearly one by one are put together, none is lost."""
    from corpusforge.sources import io

    n = max(io.SCAN_TASKS, 8 * spark.sparkContext.defaultParallelism)
    for i in range(n + 100):
        (tmp_path / f"{i}.json").write_text(f'{{"content": "{i}"}}')
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        raw = io.scan_raw_json(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() <= n and {r.content for r in raw.collect()} == {str(i) for i in range(n + 100)}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
