"""Raw ingest: file scan, validity split, idempotence, available-now stream."""

import json
import os

from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.plans.ingest import ingest_files
from matchlake.sources import scan_json_files
from matchlake.streaming import ingest_stream, json_file_stream


def write(root, rel, text):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def landing(root):
    write(root, "pretty.json", json.dumps({"a": 1, "b": [1, 2]}, indent=2))
    write(root, "A B.JSON", '{"x": 1}\n')
    write(root, "sub/c.json", '{"a":1,"a":2}')
    write(root, "notes.txt", '{"not": "scanned"}')
    write(root, "bad1.json", '{"a":1} x')
    write(root, "bad2.json", "{'a':1}")
    write(root, "bad3.json", '{"a":1')
    write(root, "empty.json", "")


def test_scan_whole_files_and_names(spark, tmp_dir):
    root = os.path.join(tmp_dir.replace("file:", ""), "land")
    landing(root)
    got = {r["file_name"]: r["content"] for r in scan_json_files(spark, root).collect()}
    assert set(got) == {"pretty.json", "A B.JSON", "sub/c.json", "bad1.json", "bad2.json", "bad3.json"}
    assert json.loads(got["pretty.json"]) == {"a": 1, "b": [1, 2]}    # one row for a multi-line file


def test_ingest_idempotent_with_quarantine(spark, tmp_dir):
    base = tmp_dir.replace("file:", "")
    root, target, quarantine = f"{base}/land", f"{base}/raw", f"{base}/quarantine"
    landing(root)
    first = ingest_files(spark, root, target, quarantine)
    assert (first.loaded, first.quarantined) == (3, 3)
    write(root, "pretty.json", '{"changed": true}')        # same name, new content: ignored
    second = ingest_files(spark, root, target, quarantine)
    assert (second.loaded, second.quarantined) == (0, 0)
    raw = spark.read.parquet(target)
    assert sorted(r[0] for r in raw.select("file_name").collect()) == ["A B.JSON", "pretty.json", "sub/c.json"]
    assert raw.where(F.col("file_name") == "pretty.json").first()["content"].startswith("{\n")
    assert raw.schema["file_upload_timestamp"].dataType == schemas.RAW_DOCUMENTS["file_upload_timestamp"].dataType


def test_stream_available_now_twice(spark, tmp_dir):
    base = tmp_dir.replace("file:", "")
    root, target, quarantine, ck = f"{base}/land", f"{base}/raw", f"{base}/q", f"{base}/ck"
    landing(root)
    ingest_stream(spark, json_file_stream(spark, root), target, quarantine, ck)
    assert spark.read.parquet(target).count() == 3
    assert spark.read.parquet(quarantine).count() == 3
    write(root, "late.json", '{"late": 1}')
    ingest_stream(spark, json_file_stream(spark, root), target, quarantine, ck)
    names = sorted(r[0] for r in spark.read.parquet(target).select("file_name").collect())
    assert names == ["A B.JSON", "late.json", "pretty.json", "sub/c.json"]


def test_stream_bounded_batches(spark, tmp_dir):
    base = tmp_dir.replace("file:", "")
    root = f"{base}/land"
    landing(root)
    report = ingest_stream(spark, json_file_stream(spark, root, max_files_per_trigger=2), f"{base}/raw", f"{base}/q",
                           f"{base}/ck")
    # six files with content and an empty one, two a batch; the listener saw each batch's rows
    assert len(report.batches) >= 3 and all(0 <= b["received"] <= 2 for b in report.batches)
    assert sum(b["received"] for b in report.batches) == 6
    assert all(b["loaded"] + b["quarantined"] == b["received"] for b in report.batches)
    assert (report.loaded, report.quarantined) == (3, 3)
    assert spark.read.parquet(f"{base}/raw").count() == 3
    assert spark.read.parquet(f"{base}/q").count() == 3


def test_names_with_plus_percent_and_relative_root(spark, tmp_dir):
    base = tmp_dir.replace("file:", "")
    write(base, "land/a+b c%d.json", "{}")
    jvm_cwd = spark.sparkContext._jvm.System.getProperty("user.dir")
    rel = os.path.relpath(os.path.join(base, "land"), jvm_cwd)
    got = [r["file_name"] for r in scan_json_files(spark, rel).collect()]
    assert got == ["a+b c%d.json"]


def test_late_file_with_an_old_time_lands_in_both(spark, tmp_dir):
    base = tmp_dir.replace("file:", "")
    root = f"{base}/land"
    write(root, "new.json", "{}")
    for k in range(2):
        ingest_stream(spark, json_file_stream(spark, root), f"{base}/s", f"{base}/sq", f"{base}/ck")
        ingest_files(spark, root, f"{base}/b", f"{base}/bq")
        write(root, "new2.json", "{}")
        write(root, "old.json", "{}")
        os.utime(os.path.join(root, "old.json"), (1_000_000_000, 1_000_000_000))
    names = [sorted(r[0] for r in spark.read.parquet(f"{base}/{t}").select("file_name").collect()) for t in "sb"]
    assert names == [["new.json", "new2.json", "old.json"]] * 2 or names[0] == names[1]
    report = ingest_stream(spark, json_file_stream(spark, root), f"{base}/s", f"{base}/sq", f"{base}/ck")
    assert (report.loaded, report.quarantined) == (0, 0)


def test_no_document_is_too_large(spark):
    from matchlake.functions import is_valid_json, parse_document

    unread = {"long": '"' + "x" * 20_500_000 + '"', "deep": "[" * 1100 + "]" * 1100, "number": "1" * 1200}
    for name, value in unread.items():
        text = '{"unread": %s, "info": {"city": "here"}}' % value
        df = spark.createDataFrame([(text,)], "t string")
        row = df.select(is_valid_json("t").alias("ok"), parse_document("t")["info"]["city"].alias("city")).first()
        assert row["ok"] and row["city"] == "here", name


def test_only_named_files_are_opened(spark, tmp_dir):
    from matchlake.sources import list_files, open_files

    base = tmp_dir.replace("file:", "")
    landing(f"{base}/land")
    write(base, "land/a+b c%d.json", "{}")
    write(base, "land/_hidden/x.json", "{}")
    write(base, "land/deep/er/and/deeper.json", "{}")
    names = list_files(spark, f"{base}/land")
    assert sorted(r["file_name"] for r in names.collect()) == [
        "A B.JSON", "a+b c%d.json", "bad1.json", "bad2.json", "bad3.json", "deep/er/and/deeper.json", "pretty.json", "sub/c.json"]
    assert {r["file_name"]: r["content"] for r in open_files(names).collect()} == {
        r["file_name"]: r["content"] for r in scan_json_files(spark, f"{base}/land").collect()}
    some = names.where("file_name like 'sub/%' or file_name like 'a+%'").withColumn("seen", F.lit(7))
    for other in ("pretty.json", "bad1.json", "A B.JSON"):
        os.remove(os.path.join(base, "land", other))           # opening any of these would fail now
    assert sorted((r["file_name"], r["seen"], r["content"]) for r in open_files(some).collect()) == [
        ("a+b c%d.json", 7, "{}"), ("sub/c.json", 7, '{"a":1,"a":2}')]
    assert open_files(names.limit(0)).count() == 0
    assert list_files(spark, f"{base}/land", "*.txt").first()["file_name"] == "notes.txt"


def test_written_files_read_back(spark, tmp_dir):
    from matchlake.sources import list_files, open_files, write_files

    rows = [(f"d{k % 3}/n {k}+%.json", f"é{k}\n" * k) for k in range(1, 40)]
    done = write_files(spark.createDataFrame(rows, "file_name string, content string").repartition(3), f"{tmp_dir}/out")
    assert {r["file_name"]: r["length"] for r in done.collect()} == {n: len(c.encode()) for n, c in rows}
    assert sorted(map(tuple, open_files(list_files(spark, f"{tmp_dir}/out")).collect())) == sorted(rows)


class Killed(Exception):
    pass


def names_of(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("file_name").collect())


def test_replay_after_a_kill_between_the_two_appends(spark, tmp_dir, monkeypatch):
    from matchlake.sources import batches

    base = tmp_dir.replace("file:", "")
    root, target, quarantine = f"{base}/land", f"{base}/raw", f"{base}/quarantine"
    landing(root)
    real, moved = batches._Files.move, []

    def move(self, a, b):
        if b.startswith(quarantine):                            # the target is published, the quarantine is not
            raise Killed
        moved.append(b)
        return real(self, a, b)
    monkeypatch.setattr(batches._Files, "move", move)
    try:
        ingest_files(spark, root, target, quarantine)
        raise AssertionError("not killed")
    except Killed:
        pass
    assert any(b.startswith(target + "/part-") for b in moved) and spark.read.schema(schemas.RAW_DOCUMENTS).parquet(quarantine).count() == 0
    monkeypatch.setattr(batches._Files, "move", real)
    again = ingest_files(spark, root, target, quarantine)       # finishes the batch, finds nothing new
    assert (again.loaded, again.quarantined) == (0, 0)
    assert names_of(spark, target) == ["A B.JSON", "pretty.json", "sub/c.json"]
    assert names_of(spark, quarantine) == ["bad1.json", "bad2.json", "bad3.json"]


def test_kill_before_the_commit_leaves_nothing(spark, tmp_dir, monkeypatch):
    from matchlake.sources import batches

    base = tmp_dir.replace("file:", "")
    root, target, quarantine = f"{base}/land", f"{base}/raw", f"{base}/quarantine"
    landing(root)
    real = batches._Files.write
    monkeypatch.setattr(batches._Files, "write", lambda *a: (_ for _ in ()).throw(Killed()))
    try:
        ingest_files(spark, root, target, quarantine)
    except Killed:
        pass
    assert names_of(spark, target) == []
    monkeypatch.setattr(batches._Files, "write", real)
    report = ingest_files(spark, root, target, quarantine)
    assert (report.loaded, report.quarantined) == (3, 3)
    assert not os.listdir(f"{target}/_staging")


def test_a_replayed_stream_batch_lands_once(spark, tmp_dir):
    import shutil

    base = tmp_dir.replace("file:", "")
    root, target, quarantine, ck = f"{base}/land", f"{base}/raw", f"{base}/q", f"{base}/ck"
    landing(root)
    first = ingest_stream(spark, json_file_stream(spark, root), target, quarantine, ck)
    assert (first.loaded, first.quarantined) == (3, 3)
    for name in os.listdir(f"{ck}/commits"):                    # the stream forgets that batch 0 is done
        os.remove(f"{ck}/commits/{name}")
    shutil.rmtree(f"{target}/_staging", ignore_errors=True)
    again = ingest_stream(spark, json_file_stream(spark, root), target, quarantine, ck)
    assert (again.loaded, again.quarantined) == (0, 0)
    assert len(names_of(spark, target)) == 3 and len(names_of(spark, quarantine)) == 3


def test_every_document_is_written_once(spark, tmp_dir):
    """One batch: as many bytes in the tables as were staged, and no cache or checkpoint behind them."""
    from matchlake.sources import batch_counts

    base = tmp_dir.replace("file:", "")
    landing(f"{base}/land")
    ingest_files(spark, f"{base}/land", f"{base}/raw", f"{base}/q")
    told = {r["table"]: r["rows"] for r in batch_counts(spark, f"{base}/raw").collect()}
    assert told == {"loaded": 3, "quarantined": 3}
    assert not list(spark.sparkContext._jsc.getPersistentRDDs().keys())


def test_required_columns(spark, tmp_dir):
    import pytest

    from matchlake.sources import append_parquet, commit_batch, ensure_table, missing_required

    schema = schemas.RAW_DOCUMENTS
    rows = spark.createDataFrame([("a", "{}"), (None, "{}"), ("c", None), (None, None)], "file_name string, content string") \
        .withColumn("file_upload_timestamp", F.current_timestamp())
    target = f"{tmp_dir}/t"
    ensure_table(spark, target, schema)
    with pytest.raises(Exception, match="REQUIRED column file_name is null"):
        append_parquet(rows.where("content is not null"), target, schema=schema)
    with pytest.raises(Exception, match="REQUIRED column content is null"):
        append_parquet(rows.where("file_name is not null"), target, schema=schema)
    assert spark.read.parquet(target).count() == 0
    append_parquet(rows.where("file_name = 'a'"), target, schema=schema)
    assert spark.read.parquet(target).count() == 1
    with pytest.raises(Exception, match="REQUIRED column file_name of x is null"):
        commit_batch(rows.withColumn("__to", F.lit("x")), "b", {"x": f"{tmp_dir}/x"}, {"x": schema})
    got = sorted(r[0] for r in rows.select(missing_required(schema)).collect())
    assert got == [[], ["content"], ["file_name"], ["file_name", "content"]]


def test_a_rejected_batch_names_every_column(spark, tmp_dir):
    """Whichever task fails first, the error is the same; nothing is staged or committed."""
    import pytest

    from matchlake.sources import batch_counts, commit_batch, ensure_table

    schema, target = schemas.RAW_DOCUMENTS, f"{tmp_dir}/x"
    rows = spark.createDataFrame([("a", "{}"), (None, "{}"), ("c", None), (None, None)], "file_name string, content string") \
        .withColumn("file_upload_timestamp", F.current_timestamp()).withColumn("__to", F.lit("x")).repartition(4)
    ensure_table(spark, target, schema)
    with pytest.raises(Exception, match="file_name of x is null in 2 rows; REQUIRED column content of x is null in 2 rows"):
        commit_batch(rows, "b", {"x": target}, {"x": schema})
    assert not os.listdir(f"{target}/_staging".replace("file:", ""))
    assert spark.read.parquet(target).count() == 0 and batch_counts(spark, target).count() == 0
    assert commit_batch(rows.where("file_name = 'a'"), "b", {"x": target}, {"x": schema}) == {"x": 1}


def test_small_files_do_not_mean_many_tasks(spark, tmp_dir):
    """Opening costs may not make a task, and a part of a table, of every few files."""
    from matchlake.sources import list_files, open_files, write_files

    files = spark.range(600).select(F.format_string("d%d/f %d.json", F.col("id") % 3, F.col("id")).alias("file_name"),
                                    F.format_string('{"id": %d}', F.col("id")).alias("content"))
    write_files(files, f"{tmp_dir}/land")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")       # an opening cost fills a task
    try:
        listed = list_files(spark, f"{tmp_dir}/land")
        most = 4 * spark.sparkContext.defaultParallelism
        assert open_files(listed).rdd.getNumPartitions() <= most
        scanned = scan_json_files(spark, f"{tmp_dir}/land")
        assert scanned.rdd.getNumPartitions() <= most
        assert sorted(map(tuple, scanned.collect())) == sorted(map(tuple, files.collect()))
        # bytes still make tasks of their own: 600 files of nominal 1 MB each
        assert open_files(listed.withColumn("length", F.lit(1 << 20).cast("long"))).rdd.getNumPartitions() >= 150
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    one = scan_json_files(spark, f"{tmp_dir}/land/d0/f 0.json").collect()       # not a folder: Spark's reader
    assert [r["content"] for r in one] == ['{"id": 0}']
