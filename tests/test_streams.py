import shutil

from pyspark.sql import functions as F

from folioworks.config import EngineConfig
from folioworks.operators import paging
from folioworks.operators.identity import content_id
from folioworks.plans.ingest import ingest
from folioworks.streaming import keyed, stream
from folioworks.streaming import pages as page_stream

SCHEMA = "source_id int, text string"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_dedup_stream_over_several_runs(spark, tmp_path):
    folder, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    arrive(spark, folder, [(i, f"text {i % 3}") for i in range(60)])

    def run():
        docs = stream.stream_docs(spark, folder, SCHEMA, files_per_trigger=1)
        return stream.drain(stream.dedup_stream(docs, "source_id", salts=4), out, state)

    assert run().count() == 3
    arrive(spark, folder, [(100, "text 1"), (101, "new")])
    rows = run().collect()
    assert len(rows) == 4 and {r["text"] for r in rows} == {"text 0", "text 1", "text 2", "new"}


def pages_by_three(df):
    return paging.paginate(df.select(content_id("text").alias("doc_id"), "text"), 3)


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_upsert_is_the_batch_result_and_repeats_do_no_harm(spark, tmp_path):
    folder = f"{tmp_path}/in"
    arrive(spark, folder, [(1, "\n".join(f"first document line {i}" for i in range(12)))])
    arrive(spark, folder, [(2, "the second one\nis short")])
    cfg = EngineConfig(language="off")
    write = stream.upsert_batch(f"{tmp_path}/out", cfg, pages_by_three)
    docs = stream.stream_docs(spark, folder, SCHEMA, files_per_trigger=1)
    stream.run_batches(docs, write, f"{tmp_path}/state")
    want = rows_of(ingest(pages_by_three(spark.read.parquet(folder)), cfg))
    assert rows_of(keyed.latest(spark, f"{tmp_path}/out")) == want
    # the same rows again, under any number, and from a new checkpoint that counts from 0
    write(spark.read.parquet(folder).filter("source_id = 1"), 7)
    assert rows_of(keyed.latest(spark, f"{tmp_path}/out")) == want
    stream.run_batches(docs, write, f"{tmp_path}/other_state")
    assert rows_of(keyed.latest(spark, f"{tmp_path}/out")) == want


def test_a_document_that_comes_again_replaces_its_earlier_form(spark, tmp_path):
    schema = "doc_id string, page_no int, n_pages int, text string"
    write = stream.upsert_batch(f"{tmp_path}/out", EngineConfig(language="off", tables="off", block_pages=2))
    write(spark.createDataFrame([("a", i, 5, f"old {i}") for i in range(5)] + [("b", 0, 1, "kept")], schema), 0)
    write(spark.createDataFrame([("a", 0, 1, "new")], schema), 1)
    rows = keyed.latest(spark, f"{tmp_path}/out").collect()
    assert sorted((r["doc_id"], r["part_no"], r["text"]) for r in rows) == [("a", 0, "new"), ("b", 0, "kept")]
    write(spark.createDataFrame([], schema), 2)
    assert keyed.latest(spark, f"{tmp_path}/out").count() == 2


def test_only_live_files_of_touched_buckets_are_read_and_written(spark, tmp_path):
    out = f"{tmp_path}/out"

    def files():
        return {str(f.relative_to(tmp_path)): f.stat().st_mtime_ns for f in tmp_path.rglob("part-*.parquet")}

    keyed.upsert(spark.createDataFrame([(f"d{i}", "old") for i in range(200)], "doc_id string, text string"), out, buckets=8)
    before = files()
    keyed.upsert(spark.createDataFrame([("d3", "new")], "doc_id string, text string"), out, buckets=8)
    after = files()
    bucket = spark.createDataFrame([("d3",)], "doc_id string").select(keyed.bucket_of(F.col("doc_id"), 8)).first()[0]
    changed = {f for f in before.items() ^ after.items()}
    assert changed and all(f"bucket={bucket}/" in name for name, _ in changed)
    assert len(after) == len(before), "no file of an earlier form is left"
    rows = {r.doc_id: r.text for r in keyed.latest(spark, out).collect()}
    assert len(rows) == 200 and [d for d, t in rows.items() if t == "new"] == ["d3"]
    one = spark.read.parquet(f"{out}/table").filter(F.col("bucket") == bucket)
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()


def test_an_exchange_that_broke_off_is_finished(spark, tmp_path):
    out, schema = f"{tmp_path}/out", "doc_id string, text string"
    keyed.upsert(spark.createDataFrame([(f"d{i}", "old") for i in range(20)], schema), out, buckets=2)
    # the merge of a second batch is written, then the driver goes while a bucket is deleted
    old = spark.read.parquet(f"{out}/table").filter("bucket = 0")
    merged = old.withColumn("text", F.lit("second"))
    merged.write.parquet(f"{out}/_merge")
    n = merged.count()
    shutil.rmtree(f"{out}/table/bucket=0")
    keyed.upsert(spark.createDataFrame([("z", "third")], schema), out, buckets=2)
    texts = [r.text for r in keyed.latest(spark, out).collect()]
    assert len(texts) == 21 and texts.count("second") == n and not (tmp_path / "out/_merge").exists()


def test_buckets_take_their_places_without_another_write(spark, tmp_path):
    out, schema = f"{tmp_path}/out", "doc_id string, text string"

    def files():
        return {f.name for f in tmp_path.rglob("part-*.parquet")}

    keyed._write(spark.createDataFrame([(f"d{i}", "old") for i in range(50)], schema).withColumn("bucket", keyed.bucket_of(F.col("doc_id"), 4)), 4, f"{out}/_merge")
    made = files()
    # a break between two folders: what was not moved yet is found by the next batch
    (tmp_path / "out/table").mkdir()
    shutil.move(f"{out}/_merge/bucket=0", f"{out}/table/bucket=0")
    keyed.upsert(spark.createDataFrame([], schema), out, buckets=4)
    assert files() == made and not (tmp_path / "out/_merge").exists()
    assert keyed.latest(spark, out).count() == 50
    # a merge that was not whole is not used
    (tmp_path / "out/_merge/bucket=0").mkdir(parents=True)
    for limit in (keyed.HELD_IDS, 0):
        keyed.HELD_IDS, before = limit, keyed.HELD_IDS
        try:
            keyed.upsert(spark.createDataFrame([("d1", f"new {limit}"), (None, "none")], schema), out, buckets=4)
        finally:
            keyed.HELD_IDS = before
        rows = [(r.doc_id, r.text) for r in keyed.latest(spark, out).collect()]
        assert [t for d, t in rows if d == "d1"] == [f"new {limit}"] and len({d for d, _ in rows if d}) == 50


def send(spark, folder, *pages):
    """Pages (doc_id, page_no, n_pages, text), as one file."""
    spark.createDataFrame(list(pages), "doc_id string, page_no int, n_pages int, text string").coalesce(1).write.mode("append").parquet(folder)


def assembled(spark, tmp_path, **options):
    schema = "doc_id string, page_no int, n_pages int, text string"
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/pages")
    out = page_stream.assemble_pages(live, **options)
    return [tuple(r) for r in stream.drain(out, f"{tmp_path}/out", f"{tmp_path}/state").orderBy("doc_id", "part_no", "version").collect()]


def test_pages_in_any_order_give_one_whole_row(spark, tmp_path):
    folder = f"{tmp_path}/pages"
    send(spark, folder, ("a", 4, 5, "a4"), ("a", 1, 5, "a1"), ("b", 0, 1, None))
    send(spark, folder, ("a", 1, 5, "a1"), ("a", 0, 5, "a0"), ("c", 0, 3, "c0"))
    options = {"block_pages": 4}
    first = assembled(spark, tmp_path, **options)
    assert first == [("a", 1, 1, True, 5, [4], ["a4"]), ("b", 0, 1, True, 1, [0], [""])]
    # another run, as if a day later; a repeated page adds nothing
    send(spark, folder, ("a", 3, 5, "a3"), ("a", 4, 5, "a4"))
    send(spark, folder, ("a", 2, None, "a2"))
    second = assembled(spark, tmp_path, **options)
    whole = ("a", 0, 1, True, 5, [0, 1, 2, 3], ["a0", "a1", "a2", "a3"])
    assert second == [whole, *first]
    # a page with another text brings its part out again
    send(spark, folder, ("a", 2, 5, "a2 mended"))
    third = assembled(spark, tmp_path, **options)
    mended = ("a", 0, 2, True, 5, [0, 1, 2, 3], ["a0", "a1", "a2 mended", "a3"])
    assert third == [whole, mended, *first]
    rows = sorted(tuple(r) for r in page_stream.latest_parts(spark, f"{tmp_path}/out").collect())
    assert rows == [mended, *first]


def test_a_part_that_stays_incomplete_is_given_up_and_taken_up_again(spark, tmp_path):
    folder = f"{tmp_path}/pages"
    send(spark, folder, ("a", 0, 3, "a0"), ("b", 0, None, "b0"))
    assert assembled(spark, tmp_path, give_up=1) == []
    send(spark, folder, ("z", 0, 1, "z"))
    got = assembled(spark, tmp_path, give_up=1)
    assert got == [("a", 0, 1, False, 3, [0], ["a0"]), ("b", 0, 1, False, None, [0], ["b0"]), ("z", 0, 1, True, 1, [0], ["z"])]
    send(spark, folder, ("a", 2, 3, "a2"), ("a", 1, 3, "a1"))
    got = assembled(spark, tmp_path, give_up=1)
    assert got[1] == ("a", 0, 2, True, 3, [0, 1, 2], ["a0", "a1", "a2"]) and len(got) == 4


def test_an_old_time_stamp_is_not_late(spark, tmp_path):
    import os
    import time

    folder, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))

    def run():
        docs = stream.stream_docs(spark, folder, SCHEMA, files_per_trigger=1)
        return stream.drain(stream.dedup_stream(docs, "source_id", salts=2), out, state)

    arrive(spark, folder, [(1, "first")])
    assert run().count() == 1
    before = set(os.listdir(folder))
    arrive(spark, folder, [(2, "copied with its time")])
    for name in set(os.listdir(folder)) - before:
        os.utime(f"{folder}/{name}", (time.time() - 40 * 86400,) * 2)
    assert {r["text"] for r in run().collect()} == {"first", "copied with its time"}
