"""The file source and the exact sink."""

import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from folioworks.config import EngineConfig
from folioworks.plans.ingest import ingest
from folioworks.sources import exact, files, sinks, source
from folioworks.streaming import stream


def digest(data):
    return hashlib.sha256(data).hexdigest()


def test_files_are_hashed_in_pieces_whatever_their_size(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    held = {"a.PDF": b"one", "sub/b.pdf": b"", "sub/c.pdf": os.urandom(300_000), "d.txt": b"no"}
    for name, data in held.items():
        (tmp_path / name).write_bytes(data)
    for hidden in ("_log.pdf", ".x.pdf"):
        (tmp_path / hidden).write_bytes(b"hidden")
    got = {r.name: (r.length, r.sha256, r.doc_id) for r in files.discover(spark, str(tmp_path), chunkBytes=1000).collect()}
    want = {n.split("/")[-1]: (len(d), digest(d), digest(d)[:16]) for n, d in held.items() if n != "d.txt"}
    assert got == want
    whole = files.with_file_id(files.read_files(spark, str(tmp_path))).filter("path NOT LIKE '%_log%' AND path NOT LIKE '%.x.pdf'")
    # Spark's own source passes over empty files
    assert {r.doc_id for r in whole.select("doc_id").collect()} == {d for n, _, d in want.values() if n}
    pieces = files.file_ranges(spark, str(tmp_path), ".pdf", chunkBytes=1000, taskBytes=5000)
    assert pieces.rdd.getNumPartitions() > 50
    rows = sorted((r.name, r.offset, bytes(r.content)) for r in pieces.collect())
    for name, data in held.items():
        if name != "d.txt":
            assert b"".join(c for n, _, c in rows if n == name.split("/")[-1]) == data
    with pytest.raises(FileNotFoundError):
        files.discover(spark, str(tmp_path), ".docx")
    with pytest.raises(ValueError, match="viewfs"):
        source.open_system("viewfs://store/in")


def test_a_file_beyond_two_gib(spark, tmp_path):
    size = (2 << 30) + 5
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(size - 3)
        f.seek(size - 3)
        f.write(b"end")
    row = files.discover(spark, str(tmp_path), ".bin").first()
    assert row.length == size and len(row.sha256) == 64
    last = files.file_ranges(spark, str(tmp_path), ".bin").filter(F.col("offset") > size - source.CHUNK).first()
    assert bytes(last.content).endswith(b"end")


def test_small_files_share_tasks():
    found = [(f"f{i}", 10, 0) for i in range(5000)] + [("big", 10**9, 0)]
    tasks = source.partitions_of(found, "digests", 1000, 10**6)
    assert len(tasks) == 4 and sum(len(t.found) for t in tasks) == 5001
    ranges = source.partitions_of([("big", 10_500, 0), ("none", 0, 0)], "ranges", 1000, 4000)
    assert [(r.start, r.end) for r in ranges] == [(0, 4000), (4000, 8000), (8000, 10_500), (0, 0)]


def test_ranges_of_many_small_files_share_tasks(tmp_path):
    sizes = [(i * 37) % 9000 for i in range(20_000)]
    tasks = source.partitions_of([(f"f{i}", n, 0) for i, n in enumerate(sizes)], "ranges", 1000, 4000)
    assert len(tasks) < 2 * source.MANY_TASKS
    held = [r for t in tasks for r in (t.held if isinstance(t, source.Ranges) else [t])]
    covered = {}
    for r in held:
        assert r.start == covered.get(r.path, 0) and r.start % 1000 == 0
        covered[r.path] = r.end
    assert covered == {f"f{i}": n for i, n in enumerate(sizes)}

    held = {f"{i}.txt": os.urandom(i * 37 % 5000) for i in range(1200)}
    for name, data in held.items():
        (tmp_path / name).write_bytes(data)
    tasks = source.partitions_of(source.listed(str(tmp_path), ".txt"), "ranges", 1000, 1000)
    assert len(tasks) < 2 * source.MANY_TASKS < sum(-(-len(d) // 1000) for d in held.values())
    got = {}
    for _, name, _, at, content in sorted(r for t in tasks for r in source.rows_of(t, str(tmp_path), 1000)):
        assert at == len(got.get(name, b"")) and len(content) <= 1000
        got[name] = got.get(name, b"") + content
    assert got == held


def test_a_stream_sees_every_file_once_whatever_its_time(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.pdf").write_bytes(b"first")

    def run():
        found = files.stream_files(spark, str(folder), f"{tmp_path}/log").select("name", "sha256")
        return sorted((r.name, r.sha256) for r in stream.drain(found, f"{tmp_path}/out", f"{tmp_path}/state").collect())

    assert run() == [("a.pdf", digest(b"first"))]
    (folder / "old.pdf").write_bytes(b"old")
    os.utime(folder / "old.pdf", (time.time() - 900 * 86400,) * 2)
    assert run() == [("a.pdf", digest(b"first")), ("old.pdf", digest(b"old"))]
    assert len(run()) == 2
    (folder / "a.pdf").write_bytes(b"changed")
    assert run() == sorted([("a.pdf", digest(b"changed")), ("a.pdf", digest(b"first")), ("old.pdf", digest(b"old"))])


def test_tasks_of_a_stream_do_not_get_its_account(tmp_path):
    import pickle

    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(300):
        (folder / f"{i}.txt").write_bytes(b"x")
    options = source._Options({"path": str(folder), "suffix": ".txt", "log": f"{tmp_path}/log"})
    for _ in range(2):  # a restarted stream reads its log again
        stream_reader = source._Stream(options)
        assert stream_reader.latestOffset() == {"listing": 1}
        sent = pickle.dumps(stream_reader)
        assert len(stream_reader.seen) == 300 and len(sent) < 2000
        task = stream_reader.partitions({"listing": 0}, {"listing": 1})[0]
        assert len(list(pickle.loads(sent).read(task))) == 300
    (folder / "new.txt").write_bytes(b"y")
    assert pickle.loads(sent).latestOffset() == {"listing": 2}


def tree(path):
    return {str(f.relative_to(path)): f.read_bytes() for f in path.rglob("*") if f.is_file()}


def test_files_hold_exactly_their_bytes(spark, tmp_path):
    rows = [("a/text.txt", "no line break"), ("a/other.txt", "two\r\n\n"), ("b.txt", ""), ("é/ü.txt", None), ("c.txt", "漢😀\n")]
    df = spark.createDataFrame(rows, "name string, content string").repartition(3)
    out = tmp_path / "out"
    exact.write_files(df, str(out))
    assert tree(out) == {n: (c or "").encode() for n, c in rows}
    exact.write_files(df.filter("name = 'b.txt'").withColumn("content", F.lit(b"\x00\xff")), str(out))
    assert tree(out) == {"b.txt": b"\x00\xff"}


@pytest.mark.parametrize("bad", ["../out.txt", "/tmp/x", "a/../../x", None])
def test_a_failed_write_leaves_nothing(spark, tmp_path, bad):
    out = tmp_path / "out"
    exact.write_files(spark.createDataFrame([("kept.txt", "kept")], "name string, content string"), str(out))
    rows = [(f"n{i}.txt", "x") for i in range(50)] + [(bad, "y")]
    with pytest.raises(Exception, match="no relative file name"):
        exact.write_files(spark.createDataFrame(rows, "name string, content string").repartition(4), str(out))
    assert tree(out) == {"kept.txt": b"kept"}
    with pytest.raises(Exception, match="same file name"):
        exact.write_files(spark.createDataFrame([("a", "1"), ("a", "2")], "name string, content string").repartition(2), str(out))
    assert tree(out) == {"kept.txt": b"kept"}


def test_export_follows_the_options(spark, tmp_path):
    line = "page {} of the text, long enough to be a native one."
    pages = [("d", i, 3, line.format(i)) for i in range(3)] + [("e", 0, 1, line.format("one"))]
    df = spark.createDataFrame(pages, "doc_id string, page_no int, n_pages int, text string")
    for block_pages, save, keep in ((256, False, False), (2, True, True)):
        cfg = EngineConfig(language="off", block_pages=block_pages, save_pages=save, keep_records=keep)
        bundles = ingest(df, cfg)
        out = tmp_path / f"out{block_pages}"
        sinks.export(bundles, str(out), cfg)
        made = tree(out / "files")
        texts = sorted(n for n in made if "/text" in n)
        assert texts == (["d/text.txt", "e/text.txt"] if block_pages == 256 else ["d/text-00000.txt", "d/text-00001.txt", "e/text.txt"])
        assert b"".join(made[n] for n in texts if n.startswith("d")) == "".join(line.format(i) for i in range(3)).encode()
        assert sorted(n for n in made if "page_text" in n) == (["d/page_text/0001.txt", "d/page_text/0002.txt", "d/page_text/0003.txt", "e/page_text/0001.txt"] if save else [])
        assert (out / "records").exists() == keep


def test_an_extractor_reads_large_files_piece_by_piece(spark, tmp_path):
    (tmp_path / "good.pdf").write_bytes(b"one|two")
    (tmp_path / "none.pdf").write_bytes(b"")
    (tmp_path / "bad.pdf").write_bytes(b"a|b|!")
    with open(tmp_path / "large.pdf", "wb") as f:
        f.truncate(1 << 30)
    found = files.discover(spark, str(tmp_path)).withColumn("doc_id", F.col("name"))

    def make():
        def extract(file):
            if file.size() > 1000:
                for _ in range(64):
                    file.read(1 << 24)
                    yield "x" * 500_000
                return
            for page in filter(None, file.read().split(b"|")):
                if page == b"!":
                    raise ValueError("broken")
                yield page.decode()

        return extract

    pages, errors = files.split_extracted(files.extract_files(found, make))
    sizes = {r.doc_id: (r.n, r.chars) for r in pages.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()}
    assert sizes == {"good.pdf": (2, 6), "none.pdf": (1, 0), "bad.pdf": (2, 2), "large.pdf": (64, 32_000_000)}
    assert [tuple(r) for r in errors.collect()] == [("bad.pdf", "ValueError: broken")]
