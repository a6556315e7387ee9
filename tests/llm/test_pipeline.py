import zlib

import corpus_pipeline as pipeline
import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_stages_take_what_the_last_one_kept(spark, table):
    docs = table("documents")
    kept = [docs.count()]
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        before = {r.doc_id: r.text for r in docs.collect()}
        assert all(before[r.doc_id] == r.text for r in out.collect())
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept.append(docs.count())
    assert kept[-1] > 0.5 * kept[0] and kept == sorted(kept, reverse=True)
    final = pipeline.run(spark, SF)
    assert {r.doc_id for r in final.collect()} == {r.doc_id for r in docs.collect()}


def test_labelled_junk_goes_and_clean_texts_stay(spark, table):
    labels = {r.doc_id: r for r in table("labels").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    left = {r.doc_id for r in pipeline.good(spark, table("documents"), SF).collect()}
    wrong = [i for i, r in labels.items() if (i in left) != (r.quality == 1)]
    assert len(wrong) <= 0.05 * len(labels)


def test_odd_rows_pass_through(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
