import pyarrow as pa

import corpus_pipeline
from aurum.llm import common, presplit
from aurum.llm.packing import encoder


def test_slices_are_whole_and_in_order():
    batches = [pa.RecordBatch.from_pydict({"x": list(range(a, b))}) for a, b in ((0, 1300), (1300, 1300), (1300, 1307))]
    got = list(common.sliced(batches, 512))
    assert [b.num_rows for b in got] == [512, 512, 276, 7]
    assert [x for b in got for x in b.column(0).to_pylist()] == list(range(1307))


def test_forget_drops_what_encoding_keeps():
    first = encoder(presplit.default_path())
    assert encoder(presplit.default_path()) is first
    presplit.forget()
    assert encoder(presplit.default_path()) is not first


def test_pipeline_stages_send_texts_in_small_batches(spark, table):
    before = spark.conf.get(common.BATCH_ROWS)
    try:
        spark.conf.set(common.BATCH_ROWS, common.DEFAULT_ROWS)
        docs = table([(i, f"some text {i}") for i in range(3000)]).coalesce(1)
        packed = corpus_pipeline.packing(spark, docs, "")
        sizes = docs.select("doc_id").mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in it), "n long").collect()
        assert sum(r.n for r in sizes) == 3000 and max(r.n for r in sizes) <= common.TEXT_ROWS
        assert {r.doc_id for r in packed.select("doc_id").collect()} == set(range(3000))
        spark.conf.set(common.BATCH_ROWS, "77")  # the user's own
        corpus_pipeline.packing(spark, docs, "")
        assert spark.conf.get(common.BATCH_ROWS) == "77"
    finally:
        spark.conf.set(common.BATCH_ROWS, before)
