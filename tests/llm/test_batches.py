"""What Python workers and executors hold of texts at a time."""

import numpy as np
import pyarrow as pa

from tallyline.llm import decontaminate, packing
from tallyline.llm.tables import small_batches


def test_scan_sends_the_text_once(spark, make_docs):
    bench = spark.createDataFrame([(1, "short item")], "item_id int, text string")
    docs = make_docs([(1, "a short item"), (2, None), (3, "other")])
    found = decontaminate._scanned(docs, bench, "TEXT", "item_id", "text", 10)
    assert found.columns == ["row", "n_words", "hits", "items"]
    assert found.schema.json().count('"text"') == 1
    assert sorted((r.row.doc_id, r.n_words, len(r.hits)) for r in found.collect()) == [(1, 3, 1), (2, 0, 0), (3, 1, 0)]


def test_batches_of_texts_are_small(spark):
    small_batches(spark)
    texts = spark.range(0, 60, 1, 1).selectExpr("repeat('x', 100000) as text")
    sizes = texts.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert sum(r.n for r in sizes) >= 6_000_000 and max(r.n for r in sizes) < 2_000_000


def test_rests_do_not_hold_whole_documents():
    group = packing._Group(8, 100, True, None, iter(range(10**6)), [])
    group.add(1, np.arange(8003, dtype=np.uint32))
    assert [x[2].tolist() for x in group.rests] == [[8000, 8001, 8002]] and group.rests[0][2].base is None
