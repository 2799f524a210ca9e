"""Python workers copy out and compute on small pieces, and the fit makes no copy of its sample."""

import tracemalloc

import numpy as np
import pyarrow as pa

from pricelens.llm import common, nbsvm


def batch(n: int, size: int) -> pa.RecordBatch:
    texts = [None if i % 7 == 0 else (b"word%d " % i) * (size // 8) for i in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(texts, pa.binary())], ["id", "text"])


def peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_blocks_copy_one_piece_at_a_time():
    rows = batch(400, 50_000)
    pieces = list(common.blocks(iter([rows]), "text", 200_000))
    assert [i for part, _ in pieces for i in part.column("id").to_pylist()] == list(range(400))
    assert [t or None for _, texts in pieces for t in texts] == rows.column("text").to_pylist()
    assert all(sum(map(len, texts)) <= 200_000 for _, texts in pieces)
    assert peak(lambda: [None for _ in common.blocks(iter([rows]), "text", 200_000)]) < 2_000_000


def test_log_count_ratio_takes_no_memory_by_the_sample():
    rng = np.random.default_rng(1)
    slots = [np.unique(rng.integers(0, nbsvm.SLOTS, 2000)).astype(np.int32) for _ in range(1500)]
    y = np.arange(1500) % 3 % 2
    flat, label = np.concatenate(slots), np.repeat(y, [len(s) for s in slots])
    p, q = (1.0 + np.bincount(flat[label == k], minlength=nbsvm.SLOTS) for k in (1, 0))
    assert (nbsvm.log_count_ratio(slots, y) == np.log((p / p.sum()) / (q / q.sum()))).all()
    assert peak(lambda: nbsvm.log_count_ratio(slots, y)) < 12 << 20 < 2 * flat.nbytes


def test_settled_tables_send_small_batches_and_leave_the_session_alone(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    df = spark.range(0, 3000, 1, 1).selectExpr("repeat(cast(id AS string), 2000) AS t").mapInArrow(sizes, "n long")
    before = spark.conf.get(common.BATCH_BYTES, None)
    assert max(r.n for r in common.settle(df, "sizes").collect()) < 6_000_000
    assert spark.conf.get(common.BATCH_BYTES, None) == before
