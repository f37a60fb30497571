"""What the counts of the similarity join send through the shuffle."""

import numpy as np
import pyarrow as pa

from llm import jaccard_join
from llm.common import prepare


def test_packed_runs_grow_with_tokens_not_buckets(spark, monkeypatch):
    prepare(spark)
    given = []
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    plain = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: given.append(f) or plain(self, f, schema))
    monkeypatch.setattr(jaccard_join, "slots", lambda spark: 200)
    jaccard_join.hot_tokens(docs, 4)
    count, add = given
    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.integers(0, 1000, size=50))) for _ in range(400)] + ["x y z w v"] * 12
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    tokens = 400 * 47 + 12 * 2
    runs = list(count(iter([batch])))
    # 3 bytes a token, and 65,536 steps of 2^24 over all buckets at most, for each of two columns; with others less than 1 MB.
    assert sum(r.nbytes for r in runs) < 6 * tokens + 2 * 3 * 65_536 + 1_000_000
    hot = pa.Table.from_batches(add(iter(runs))).to_pydict()
    _, token = jaccard_join.shingle_sets([b"x y z w v"], 4)
    assert hot == {"token": sorted(jaccard_join.fingerprints(token).tolist()), "n": [12, 12]}


def test_packed_from_a_start():
    start = 5 << 36
    for values in ([], [start], [start + 7, start + 7 + 0xFFFFFF, start + (1 << 36) - 1]):
        packed = jaccard_join.pack_differences(np.array(values, np.int64), start)
        assert len(packed) <= 3 * (len(values) + (1 << 36) // 0xFFFFFF + 1)
        assert jaccard_join.unpack_differences(packed, start).tolist() == values
