"""What bounds rows and bytes: packs of copied conversations, slices of Arrow batches, join keys in six bytes."""

import numpy as np
import pyarrow as pa

from millrace.llm import chat, jaccard
from millrace.llm.queries import tokenizer_path


def test_packs_of_copies_have_few_leaves(spark, monkeypatch):
    """Copies add no tokens, so only the number of leaves ends their pack; all come back."""
    monkeypatch.setattr(chat, "LEAVES", 5)
    turns = [(c, t, role, text) for c in range(40) for t, (role, text) in enumerate([("user", "hello"), ("assistant", "good day"), ("user", f"bye {c // 20}")])]
    path = tokenizer_path("byte_bpe_50k.json")
    packs = chat.pack(chat.conversations(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")), path, partitions=2).persist()
    sizes = [len(r["leaves"]) for r in packs.select("leaves").collect()]
    assert max(sizes) <= 5 and sum(sizes) == 40
    back = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.read(packs, path).collect()}
    assert back == {c: [("user", "hello"), ("assistant", "good day"), ("user", f"bye {c // 20}")] for c in range(40)}


def test_few_rows_at_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 300_000] * 11 + ["y"])], ["t"])
    parts = list(chat.few_rows([batch, batch.slice(0, 0)]))
    assert sum(p.num_rows for p in parts) == 12 and max(p.num_rows for p in parts) <= 3
    assert pa.Table.from_batches(parts).column("t").to_pylist() == batch.column("t").to_pylist()
    big = pa.RecordBatch.from_arrays([pa.array(["x" * (2 * chat.AT_ONCE)] * 2)], ["t"])
    assert [p.num_rows for p in chat.few_rows([big])] == [1, 1]


def test_keys_in_six_bytes():
    rng = np.random.default_rng(8)
    near = np.unique(rng.integers(0, 1 << 48, 1_000_000, np.uint64))[:5000]
    wide = np.array([0, 1, (1 << 48) - 1], np.uint64)
    none = np.zeros(0, np.uint64)
    rows = [near, none, wide, near[:1]]
    assert jaccard._from_rising([jaccard._rising(x) for x in rows]).tolist() == np.concatenate(rows).tolist()
    assert len(jaccard._rising(near)) < 4.1 * len(near)
    assert jaccard._from_six([jaccard._six(x) for x in rows]).tolist() == np.concatenate(rows).tolist()
    assert jaccard._from_six([]).tolist() == [] and len(jaccard._six(near)) == 6 * len(near)
