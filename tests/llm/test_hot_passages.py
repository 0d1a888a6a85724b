import random

import pyarrow as pa

from critiq.llm import suffix_dedup as sd
from llm_texts import prose
from test_near_duplicates import plain_substrings


def passage_docs(n):
    """Documents that share a passage and go on in different ways, some of them for a while alike."""
    rng = random.Random(21)
    passage = prose(rng, 40)
    tails = [prose(rng, 30) for _ in range(n // 3)]
    return [(i, prose(rng, 8) + " " + passage + " " + rng.choice(tails)[: rng.randint(20, 150)] + str(i)) for i in range(n)]


def test_a_large_group_is_not_held(monkeypatch):
    monkeypatch.setattr(sd, "SHARD_BYTES", 600)
    lookups = []
    monkeypatch.setattr(sd, "_looked_up", lambda shard, earlier: lookups.append(len(earlier)) or [])
    rows = [(1, i, 0, 30, random.Random(i).randbytes(129)) for i in range(400)]
    columns = [pa.array(c) for c in zip(*rows)]
    batch = pa.RecordBatch.from_arrays(columns, ["key", "doc", "start", "n", "piece"])
    out = list(sd._repeated_in_groups(iter([batch]), sd.LENGTH))
    assert max(lookups) <= sd.MOST_SHARDS
    assert sum(b.num_rows - b.column(3).null_count for b in out) == 400 * 30


def test_passage_shared_by_many_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sd, "SHARD_BYTES", 600)
    docs = passage_docs(150)
    want = plain_substrings(docs, sd.LENGTH)
    got = sd.dedup_substrings(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == want
