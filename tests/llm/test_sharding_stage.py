"""The stage `sharding` deals ids and hashes; whole rows are shuffled once."""

from collections import Counter

import corpus_pipeline


def test_whole_rows_are_not_dealt(spark, monkeypatch):
    dealt = []

    def recorded(docs, *args, **kwargs):
        dealt.append(docs.columns)
        return shuffle_to_shards(docs, *args, **kwargs)

    shuffle_to_shards = corpus_pipeline.shuffle_to_shards
    monkeypatch.setattr(corpus_pipeline, "shuffle_to_shards", recorded)
    rows = [(i % 37, f"text {i % 50}", 9, 9) for i in range(300)] + [(1, "same", 1, 2)] * 20 + [(None, None, None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard int, slot bigint")
    found = [(r["doc_id"], r["text"], r["shard"], r["slot"]) for r in corpus_pipeline.shards(spark, docs, "").collect()]
    assert Counter(f[:2] for f in found) == Counter(r[:2] for r in rows)
    for s in range(8):
        slots = sorted(f[3] for f in found if f[2] == s)
        assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 8, len(rows) // 8 + 1)
    assert dealt and all("text" not in columns for columns in dealt)
