"""The mixing stage of the pipeline deals what is taken in blocks of the sources."""

from collections import Counter

import corpus_pipeline
from reshard.llm.mixing import deal_blocks, mix


def test_copies_are_dealt_by_the_splitting_tree(spark, tmp_path):
    words = ["one two", "three", "a b c d e", "", None, "x y z"]
    rows = [(n // 2 if n % 7 else None, words[n % 6], "abc"[n % 3] if n % 11 else None, n % 2) for n in range(300)]
    rows += [(500, "same row", "a", 1)] * 9 + [(500, "same row", "a", 0)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id bigint, text string, source string, shard int").write.parquet(path)
    docs = spark.read.parquet(path)
    found = corpus_pipeline.mix_sources(spark, docs, str(tmp_path)).collect()
    assert {"doc_id", "text", "source", "shard", "slot"} == set(found[0].asDict())

    key = ("doc_id", "text", "source")
    dealt = deal_blocks(mix(docs)).collect()
    assert Counter(tuple(r[c] for c in key) for r in found) == Counter(tuple(r["doc"][c] for c in key) for r in dealt)
    # The same number of copies of each source in each shard, and no slot is left out.
    assert Counter((r["source"], r["shard"]) for r in found) == Counter((r["source"], r["shard"]) for r in dealt)
    for shard in range(8):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    again = corpus_pipeline.mix_sources(spark, docs.repartition(3), str(tmp_path)).collect()
    assert Counter(map(str, found)) == Counter(map(str, again))
