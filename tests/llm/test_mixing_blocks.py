"""op5 takes what the splitting tree has dealt."""

from checks.compare import compare, connect
from reshard.llm import mixing, queries
from reshard.llm.oracles import ORACLES


def test_the_query_counts_dealt_copies(spark, sf, monkeypatch):
    dealt, deal = [], mixing.deal_blocks
    monkeypatch.setattr(queries, "deal_blocks", lambda mixed: dealt.append(deal(mixed)) or dealt[-1])
    out = queries.op5_mixing(spark, sf)
    assert compare(out, connect(sf), ORACLES["op5_mixing"]) is None
    sizes = {r["doc_id"]: r["size"] for r in out.collect()}
    assert sum(r["taken"] for r in out.collect()) == sum(sizes[r["doc"]["doc_id"]] for r in dealt[0].collect())
    per_shard = dealt[0].groupBy("shard").count().collect()
    assert len(per_shard) == 8
