"""Words are counted without making lists of them."""

import random

from pyspark.sql import functions as F

from reshard.llm.decontamination import decontaminate, words_in, words_of


def test_counts_are_those_of_the_lists(spark):
    rnd = random.Random(7)
    signs = "aZ09 .,-_@[`{~\n\t\x00\x7f\u00e9\u0130\u212a\u00df\u2003\u4e2d\U0001f600"
    texts = [None, "", " ", "a", " a", "a ", "A-B", *("".join(rnd.choices(signs, k=rnd.randrange(40))) for _ in range(500))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", words_in(F.col("t")).alias("n"), F.size(words_of(F.col("t"))).alias("m"))
    assert [r for r in rows.collect() if r["n"] != r["m"]] == []


def test_documents_are_split_twice_only(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id int, text string")
    items = spark.createDataFrame([("x", "b c")], "item_id string, text string")
    out = decontaminate(docs, items)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and out.first()["n_words"] == 3 and out.first()["n_hit"] == 2
