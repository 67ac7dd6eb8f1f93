"""Decontamination splits each text once."""

from pyspark.sql import functions as F

from reshard.llm import decontamination


def test_texts_are_split_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(text):
        calls.add(1)
        return text

    texts = ["a b c d", "x B c y", None, "", "B-C", "b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    items = spark.createDataFrame([("x", "b c"), ("none", "q r")], "item_id string, text string")
    out = decontamination.decontaminate(docs.withColumn("text", F.udf(seen).asNondeterministic()("text")), items)
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in out.collect()}
    assert found == {0: (4, 2, 1), 1: (4, 2, 1), 2: (0, 0, 0), 3: (0, 0, 0), 4: (2, 2, 1), 5: (2, 2, 1)}
    assert calls.value == len(texts)
