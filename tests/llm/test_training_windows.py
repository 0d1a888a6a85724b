"""Training windows come from ids that are there, whatever order rows arrive in."""

from pyspark.sql import functions as F

from critiq.llm import attention_lm
from critiq.llm.packing import default_tokenizer


def test_no_word_is_tokenized_for_windows(spark):
    texts = [f"text {k} of x{k % 3} " + "word " * (k % 90) for k in range(120)] + [None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2, "doc_id")
    own = attention_lm.coded(frame, 8)  # knows no tokenizer
    assert {r.kind for r in own.select("kind").distinct().collect()} == {0, 1}
    rows = attention_lm.chunks(frame, default_tokenizer(), 8).cache()
    want = sorted((r.n, bytes(r.windows)) for r in rows.where("windows is not null").collect())
    docs = rows.where("kind = 0").select(F.col("chunk").alias("of"), "held_out", F.col("size").alias("size"), F.col("body").alias("body"), F.col("n").alias("n"))
    lists = rows.where("kind = 3").select("chunk", "n", "size", "body")
    again = attention_lm.training_windows(docs.orderBy(F.desc("n")), lists.orderBy(F.desc("size"))).collect()
    assert sorted((r.n, bytes(r.windows)) for r in again) == want and len(want) > 0
