"""The pipeline's near copies go through the index of op9: fingerprints that link by blocks of equal bits."""

import random

from pyspark.sql import functions as F

from weir.llm import simhash


def test_links_of_fingerprints_without_a_common_band(spark):
    rng, texts = random.Random(5), []
    while len(texts) < 8:
        words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        other = [*words[:-1], "edited"]
        a, b = (simhash.sketch(" ".join(x), 5)[0] & (2**64 - 1) for x in (words, other))
        if 0 < ((a ^ a >> 1) ^ (b ^ b >> 1)).bit_count() <= 2:
            texts += [" ".join(words), " ".join(other)]
    texts += [texts[0].upper(), "one of its own"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one = simhash.sketches(df, "text", 5).withColumn("keys", F.transform("keys", lambda k: F.xxhash64(k, "node"))).localCheckpoint()
    roots = {r["node"]: r["root"] for r in simhash._Links(df, one, "text", 5, 0.8).all().collect()}
    node = {r["doc_id"]: r["node"] for r in df.select("doc_id", simhash._node("text").alias("node")).collect()}
    root = [roots.get(node[i], node[i]) for i in range(len(texts))]
    assert [root.index(r) for r in root] == [0, 0, 2, 2, 4, 4, 6, 6, 0, 9]
