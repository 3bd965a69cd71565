import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyfold.llm import decontaminate, quality

from test_operators import naive_components, naive_dedup


def test_every_stage_against_brute_force(spark, tmp_path):
    source = "/root/testdata/sf0.01"
    sf = str(tmp_path)
    ids = spark.read.parquet(f"{source}/documents.parquet").where("n_chars < 1500").orderBy("doc_id").limit(150)
    extra = spark.createDataFrame([(10_000, None, "en", "s", 0), (10_001, "", "en", "s", 0)], ids.schema)
    ids.unionByName(extra).write.parquet(f"{sf}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{t}.parquet").write.parquet(f"{sf}/{t}.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}

    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality.score(docs, model, keep=["doc_id"]).collect()}
    want = {i: t for i, t in texts(docs).items() if scores[i] >= 0.3}
    stages = dict(corpus_pipeline.STAGES)
    one = stages["quality classifier"](spark, docs, sf).cache()
    assert texts(one) == want and one.columns == docs.columns

    order = sorted(want)
    want = dict(zip(order, naive_dedup([want[i] for i in order]), strict=True))
    two = stages["line dedup"](spark, one, sf).cache()
    assert texts(two) == want and two.where(F.col("n_chars") != F.length("text")).count() == 0

    order = sorted(want)
    labels = naive_components([want[i] for i in order], 80, 5)
    want = {i: want[i] for i, (k, (_, c)) in zip(order, enumerate(labels), strict=True) if c == k}
    three = stages["n-gram Jaccard join"](spark, two, sf).cache()
    assert texts(three) == want

    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {i: t for i, t in want.items() if not decontaminate.brute_force(t, items)[1]}
    four = stages["benchmark decontamination"](spark, three, sf).cache()
    assert texts(four) == want

    reference = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    got = {}
    for r in stages["packing"](spark, four, sf).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
    assert {i: [x for _, p in sorted(v) for x in p] for i, v in got.items()} == {i: reference.encode(t or "", add_special_tokens=False).ids + [2] for i, t in want.items()}
