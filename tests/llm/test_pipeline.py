import corpus_pipeline
from linkloom.llm import decontamination, minhash, mixing, quality

DATA = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names, held = [n for n, _ in corpus_pipeline.STAGES], docs
    assert names == ["quality", "near_dedup", "decontaminate", "mixture", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, held, DATA)
        path = spark.conf.get("spark.checkpoint.dir") + f"/test-{name}"
        out.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        assert out.columns == docs.columns
        before, after = {r.doc_id for r in held.select("doc_id").collect()}, {r.doc_id for r in out.select("doc_id").collect()}
        assert after and after <= before
        if name == "quality":
            model = quality.fit_on(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
            assert after == {r.doc_id for r in held.collect() if model.score((r.text or "").encode()) >= quality.THRESHOLD}
        if name == "near_dedup":
            assert after == {r.doc_id for r in minhash.near_duplicates(held).where("kept").collect()}
        if name == "decontaminate":
            bad = {r.doc_id for r in decontamination.matches(held, spark.read.parquet(f"{DATA}/benchmark.parquet")).collect()}
            assert after == before - bad
        if name == "mixture":
            assert out.count() == mixing.counted(held).selectExpr("sum(n_copies)").first()[0]
        held = out
    last = corpus_pipeline.STAGES[-1][1](spark, held, DATA).collect()
    assert len(last) == held.count()
    rows = sorted(last, key=lambda r: r.start)
    assert rows[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


def test_token_files_follow_the_mixture(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id is not null").limit(60)
    mixed = mixing.mix(docs).orderBy("position").collect()
    path = spark.conf.get("spark.checkpoint.dir") + "/test-order"
    spark.createDataFrame(mixed).select(*docs.columns).write.mode("overwrite").parquet(path)
    got = corpus_pipeline.tokens(spark, spark.read.parquet(path), DATA).orderBy("start").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in mixed] and len(got) > len({r.doc_id for r in got})
