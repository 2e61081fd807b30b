"""The pipeline's stages, each on what the one before kept."""

import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from ledgerline.llm import byte_bpe, mixing, secrets, simhash


def test_stages(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "byte_bpe":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        seen[name] = (docs, out)
        docs = out
    before, after = seen["simhash_near_dedup"]
    groups = {r.component_id for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(groups)
    before, after = seen["secret_scan"]
    assert before.count() == after.count()
    assert secrets.scan(after).where("n_assign + n_access + n_hex > 0").count() == 0
    before, after = seen["source_mixing"]
    words = after.select(mixing.n_words(after["text"]).alias("n")).selectExpr("sum(n)").first()[0]
    assert words == mixing.mix(before).selectExpr("sum(taken)").first()[0]
    before, after = seen["byte_bpe"]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(f.read()), special_tokens={})
    assert sorted((r.doc_id, list(r.ids)) for r in after.collect()) == sorted((r.doc_id, library.encode_ordinary(r.text)) for r in before.collect())


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_tokens_are_decoded_again(spark):
    texts = {1: "plain words", 2: "", 3: None, 4: "é 漢字 \U0001f600"}
    found = corpus_pipeline.tokenize(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "").collect()
    assert {r.doc_id: r.decoded_sha256 for r in found} == {k: hashlib.sha256((t or "").encode()).hexdigest() for k, t in texts.items()}
