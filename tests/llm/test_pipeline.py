import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from faultline.llm import exact_dedup, simhash
from faultline.llm.shared import saved


def test_each_stage_keeps_its_promise(spark, docs, none, texts):
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(saved(stage(spark, frames[-1], "")))
    raw, spoken, single, distinct, cut, packed = frames
    for frame in frames[:-1]:
        assert frame.columns == docs.columns
    assert {r.doc_id for r in raw.collect()} - {r.doc_id for r in spoken.collect()} == {i for i, x in texts if not any(c.isalpha() for c in x or "")}
    assert single.filter("doc_id is not null").dropDuplicates(["text"]).count() == single.filter("doc_id is not null").dropDuplicates(["doc_id"]).count()
    assert exact_dedup.exact_duplicates(single.dropDuplicates(["doc_id"])).filter("group_size > 1").count() == 0
    assert simhash.near_duplicates(distinct).filter("doc_id <> component_id").count() == 0
    assert cut.count() == distinct.count() and cut.filter("n_chars <> length(text)").count() == 0
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packed.agg({"length": "sum"}).first()[0] == sum(len(library.encode(r.text or "").ids) + 1 for r in cut.collect())


def test_no_documents(spark, none):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").collect() == [], name
