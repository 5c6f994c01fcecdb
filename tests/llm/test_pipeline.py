import re

import corpus_pipeline
from practica.llm import jaccard_join, secret_ledger
from practica.llm.common import read_table

SF = "/root/testdata/sf0.001"


def test_stages_and_their_decisions(spark):
    docs = read_table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "n-gram jaccard join", "secret scans", "mixing sources to target weights",
                     "best-fit packing"]
    toxic, once, secret, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    a = toxic(spark, docs, SF).cache()
    assert a.columns == docs.columns and 0 < a.count() <= docs.count()
    b = once(spark, a, SF).cache()
    classes = jaccard_join.link_documents(a).select("class_id").distinct().count()
    assert b.columns == docs.columns and b.count() == classes
    assert jaccard_join.link_documents(b).filter("n_links > 0").count() == 0
    c = secret(spark, b, SF).cache()
    assert c.columns == docs.columns and c.count() == classes
    assert not any(secret_ledger.find_spans(r.text) for r in c.collect())
    d = mix(spark, c, SF).cache()
    assert d.columns == docs.columns
    e = pack(spark, d, SF)
    assert e.groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").count() == 0
    whole = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in c.collect())
    mixed = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in d.collect())
    assert abs(mixed - 1.5 * whole) < 0.05 * whole


def test_odd_documents_and_no_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF).cache()
            assert out.columns == docs.columns or name == "best-fit packing"
            docs = out


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)
