import zlib

import numpy as np

import corpus_pipeline
from matchmart.llm import packing, pii, quality
from test_llm_near import brute as brute_classes

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage's rows, worked out plainly from the rows before it."""
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows, kept = {}, docs
    tables = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept, SF).write.parquet(f"{tmp_path}/{i}")
        kept = spark.read.parquet(f"{tmp_path}/{i}")
        tables.append(kept)
        if i < 4:
            assert kept.columns == columns
    source = {r.doc_id: r for r in docs.collect()}

    base = {r.doc["doc_id"]: r.failed for r in quality.ledger(docs).collect()}
    good = sorted(d for d, failed in base.items() if not failed & quality.PRODUCTION.mask)
    rows = {r.doc_id: r for r in tables[0].collect()}
    assert sorted(rows) == good and all(rows[d] == source[d] for d in good)

    classes = brute_classes([(d, rows[d].text) for d in good])
    alone = sorted(d for d in good if classes[d] == d)
    assert sorted(r.doc_id for r in tables[1].collect()) == alone

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = sorted(d for d in alone if not any(t in rows[d].text for t in items))
    assert sorted(r.doc_id for r in tables[2].collect()) == clean

    redacted = {r.doc_id: r for r in tables[3].collect()}
    assert sorted(redacted) == clean
    for d in clean:
        left = redacted[d].text
        assert not pii.base_spans(left) and redacted[d].n_chars == len(left)
        if not any(c in source[d].text for c in "0123456789@"):
            assert left == source[d].text

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    want = []
    for d in clean:
        ids = tokenizer.encode(redacted[d].text, add_special_tokens=False).ids + [1]
        want += [(d, a // 4096, a, len(ids[a:a + 4096]), zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes()))
                 for a in range(0, len(ids), 4096)]
    packed = tables[4].collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(want)
    assert len({r.sequence_id for r in packed}) == -(-sum(r.length for r in packed) // 4096)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns[-2:] == ["sequence_id", "offset"]


def test_stages_on_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= len(edge_rows)
        assert stage(spark, make_docs([]), SF).collect() == []
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() >= len(edge_rows)
