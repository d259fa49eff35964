"""The pipeline's stages: order, columns and what each of them may take away."""

import corpus_pipeline
from canton.llm.queries import QUERIES


def test_stages(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights",
        "SentencePiece encoding and decoding",
    ]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    scored = {r.doc_id: r.predicted for r in QUERIES["op1_toxicity"](spark, sf_dir).collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "stage")
        rows = docs.collect()
        ids = {r.doc_id for r in rows}
        assert len(ids) == len(rows) and ids <= set(before)
        sizes.append(len(ids))
        if name == "toxicity":
            assert ids == {i for i, p in scored.items() if not p}
        if name == "line dedup":
            assert len(ids) == sizes[0] and all(len(r.text) <= len(before[r.doc_id]) for r in rows)
        if name == "n-gram Jaccard join":
            assert len({r.text for r in rows}) == len(rows)
        if stage is not corpus_pipeline.encoding:
            assert docs.columns == columns
            before = {r.doc_id: r.text for r in rows}
    assert sizes[0] > sizes[2] > sizes[3] == sizes[4] > 0
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    again = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert again == {r.doc_id: r.ids for r in rows}
