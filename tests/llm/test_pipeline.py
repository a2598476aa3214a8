import corpus_pipeline as cp
from ridemart.llm import decontamination, packing, pii, quality, simhash
from ridemart.llm.common import crc_mod

SF = "/root/testdata/sf0.001"


def test_stages_and_result(spark, docs):
    """Each stage's rows against its operator's answers on the whole input of that stage."""
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    frames = [docs]
    for name, stage in cp.STAGES[:-1]:
        frames.append(stage(spark, frames[-1], SF).cache())
        assert frames[-1].columns == docs.columns and frames[-1].count() > 0
    texts = [{r.doc_id: r.text for r in f.collect()} for f in frames]
    score = {r.row.doc_id: r.score for r in quality.score_quality(docs, quality.fit_model(docs, labels, crc_mod("doc_id", 5) != 0)).collect()}
    assert set(texts[1]) == {i for i, s in score.items() if s >= 0.3}
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(frames[1]).collect()}
    assert set(texts[2]) == {i for i, c in groups.items() if i == c} and len(texts[2]) < len(texts[1])
    dirty = {r.row.doc_id for r in decontamination.find_matches(frames[2], bench).collect() if r["items"]}
    assert set(texts[3]) == set(texts[2]) - dirty
    new = {r.row.doc_id: r.text for r in pii.replace_entities(frames[3]).collect()}
    assert texts[4] == new
    assert all(r.n_chars == len(r.text) for r in frames[4].collect())
    pieces = [tuple(r) for r in cp.run(spark, SF).select(*packing.PIECES).collect()]
    tokens = packing.WordTokenizer(packing.default_tokenizer())
    sizes = {i: len(tokens.encode([t.encode()])[0]) // tokens.dtype.itemsize + 1 for i, t in texts[4].items()}
    assert {p[0]: p[4] for p in pieces} == sizes
    assert sum(p[2] for p in pieces) == sum(sizes.values())
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None
