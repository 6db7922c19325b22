"""The pipeline's stages hang together and each one's decisions take effect."""

import corpus_pipeline
from stationcast.llm import common, exact_dedup, mixing, ngram_join, packing
from odd import SF, given, low, odd_docs


def test_stages_take_effect(spark):
    docs = given(spark)
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.cut(stage(spark, before, SF), name)
        at[name] = (before, docs)
        if name != "bestfit_pack":
            assert docs.columns == given(spark).columns
    ids = lambda d: {r["doc_id"] for r in d.select("doc_id").collect()}
    before, after = at["exact_dedup"]
    kept = {}
    for r in before.collect():
        kept[low(r["text"])] = max(kept.get(low(r["text"]), -1), r["doc_id"])
    assert ids(after) == set(kept.values())
    before, after = at["ngram_jaccard_join"]
    rows = ngram_join.near_duplicates(before).collect()
    assert ids(after) == {r["component_id"] if r["n_shingles"] else r["doc_id"] for r in rows}
    before, after = at["source_mix"]
    assert ids(after) == {r["doc_id"] for r in mixing.mix_decisions(before).collect() if r["copies"]}
    before, after = at["bestfit_pack"]
    assert sum(r["piece"] == 0 for r in after.collect()) == before.count()
    assert exact_dedup and packing


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 100


def test_odd_rows_and_clashing_columns(spark):
    docs = odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.cut(stage(spark, docs, SF), name)
        assert name == "bestfit_pack" or docs.columns == before.columns
    assert sum(r["piece"] == 0 for r in docs.collect()) == before.count() > 0
