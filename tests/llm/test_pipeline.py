"""The pipeline's stages against plain versions on a small table."""

import corpus_pipeline
from quarry.llm import op8_language, queries

SF = "/root/testdata/sf0.001"


def test_stages_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        rows = out.collect()
        ids = {r["doc_id"] for r in rows}
        assert ids <= seen and len(ids) == len(rows), name
        if name == "substring_dedup":
            assert ids == seen and all(r["n_chars"] == len(r["text"]) for r in rows)
        docs, seen = spark.createDataFrame(rows, out.schema), ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == seen
    whole = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(whole) == key(packed)


def test_stages_on_odd_and_empty_tables(odd, nothing, spark):
    """Every stage takes nulls, empty texts, repeated rows and ids, and no rows at all."""
    for table in (odd, nothing):
        docs = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert out.columns == docs.columns and len(rows) <= docs.count(), name
            docs = spark.createDataFrame(rows, out.schema)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


def test_language_stage_uses_its_prediction(spark, sample):
    """Against the plain rule on the scores; mixtures, other languages and texts without letters go."""
    model = op8_language.train(sample)
    half = [(r["text"] or "") for r in sample.where("lang = 'de'").limit(1).collect()] + [(r["text"] or "") for r in sample.where("lang = 'fr'").limit(1).collect()]
    mixed = " ".join(x for pair in zip(*[h.split()[:150] for h in half]) for x in pair)
    extra = [(10 ** 6, mixed, None, "s", 1), (10 ** 6 + 1, "123 !!", "en", "s", 1), (10 ** 6 + 2, None, "en", "s", 1), (10 ** 6 + 3, half[0], None, "s", 1)]
    docs = sample.unionByName(spark.createDataFrame(extra, sample.schema)).repartition(3)
    scores = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in op8_language.identify(docs, model).collect()}
    for languages, least in ((None, 0.5), (["en", "de"], 0.5), (None, 0.9)):
        kept = {r["doc_id"]: r for r in op8_language.keep_identified(docs, model, languages, least).collect()}
        assert set(kept) == {i for i, (p, s) in scores.items() if p != "und" and s >= least and (languages is None or p in languages)}
    kept = {r["doc_id"]: r for r in op8_language.keep_identified(docs, model, None, 0.7).collect()}
    assert 10 ** 6 + 1 not in kept and 10 ** 6 + 2 not in kept and 10 ** 6 not in kept
    assert kept[10 ** 6 + 3]["lang"] == "de" and len(kept) > 0.97 * sample.count()


def test_every_query_is_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "packing"]
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
