import corpus_pipeline
from caretrail.llm.decontaminate import leaks
from caretrail.llm.ngram_join import document_components
from caretrail.llm.quality import quality_scores
from caretrail.llm.secrets import masked, scan, spelled

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_does_what_its_operator_says(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    docs, labels, bench = read("documents"), read("labels"), read("benchmark")
    extra = [(90001, None, "en", "s", None), (90002, "", "en", "s", 0), (None, "some words without an id in a plain sentence", "en", "s", 44)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality classifier"](spark, docs, FOLDER)
    scores = quality_scores(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in good.collect()) == sorted(str(r.doc_id) for r in scores if r.predicted)

    one = stages["n-gram Jaccard join"](spark, docs, FOLDER)
    groups = {(r.component_id if r.n_shingles else f"none {r.doc_id}") for r in document_components(docs).collect()}
    assert one.count() == len(groups)

    clean = stages["benchmark decontamination"](spark, docs, FOLDER)
    bad = {r.doc_id for r in leaks(docs, bench).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad and bad

    hidden = {r.doc_id: r for r in stages["secret scans"](spark, docs, FOLDER).collect()}
    for r in docs.collect():
        base, added = scan(r.text or "")
        expected = masked(r.text, spelled({*base, *added})) if r.text else r.text
        assert hidden[r.doc_id].text == expected and hidden[r.doc_id].source == r.source

    last = stages["SentencePiece encoding and decoding"](spark, docs, FOLDER).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(last) == len(texts) and all(r.text == texts[r.doc_id] and r.n_pieces == len(r.ids) for r in last)

    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), FOLDER).columns == docs.columns, name


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    expected = sorted((r.doc_id, r.n_pieces, r.text) for r in docs.collect())
    assert sorted((r.doc_id, r.n_pieces, r.text) for r in corpus_pipeline.run(spark, FOLDER).collect()) == expected
