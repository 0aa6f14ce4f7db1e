"""The pipeline stage by stage, and every registered query of this part on the smallest data."""

import os

import pytest

import corpus_pipeline
from wardline.llm import quality_classifier, simhash
from wardline.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_stages_take_effect(spark):
    from test_dedup import BLANK, exact_want, print_want, substring_want, union_find

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, stages = docs.schema, dict(corpus_pipeline.STAGES)
    one = stages["quality classifier"](spark, docs, DATA).cache()
    model = quality_classifier.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    bad = {r.doc_id for r in quality_classifier.scores(docs, model).collect() if not r.predicted}
    kept = {r.doc_id for r in docs.collect()} - bad
    assert one.schema == columns and {r.doc_id for r in one.collect()} == kept and bad

    two = stages["exact dedup"](spark, one, DATA).cache()
    pairs = [(r.doc_id, r.text) for r in one.collect()]
    assert two.schema == columns and {r.doc_id for r in two.collect()} == {r[0] for r in exact_want(pairs) if r[3]}

    three = stages["simhash near-dedup"](spark, two, DATA).cache()
    pairs = sorted((r.doc_id, r.text) for r in two.collect())
    prints = [print_want(t) for _, t in pairs]
    near = [(a, b) for a in range(len(pairs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= simhash.LIMIT]
    assert three.schema == columns and {r.doc_id for r in three.collect()} == {pairs[k][0] for k in set(union_find(len(pairs), near))}

    four = stages["substring dedup"](spark, three, DATA).cache()
    pairs = [(r.doc_id, r.text) for r in three.collect()]
    lost = {i: n for i, _, n, _ in substring_want(pairs, 35)}
    before = dict(pairs)
    assert four.schema == columns and four.count() == len(pairs)
    for r in four.collect():
        assert (r.text == before[r.doc_id]) if not lost[r.doc_id] else len(r.text.split()) == len(BLANK.sub(" ", before[r.doc_id]).split()) - lost[r.doc_id]

    five = stages["best-fit packing"](spark, four, DATA).collect()
    assert {r.doc_id for r in five} == {r.doc_id for r in four.collect()}
    whole = corpus_pipeline.run(spark, DATA).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, five))


def test_pipeline_on_odd_rows(spark, documents, odd_pairs, tmp_path):
    """Nulls, empty and long texts, ties, repeats and clashing names through all stages, with no label, some, and no rows."""
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (105, None, 0)], schema)
    for name, docs, known in (("none", documents(odd_pairs), labels.limit(0)), ("some", documents(odd_pairs), labels), ("empty", documents([]), labels)):
        folder = f"file://{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        known.write.parquet(f"{folder}/labels.parquet")
        frame = spark.read.parquet(f"{folder}/documents.parquet")
        kept = [frame]
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept.append(stage(spark, kept[-1], folder))
            assert kept[-1].schema == frame.schema
        sizes = [k.count() for k in kept]
        assert sizes == sorted(sizes, reverse=True) and (name != "none" or sizes[1] == len(odd_pairs))
        pieces = corpus_pipeline.run(spark, folder).collect()
        assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)
        assert sorted(str(r.doc_id) for r in pieces if r.piece == 0) == sorted(str(r.doc_id) for r in kept[-1].select("doc_id").collect())
        if name == "none":  # of equal texts one row is left: blanks and nulls are one text, "same" in its spellings another
            ids = {r.doc_id for r in kept[2].collect()}
            assert len(ids & {100, 101, 102}) == 1 and len(ids & {105, 106, 107}) == 1 and len(ids & {103, 104}) == 1
        assert name != "empty" or not pieces


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, DATA).toPandas()
    assert len(got)
    if name in SQL:
        duckdb = pytest.importorskip("duckdb")
        from verify import TABLES, compare

        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
        assert compare(got, con.sql(SQL[name]).df()) == "ok"
