import corpus_pipeline
import pytest

from fieldlens.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "BPE":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert out.dtypes == docs.dtypes
            assert out.join(docs, "doc_id", "left_anti").count() == 0
        else:
            assert out.count() == docs.count()
    rows = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(rows) <= docs.count() and all(len(r.ids) == r.n_tokens for r in rows)


def test_stages_take_odd_documents(spark, edge):
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        for d in (docs, docs.where("false")):
            out = stage(spark, d, SF)
            n = out.count()
            assert n <= d.count() and (n or not d.count())


def test_planted_cases(spark, tmp_path):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first().text
    text = " ".join(f"clean{i}" for i in range(80))
    rows = [(1, text + " one"), (2, text + " one"), (3, "Other words " + benchmark + " and an end"), (4, "quite different"),
            (5, text.replace("clean7 ", "clean7 clean7 "))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in stages["SimHash near-dedup"](spark, docs, SF).collect()}
    assert 1 in kept and 2 not in kept and 4 in kept
    assert {r.doc_id for r in stages["benchmark decontamination"](spark, docs, SF).collect()} == {1, 2, 4, 5}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    if name == "op9_decontamination":
        sf = SF
    want = duck_over(sf, queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    as_rows = lambda p: sorted(map(str, p[cols].itertuples(index=False, name=None)))
    assert as_rows(got.toPandas()) == as_rows(want)


def duck_over(sf, sql):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con.execute(sql).df()
