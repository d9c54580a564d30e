import hashlib
from pathlib import Path

import pytest
from test_dedup import brute_near, brute_words

import corpus_pipeline
from tesserae.llm import queries as q
from tesserae.llm.runtime import shared_folder

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in q.queries()) == list(range(1, 13))
    assert set(q.oracle_sql()) <= set(q.queries())


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = q.queries()[name](spark, SF)
    said = c.execute(q.oracle_sql()[name])
    assert df.columns == [d[0] for d in said.description]
    assert sorted(map(tuple, df.collect())) == sorted(said.fetchall())


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        old, new = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        assert set(new) <= set(old), name
        if k < 4:
            assert after.columns == columns
        if "MinHash" in name:
            assert set(new) == {d for d, x in brute_near([(d, r.text) for d, r in old.items()]).items() if x[3]}
        elif "substring" in name:
            want = brute_words([(d, r.text) for d, r in old.items()])
            assert set(new) == set(old)
            for d, r in new.items():
                assert hashlib.sha256(" ".join(r.text.split(" ") if want[d][2] else old[d].text.split()).encode()).hexdigest() == want[d][3]
                assert r.n_chars == len(r.text)
        elif "benchmark" in name:
            leaked = {d for d, r in old.items() if any(b in r.text for b in bench)}
            assert set(old) - set(new) >= leaked
        elif "BPE" in name:
            assert {d: r.decoded_sha256 for d, r in new.items()} == {d: hashlib.sha256(r.text.encode()).hexdigest() for d, r in old.items()}
        before = after
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, before.collect()))
    assert shared_folder(spark)
