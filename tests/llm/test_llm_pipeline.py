import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ratewatch.llm import packing, quality
from test_llm_simhash import plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stage(spark, found[-1], sf).persist())
    return found


def test_documents_keep_their_columns(stages):
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns


def test_each_stage_on_its_own_input(stages):
    docs, good, lines, unique, mixed, packed = (x.toPandas() for x in stages)
    counts = quality.count_frame(docs["text"])
    assert set(good["doc_id"]) <= set(docs["doc_id"][~quality.base_failed(counts)])
    assert len(good) > 0.75 * len(docs)
    assert sorted(lines["doc_id"]) == sorted(good["doc_id"])
    before = good.set_index("doc_id")["text"]
    seen = set()
    for number, text in sorted(zip(lines["doc_id"], lines["text"], strict=True)):
        kept = [x for x in text.split("\n") if x.split()]
        assert not seen.intersection(kept) and set(kept) <= set(before[number].split("\n"))
        seen.update(kept)
    prints = {n: plain_fingerprint(t) for n, t in zip(lines["doc_id"], lines["text"], strict=True)}
    groups = {n: n for n in prints}

    def top(n):
        while groups[n] != n:
            n = groups[n]
        return n

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                one, two = sorted((top(a), top(b)))
                groups[two] = one
    assert sorted(unique["doc_id"]) == sorted({top(n) for n in prints})
    assert set(mixed["doc_id"]) <= set(unique["doc_id"]) and mixed["doc_id"].value_counts().max() <= 2
    words = sum(len(t.split()) + 1 for t in mixed["text"])
    assert packed["length"].sum() == words and set(packed["capacity"]) <= set(packing.CAPACITIES)


def test_run_gives_the_rows_of_the_stages(spark, sf, stages):
    got = corpus_pipeline.run(spark, sf).toPandas()
    last = stages[-1].toPandas()
    columns = ["doc_id", "start", "length"]
    assert sorted(map(tuple, got[columns].values)) == sorted(map(tuple, last[columns].values))


def test_sql_of_the_vectors(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    wanted = db.execute(oracle_sql()["op1_kdtree_top_k"]).fetchall()
    assert sorted(map(tuple, queries()["op1_kdtree_top_k"](spark, sf).collect())) == sorted(wanted)


def test_eleven_queries():
    names = queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
