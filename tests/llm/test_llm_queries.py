"""The registered training-data queries and the pipeline, on the smallest data set."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from railstream.llm import ngram_join, packing, quality, secrets, toxicity
from railstream.llm.queries import CHECKS, QUERIES
from railstream.llm.store import stored, table

COLUMNS = {
    "op1": ["doc_id", "n_shingles", "component_id"],
    "op2": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op3": ["conv_id", "perspective", "part", "n_turns", "rendered", "mask"],
    "op4": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5": ["query_id", "rank", "vec_id", "score"],
    "op6": ["doc_id", "held_out", "score", "predicted"],
    "op7": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept"],
    "op8": ["doc_id", "n_words", "n_tokens"],
    "op9": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op11": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
             "collapsed_sha256"],
    "op12": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op13": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op10": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}


def test_all_operators_and_the_pipeline_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)
    assert set(CHECKS) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tiny, name):
    wanted = COLUMNS[name.split("_")[0]]
    got = QUERIES[name](spark, tiny)
    assert got.columns[:len(wanted)] == wanted
    rows = got.toPandas()
    if "doc_id" in wanted:
        assert set(rows.doc_id) == {r.doc_id for r in table(spark, tiny, "documents").collect()}
    if name in CHECKS:
        with duckdb.connect() as db:
            for source in ("conversations", "documents"):
                db.execute(f"CREATE VIEW {source} AS SELECT * FROM '{tiny}/{source}.parquet'")
            theirs = db.execute(CHECKS[name]).df()[got.columns]
        order = list(wanted)[:3]
        ours = rows.sort_values(order).reset_index(drop=True)
        theirs = theirs.sort_values(order).reset_index(drop=True)
        assert ours.equals(theirs.astype(ours.dtypes.to_dict()))


def test_queries_that_sql_can_express_have_it():
    assert {n.split("_")[0] for n in CHECKS} == {"op1", "op3", "op11", "op13"}


def test_stages_take_effect(spark, tiny):
    docs = table(spark, tiny, "documents")
    names = docs.columns
    seen = [docs]
    for label, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stored(stage(spark, seen[-1], tiny), label.replace(" ", "-")))
        assert seen[-1].columns == names
    source, calm, sound, single, masked = seen
    model = toxicity.train(source, table(spark, tiny, "labels"))
    scores = {r.doc_id: r.score for r in
              toxicity.score(source, model).select("row.doc_id", "score").collect()}
    ids = [{r.doc_id for r in part.select("doc_id").collect()} for part in seen]
    assert ids[1] == {i for i in ids[0] if scores[i] < 0.5}
    kept = quality.judged(calm).select("row.doc_id", "kept").collect()
    assert ids[2] == {r.doc_id for r in kept if r.kept}
    groups = ngram_join.grouped_documents(sound, 5, 80).collect()
    assert ids[3] == {r.component_id for r in groups}
    assert ids[4] == ids[3]
    texts = {r.doc_id: r.text for r in single.collect()}
    for row in masked.collect():
        assert row.text == secrets.masked(texts[row.doc_id], secrets.scan(texts[row.doc_id])[1])
    final = corpus_pipeline.run(spark, tiny)
    assert final.agg(F.sum("length")).first()[0] == packing.pack(masked).agg(F.sum("length")).first()[0]
    assert {r.doc_id for r in final.select("doc_id").collect()} == ids[4]
