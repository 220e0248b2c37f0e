"""Bucketed tables, streams with state by key, and models as files."""

import uuid

import pytest

from tessera.operators import corpus as C
from tessera.operators import ngram, scoring
from tessera.session import scratch_path
from tessera.sources import files
from tessera.streaming import keyed


def test_attach_of_bucketed_tables_has_no_exchange(spark):
    listing = spark.createDataFrame([(i, f"r{i % 40}", f"t{i}") for i in range(400)], "page_id long, ref string, title string")
    got = spark.createDataFrame([(f"r{i % 50}", i, [f"c{i}"], i % 3 > 0) for i in range(120)], "ref string, page_id long, content array<string>, ok boolean")
    want = sorted((r.page_id, r.ref, r.content) for r in C.attach_content(listing, got.withColumnRenamed("page_id", "seq"), order="seq").collect())
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = files.materialize_bucketed(listing, names[0], ["ref"], 5)
        b = files.materialize_bucketed(got.withColumnRenamed("page_id", "seq"), names[1], ["ref"], 5)
        out = C.attach_content(a, b, order="seq")
        rows = sorted((r.page_id, r.ref, r.content) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert rows == want and "SortMergeJoin" in plan and "Exchange" not in plan
        again = files.materialize_bucketed(listing.limit(0), names[0], ["ref"], 5)
        assert again.count() == 400  # a finished table is reused
        assert files.materialize_bucketed(listing.limit(3), names[0], ["ref"], 5, overwrite=True).count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


SCHEMA = "ref string, seq int, body string"


@pytest.mark.parametrize("pick", [keyed.latest, keyed.earliest])
def test_restart_from_a_checkpoint_equals_batch(spark, pick):
    """Events land out of order and twice, the query stops and starts again: the table is the batch's."""
    landed, table, ckpt = (scratch_path(spark, n) for n in ("events", "keyed", "ckpt"))
    parts = [[("a", 2, "a2"), ("b", 1, "b1")], [("a", 1, "a1"), ("c", 5, "c5")], [("a", 2, "a2"), ("c", 7, "c7"), ("b", 0, "b0")], [("d", 1, None)]]

    def run():
        events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{landed}/*")
        keyed.finish(keyed.write_keyed(pick(events, "ref", ["seq"]), table, ckpt))
        return sorted((r.ref, r.seq, r.body) for r in keyed.read_keyed(spark, table, "ref", SCHEMA).collect())

    def batch():
        return sorted((r.ref, r.seq, r.body) for r in pick(spark.read.schema(SCHEMA).parquet(f"{landed}/*"), "ref", ["seq"]).collect())

    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{landed}/n={i}")
        if i in (1, 3):
            assert run() == batch()
    assert run() == batch()  # nothing new: nothing doubled


def test_replayed_epoch_is_overwritten(spark):
    table = scratch_path(spark, "keyed")
    df = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    for _ in range(2):
        df.write.mode("overwrite").parquet(f"{table}/epoch=0")
    spark.createDataFrame([("a", 2, "y")], SCHEMA).write.parquet(f"{table}/epoch=1")
    assert [(r.ref, r.body) for r in keyed.read_keyed(spark, table, "ref", SCHEMA).collect()] == [("a", "y")]


def test_scores_by_file_and_by_join(spark):
    train = spark.createDataFrame([(["a", "b", "a", "c"],), (["b", "a"],)], "tokens array<string>")
    model = ngram.fit_bigram(train)
    texts = spark.createDataFrame([(1, [None, "a", "b"]), (2, ["a", "b", "z", "a", "b"]), (3, [None]), (4, [])], "id long, tokens array<string>")
    got = [{r.key: (round(r.nll_sum, 9), r.n_tokens) for r in scoring.score_bigrams(texts, "id", "tokens", model, max_rows=n).collect()}
           for n in (1000, 0)]
    assert got[0] == got[1] and got[0]["3"] == got[0]["4"] == (0.0, 0)
    pairs = spark.createDataFrame([("a", "b")], "ctx string, tok string")
    assert got[0]["1"] == (round(ngram.bigram_nll(pairs, model).first().nll, 9), 1) and got[0]["2"][1] == 4
    assert scoring.ship_model(model, max_rows=2) is None
    assert scoring.score_bigrams(texts.limit(0), "id", "tokens", model).count() == 0


def test_payload_names_are_decoded(spark):
    path = scratch_path(spark, "payloads")
    spark.createDataFrame([("é/1", "x"), ("100%", "y")], "ref string, text string").repartition("ref").write.partitionBy("ref").text(path)
    got = files.read_payload_files(spark, path, name="ref=([^/]+)/[^/]*$")
    assert sorted(r.payload.strip() for r in got.collect()) == ["x", "y"] and got.where("ref is null").isEmpty()
