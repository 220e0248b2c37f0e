"""Task-file readers and repairs (FIXTURES 5, D8, D9, S4, S12-S14, P7, P8, J10)."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import tables as TB
from tessera.session import scratch_path
from tessera.sources import files

PAIR = "label int, idx1 bigint, idx2 bigint, sentence1 string, sentence2 string"


def _write(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_glued_pair_read_and_repair(spark):
    path = _write(spark, ['1\t5\t6\t"a b\tc d"', "0\t7\t8\tno tab here"], "glued")
    glued = files.read_tsv(spark, path, PAIR, quoting=True).orderBy("idx1").collect()
    assert glued[0].sentence1 == "a b\tc d" and glued[0].sentence2 is None
    rep = TB.repair_pair(files.read_tsv(spark, path, PAIR, quoting=True)).orderBy("idx1").collect()
    assert (rep[0].sentence1, rep[0].sentence2, rep[0].ok) == ("a b", "c d", True)
    assert (rep[1].sentence1, rep[1].sentence2, rep[1].ok) == ("no tab here", None, False)
    plain = files.read_tsv(spark, path, PAIR).orderBy("idx1").first()
    assert (plain.sentence1, plain.sentence2) == ('"a b', 'c d"')


def test_nli_repair_and_unknown_label(spark):
    path = _write(spark, ["premise\thypothesis\tlabel", '"p one\th one"\tneutral',
                          '"p two\th two"\tother'], "nli")
    read = files.read_tsv(spark, path, "premise string, hypothesis string, label string",
                          header=True, quoting=True)
    out = TB.repair_nli(read).orderBy("premise").collect()
    assert [(r.premise, r.hypothesis, r.label) for r in out] == [("p one", "h one", 1), ("p two", "h two", None)]
    cast = TB.cast_features(TB.repair_nli(read), {"label": "int"}, names=["e", "n", "c"])
    assert cast.where(~F.col("in_domain")).count() == 1


def test_registry_and_text_columns(spark):
    assert TB.task_keys("PAWSX") == ("sentence1", "sentence2")
    with pytest.raises(ValueError):
        TB.task_keys("wsd")
    assert TB.resolve_text_columns(["label", "sentence1", "x", "sentence2"]) == ("sentence1", "sentence2")
    assert TB.resolve_text_columns(["a", "label", "b", "c"]) == ("a", "b")
    assert TB.resolve_text_columns(["label", "only"]) == ("only", None)
    codes = spark.createDataFrame([("CLS-Books",), ("WSD-Verbs",)], "code string")
    got = {r.task: (r.metric, r.known) for r in TB.with_task(codes, "code").collect()}
    assert got == {"cls": ("sst2", True), "wsd": (None, False)}


def test_label_domain_and_alignment(spark):
    d = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "label string")
    dom = TB.label_domain(d)
    assert [(r.label, r.id) for r in dom.orderBy("id").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    model = spark.createDataFrame([("C", 0), ("A", 1), ("B", 2)], "name string, id int")
    al = {r.label: (r.label_id, r.aligned) for r in TB.align_labels(model, dom).collect()}
    assert al == {"a": (1, True), "b": (2, True), "c": (0, True)}
    other = spark.createDataFrame([("X", 0), ("A", 1)], "name string, id int")
    al2 = {r.label: (r.label_id, r.aligned) for r in TB.align_labels(other, dom).collect()}
    assert al2 == {"a": (0, False), "b": (1, False), "c": (2, False)}


def test_read_table_by_extension(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    p = scratch_path(spark, "t") + ".json"
    df.write.json(p)
    assert files.read_table(spark, p).select("a", "b").collect()[0].b == "x"
    with pytest.raises(ValueError):
        files.read_table(spark, "/x/y.parquet")


def test_materialize_reuses(spark):
    p = scratch_path(spark, "mat")
    a = files.materialize(spark.range(3), p)
    b = files.materialize(spark.range(5), p)            # not overwritten
    assert a.count() == 3 and b.count() == 3
    c = files.materialize(spark.range(5), p, overwrite=True)
    assert c.count() == 5


def test_jsonl_keeps_nulls(spark):
    p = scratch_path(spark, "jl")
    df = spark.createDataFrame([("r", None, "t", "train")], "ref string, date int, title string, split string")
    files.write_jsonl(df, p)
    text = spark.read.text(p).first().value
    assert '"date":null' in text


def test_read_payload_files(spark, tmp_dir):
    import os
    from tessera.operators.html import parse_article
    d = os.path.join(tmp_dir, "payloads")
    os.makedirs(d)
    with open(os.path.join(d, "Aé_1.xml"), "w", encoding="utf-8") as f:
        f.write("<api><extract>&lt;p&gt;un\ndeux&lt;/p&gt;</extract></api>")
    with open(os.path.join(d, "B.xml"), "w", encoding="utf-8") as f:
        f.write("<api/>")
    df = files.read_payload_files(spark, d)
    got = {r.ref: (r.content, r.ok) for r in parse_article(df, "ref", "payload", tag="extract").collect()}
    assert got == {"Aé_1": (["un\ndeux"], True), "B": (None, False)}


def _landed(spark, path, key="k"):
    from tessera.sources.files import payload_name, read_payload_files
    got = read_payload_files(spark, path, name=payload_name(key), nested=True)
    return sorted((r.ref, r.payload) for r in got.select(F.url_decode("ref").alias("ref"), "payload").collect())


def test_payload_files_land_side_by_side(spark, tmp_dir):
    import os
    path = os.path.join(tmp_dir, "payloads")
    rows = [(str(i), f"p{i}\n") for i in range(300)] + [("é/1 +%*", "x\r\ny"), ("_a=.txt", ""), ("b", None), ("c", "1"), ("c", "1")]
    df = spark.createDataFrame([*rows, (None, "n"), ("", "n")], "k string, v string")
    files.write_payload_files(df, "k", "v", path)
    found = [(d, n) for d, _, names in os.walk(path) for n in names]
    assert len(found) == 305 and len({d for d, _ in found}) <= files._payload_blocks(spark) and not any(n[0] == "." for _, n in found)
    with open(os.path.join(found[0][0], ".99"), "w") as f:
        f.write("of a task that did not end")
    want = [(k, f"{v or ''}\n") for k, v in rows[:-2]] + [("c", "1\n1\n"), (files.NO_KEY, "n\nn\n")]
    assert _landed(spark, path) == sorted(want)
    assert files.read_payload_files(spark, path, nested=True).rdd.getNumPartitions() <= files._payload_blocks(spark)


def test_payload_files_of_no_rows(spark, tmp_dir):
    path = files.write_payload_files(spark.createDataFrame([], "k string, v string"), "k", "v", f"{tmp_dir}/none")
    assert _landed(spark, path) == []


def test_payload_files_in_another_store(spark, tmp_dir):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.tsr.link./at", f"file://{tmp_dir}")
    df = spark.createDataFrame([("é/1", "x\n"), ("2%", ""), ("c", "1"), ("c", "1"), (None, "n")], "k string, v string")
    path = files.write_payload_files(df, "k", "v", "viewfs://tsr/at/payloads")
    assert _landed(spark, path) == sorted([("é/1", "x\n\n"), ("2%", "\n"), ("c", "1\n1\n"), (files.NO_KEY, "n\n")])


def test_payload_files_query_makes_no_folder_a_page(spark, tmp_dir):
    import os
    from tessera.plans import catalog
    from tessera.session import ensure_checkpoint_dir
    pages = [(i, f"u{i}", f"<p>{i}</p>\n" * (i % 3)) for i in range(-5, 200)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_dir}/pages.parquet")
    got = catalog.queries()["payload_files"](spark, tmp_dir)
    assert sorted((r.ref, r.payload) for r in got.collect()) == sorted((str(i), h) for i, _, h in pages)
    top = ensure_checkpoint_dir(spark).removeprefix("file:") + f"/tessera-scratch/{spark.sparkContext.applicationId}"
    last = max((os.path.join(top, x) for x in os.listdir(top) if x.startswith("payloads-")), key=os.path.getmtime)
    landed = [d for d, _, names in os.walk(last) for n in names if n[0] not in "._"]
    assert len(landed) == 205 and len(set(landed)) <= files._payload_blocks(spark)
