"""Archives of payloads: members that fail are rows, in batch and as a stream."""

import json
import zlib

from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import archives
from tessera.streaming.corpus_stream import write_parquet_stream
from tessera.streaming.keyed import finish

PAGES = [("a", "<p>é</p>"), ("b", ""), ("c", "line\nline\ttab \"quoted\"   \U0001f600"), ("d", "x" * 300_000)]


def lines(spark, rows):
    return spark.createDataFrame(rows, "ref string, html string").select(archives.member(F.col("ref"), F.col("html")).alias("value"))


def collected(df):
    return sorted(((r.ref, r.payload, r.ok, r.reason) for r in df.collect()), key=str)


def test_round_trip_and_archive_size(spark):
    path = archives.write_archives(lines(spark, PAGES).coalesce(1), scratch_path(spark, "arch"), per_file=2)
    files = [r.f for r in spark.read.text(path).select(F.input_file_name().alias("f")).distinct().collect()]
    assert len(files) == 2 and all(f.endswith(".gz") for f in files)
    assert collected(archives.read_archives(spark.read, path)) == sorted(((r, p, True, None) for r, p in PAGES), key=str)


def test_failed_members_are_rows(spark):
    crc = zlib.crc32(b"whole")
    bad = ["not json", '{"ref": "cut", "crc": 1, "payl', "", json.dumps({"crc": crc, "payload": "whole"}), json.dumps({"ref": "n", "crc": crc}),
           json.dumps({"ref": "torn", "crc": crc, "payload": "who"}), json.dumps({"ref": "no crc", "payload": "whole"}),
           json.dumps({"ref": "fine", "crc": crc, "payload": "whole", "extra": 1})]
    path = archives.write_archives(spark.createDataFrame([(x,) for x in bad], "line string"), scratch_path(spark, "arch"))
    got = collected(archives.read_archives(spark.read, path))
    reasons = sorted((r[0], r[3]) for r in got if r[0])
    assert reasons == [("fine", None), ("n", "no payload"), ("no crc", "checksum"), ("torn", "checksum")]
    assert sorted(r[3] for r in got if not r[0]) == ["no ref", "not a member", "not a member", "not a member"]
    assert all((r[1] is None) == (not r[2]) for r in got) and len(got) == len(bad)


def test_stream_equals_batch_over_two_landings(spark):
    path, out, ckpt = (scratch_path(spark, n) for n in ("arch", "members", "ckpt"))

    def land(rows, i):
        archives.write_archives(lines(spark, rows), f"{path}/day={i}")

    def run():
        rows = archives.read_archives(spark.readStream, f"{path}/*")
        finish(write_parquet_stream(rows, out, ckpt))
        return spark.read.schema(rows.schema).parquet(out)

    land(PAGES[:2], 1)
    assert len(collected(run())) == 2
    land(PAGES[2:], 2)
    assert collected(run()) == collected(archives.read_archives(spark.read, f"{path}/*"))


def test_no_archives(spark):
    path = archives.write_archives(lines(spark, PAGES).limit(0), scratch_path(spark, "arch"))
    assert archives.read_archives(spark.read, path).count() == 0
