"""Raw payload ingest, result persistence, JSON/CSV sinks, catalog lookups."""
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from regloom.sources import catalog as S
from regloom.sources import raw, sinks


def test_binary_payloads_and_sizes(spark, scratch):
    root = os.path.join(scratch, "raw")
    payloads = {"cms_ncci_edits": [b"zip-one", b"zip-two!"], "samhsa_tip_63": [b"%PDF-1.7 text"]}
    for key, blobs in payloads.items():
        os.makedirs(os.path.join(root, key))
        for b in blobs:
            d = hashlib.sha256(b).hexdigest()
            open(os.path.join(root, key, d[:12] + ".bin"), "wb").write(b)
    got = {(r.source_key, r.content_sha256) for r in raw.read_payloads(spark, root).collect()}
    assert got == {(k, hashlib.sha256(b).hexdigest()) for k, bs in payloads.items() for b in bs}
    names = {r.raw_name for r in raw.read_payloads(spark, root).collect()}
    assert all(len(n) == 16 and n.endswith(".bin") for n in names)
    sizes = {r.source_key: (r.raw_bytes, r.raw_files) for r in raw.raw_bytes_per_source(spark, root).collect()}
    assert sizes == {"cms_ncci_edits": (15, 2), "samhsa_tip_63": (13, 1)}


def test_payloads_in_document_folders_belong_to_their_source(spark, scratch):
    root = os.path.join(scratch, "raw")
    for place in ("src/a.bin", "src/doc%20one/b.bin", "other/x/y/c.bin"):
        os.makedirs(os.path.dirname(os.path.join(root, place)), exist_ok=True)
        with open(os.path.join(root, place), "wb") as f:
            f.write(place.encode())
    sizes = {r.source_key: (r.raw_bytes, r.raw_files) for r in raw.raw_bytes_per_source(spark, root).collect()}
    assert sizes == {"src": (9 + 19, 2), "other": (15, 1)}


def test_csv_values_come_back(spark, scratch):
    import csv

    rows = [("plain", 1), ('says "no", twice', 2), ("back\\slash \\\"", None), ("", 3), (None, 4), ("é,;\t'", 5)]
    path = sinks.write_csv(spark.createDataFrame(rows, "note string, n int").coalesce(1), os.path.join(scratch, "csv"))
    with open(os.path.join(path, next(f for f in os.listdir(path) if f.endswith(".csv"))), encoding="utf-8", newline="") as f:
        assert list(csv.reader(f)) == [["note", "n"], *[["" if a is None else a, "" if b is None else str(b)] for a, b in rows]]


def test_results_keep_history_per_run(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "source_key string, v int")
    sinks.write_results(df, scratch, "r1")
    sinks.write_results(df.filter(F.col("source_key") == "a").withColumn("v", F.lit(9)), scratch, "r2")
    got = sorted((r.run_id, r.source_key, r.v) for r in sinks.read_results(spark, scratch).collect())
    assert got == [("r1", "a", 1), ("r1", "b", 2), ("r2", "a", 9)]
    assert sinks.read_results(spark, scratch, "r2").count() == 1


def test_empty_csv_keeps_header(spark, scratch):
    path = os.path.join(scratch, "rules_csv")
    sinks.write_csv(spark.createDataFrame([], "rule_id string, note string"), path)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))
    assert text.startswith("rule_id,note")


def test_read_persisted_skips_matrix_files(spark, scratch):
    sinks.write_json(spark.createDataFrame([("a",)], "source_key string"), os.path.join(scratch, "p", "results"))
    sinks.write_json(spark.createDataFrame([("m",)], "source_key string"), os.path.join(scratch, "p", "engine1_matrix.candidate"))
    got = [r.source_key for r in sinks.read_persisted_json(spark, os.path.join(scratch, "p")).collect()]
    assert got == ["a"]


def test_catalog_selection_and_registry(spark):
    cat = S.catalog_df(spark)
    assert cat.count() == 32 and cat.filter(F.col("engine") == "engine2").count() == 17
    sel = [r.key for r in S.select_sources(cat, ["samhsa_tip_63", "nope", "cms_pub_100_04_ch39"]).orderBy("catalog_ord").collect()]
    assert sel == ["cms_pub_100_04_ch39", "samhsa_tip_63"]
    assert S.select_sources(cat, None).count() == 32 and S.select_sources(cat, []).count() == 32
    assert S.registered(cat, spark).count() == 12
    keys = spark.createDataFrame([("samhsa_tip_63",)], "source_key string")
    assert S.by_key(cat, keys).first().engine == "engine2"
    with pytest.raises(Exception):
        S.by_key(cat, spark.createDataFrame([("unknown",)], "source_key string")).collect()


def test_tables_of_a_job_are_in_one_folder_that_can_be_removed(spark):
    from regloom.session import job_folder, remove_written, written

    made = written(spark.range(5), "numbers")
    place = job_folder(spark, "own")
    spark.range(2).write.parquet(place)
    folder = job_folder(spark).removeprefix("file:")
    assert made.count() == 5 and len(os.listdir(folder)) >= 2 and place.startswith(job_folder(spark))
    assert all(f.startswith(("file:" + folder, "file://" + folder)) for f in made.inputFiles())
    remove_written(spark)
    assert not os.path.exists(folder)
    assert written(spark.range(3), "numbers").count() == 3
