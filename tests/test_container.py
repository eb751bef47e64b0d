"""Containers of many documents: whole round trips, commits, damage."""
import json
import os

import pytest
from docrank.session import scratch_path
from docrank.sources.container import MANIFEST, read_container, read_per_doc_container, write_container, write_per_doc_container
from pyspark.sql import functions as F

DOCS = [(f"d{i}", f"fig ünï\n{'date ' * (i % 9)}text \x00 number {i}") for i in range(300)] + [
    ("empty", ""), ("none", None), (None, "no id"), ("d1", "a second text of an id"), ("long", "x" * 300_000), ("", "id of no letters")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, text string")


def local(path):
    return path.removeprefix("file:")


def containers(path):
    return sorted(f for f in os.listdir(local(path)) if f.endswith(".docs"))


def plain(df):
    return sorted(((r.doc_id is None, r.doc_id or "", r.text) for r in df.collect()))


WANT = sorted((i is None, i or "", t or "") for i, t in DOCS)


def test_every_document_comes_back_from_few_files(spark):
    path = scratch_path(spark, "container")
    write_container(frame(spark, DOCS).repartition(4), path)
    assert len(containers(path)) <= 4
    got = read_container(spark, path)
    assert got.dtypes == [("doc_id", "string"), ("text", "string")] and plain(got) == WANT


def test_containers_and_partitions_are_bounded(spark):
    path = scratch_path(spark, "container")
    write_container(frame(spark, DOCS).coalesce(1), path, container_docs="100")
    files = json.load(open(f"{local(path)}/{MANIFEST}"))["files"]
    assert sorted(n for _, n, _ in files) == [6, 100, 100, 100]
    wide = read_container(spark, path, partition_bytes="1000")
    assert wide.rdd.getNumPartitions() > 12 and plain(wide) == WANT
    write_container(frame(spark, DOCS).coalesce(1), path, container_bytes="2000")
    assert len(json.load(open(f"{local(path)}/{MANIFEST}"))["files"]) > 5 and plain(read_container(spark, path)) == WANT


def test_append_overwrite_and_empty(spark):
    path = scratch_path(spark, "container")
    write_container(frame(spark, DOCS[:3]).coalesce(1), path)
    write_container(frame(spark, DOCS[3:5]).coalesce(1), path, mode="append")
    assert read_container(spark, path).count() == 5 and len(containers(path)) == 2
    first = containers(path)
    write_container(frame(spark, DOCS[:1]).coalesce(1), path)
    # files of the manifest before stay for readers that are open, then go
    assert read_container(spark, path).count() == 1 and set(first) < set(containers(path))
    write_container(frame(spark, DOCS[:0]), path)
    assert read_container(spark, path).count() == 0 and not set(first) & set(containers(path))


def test_a_failed_write_changes_nothing(spark):
    path = scratch_path(spark, "container")
    write_container(frame(spark, DOCS[:10]).coalesce(2), path)
    before, kept = plain(read_container(spark, path)), containers(path)
    bad = frame(spark, DOCS).repartition(4).withColumn("text", F.when(F.col("doc_id") == "d77", F.raise_error(F.lit("stop"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="stop"):
        write_container(bad, path)
    assert plain(read_container(spark, path)) == before and set(kept) <= set(containers(path))


def test_damage_is_found(spark):
    path = scratch_path(spark, "container")
    write_container(frame(spark, DOCS[:5]).coalesce(1), path)
    name = f"{local(path)}/{containers(path)[0]}"
    raw = bytearray(open(name, "rb").read())
    raw[3] ^= 1
    open(name, "wb").write(raw)
    with pytest.raises(Exception, match="damaged"):
        read_container(spark, path).collect()
    open(name, "wb").write(b"short")
    with pytest.raises(Exception, match="damaged"):
        read_container(spark, path).collect()


def test_per_document_outputs(spark):
    rows = spark.createDataFrame([("a", "fig", 2), ("a", "", 1), ("b", "date", 7)], "doc_id string, word string, frequency long")
    path = scratch_path(spark, "container")
    write_per_doc_container(rows, path, "frequency")
    got = read_per_doc_container(spark, path, "frequency")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
