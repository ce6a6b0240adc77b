import json

from winnow.streaming import ingest

SCHEMA = "post_id string, text string"


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def run(spark, tmp_path, checkpoint="ck"):
    q = ingest.append_new(ingest.new_files(spark, str(tmp_path / "in"), SCHEMA, 1), "post_id", str(tmp_path / "out"), str(tmp_path / checkpoint))
    q.awaitTermination()
    return sorted((r["post_id"], r["text"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())


def test_restart_adds_nothing_twice(spark, tmp_path):
    put(tmp_path / "in", "a.json", [{"post_id": "1", "text": "x"}, {"post_id": "2", "text": "y"}, {"post_id": "1", "text": "z"}])
    first = run(spark, tmp_path)
    assert [i for i, _ in first] == ["1", "2"] and first[0][1] in "xz"
    put(tmp_path / "in", "b.json", [{"post_id": "2", "text": "new"}, {"post_id": "3", "text": "w"}])
    assert run(spark, tmp_path) == [*first, ("3", "w")]
    assert run(spark, tmp_path, "lost checkpoint") == [*first, ("3", "w")]


def test_progress(spark, tmp_path):
    path = str(tmp_path / "progress")
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "item_id string")
    assert ingest.remaining(items, ingest.read_progress(spark, path, "s")).count() == 3
    ingest.record_progress(items.filter("item_id = 'a'"), "s", path)
    ingest.record_progress(items.filter("item_id = 'b'"), "s", path, "failed")
    assert {r["item_id"] for r in ingest.remaining(items, ingest.read_progress(spark, path, "s")).collect()} == {"b", "c"}
    r = ingest.progress_summary(spark, path).first()
    assert (r["completed"], r["failed"]) == (1, 1)


def test_distinct_stream(spark, tmp_path):
    put(tmp_path / "in", "a.json", [{"post_id": "1", "text": "x"}, {"post_id": "1", "text": "y"}])
    q = ingest.distinct_stream(ingest.new_files(spark, str(tmp_path / "in"), SCHEMA), "post_id").writeStream.format("memory").queryName("seen_posts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("seen_posts").count() == 1
