import json

import pytest

from winnow.__main__ import main
from winnow.sources import readers


def answers(asked):
    return ['{"content_type": "procedure", "confidence": 0.9}' for _ in asked]


def test_stages(spark, tmp_path, capsys):
    src = tmp_path / "src" / "21 - Clutch"
    src.mkdir(parents=True)
    for n in ("21-01.jpg", "21-00-index-a.jpg"):
        (src / n).write_bytes(b"1")
    (tmp_path / "src" / "M3-techspec.html").write_text("<table><tr><th>a</th><th>b</th></tr><tr><td>Weight of the car</td><td>1200 kg dry</td></tr></table>")
    at = lambda n: str(tmp_path / n)
    assert main(["inventory", "--input", at("src"), "--output", at("inv")]) == 0
    assert main(["classify", "--input", at("inv"), "--output", at("pages"), "--report", at("r.md"), "--provider", "tests.test_cli:answers"]) == 0
    assert {r["page_id"]: r["content_type"] for r in readers.read_classified(spark, at("pages")).collect()} == {"21-01_clutch": "procedure", "21-00-index-a_clutch": "index"}
    assert main(["classify", "--input", at("inv"), "--output", at("pages"), "--report", at("r.md")]) == 0
    assert readers.read_classified(spark, at("pages") + ".new").count() == 2
    assert main(["specs", "--input", at("src"), "--output", at("specs"), "--vehicle", "Test Car"]) == 0
    assert (tmp_path / "specs" / "html-m3-techspec.json").exists()
    with pytest.raises(SystemExit, match="--vehicle"):
        main(["specs", "--input", at("src"), "--output", at("specs")])
    qa = tmp_path / "qa"
    qa.mkdir()
    pairs = [{"id": f"p-q0{i}", "question": q, "answer": a, "question_type": "factual"} for i, (q, a) in enumerate([("What is the weight of it?", "It is 1200 kg."), ("what is the weight of it", "It is 1200 kg, dry."), ("How long is the engine bay?", "It is one metre.")])]
    (qa / "p.json").write_text(json.dumps({"page_id": "p", "section_id": "21", "qa_pairs": pairs}))
    (tmp_path / "c.yaml").write_text("filters: {require_question_mark: false, max_question_similarity: 2.0}\n")
    assert main(["filter", "--input", at("qa"), "--output", at("filtered"), "--config", at("c.yaml"), "--log", at("log"), "--report", at("f.md")]) == 0
    (tmp_path / "filtered" / "broken.json").write_text("{")
    assert main(["dedup", "--input", at("filtered"), "--output", at("twice"), "--report", at("d.md")]) == 0
    assert "broken.json" in capsys.readouterr().err and len(json.loads((tmp_path / "twice" / "p.json").read_text())["qa_pairs"]) == 2
    assert main(["dedup", "--input", at("qa"), "--output", at("deduped"), "--log", at("dlog"), "--report", at("d.md")]) == 0
    assert readers.read_csv(spark, at("dlog"), "group_id string, page_id string, qa_id string, question string, answer string, similarity_score string, action string, kept_qa_id string").count() == 2
    assert main(["emit", "--input", at("qa"), "--output", at("data"), "--train-split", "0.7", "--report", at("e.md")]) == 0
    assert main(["validate", "--input", at("data"), "--report", at("v.md")]) == 0
    assert "Validation" in (tmp_path / "v.md").read_text()
    assert main(["validate", "--input", at("data"), "--report", at("v.md"), "--strict"]) == 0
    assert main(["emit", "--input", at("qa"), "--output", at("dry"), "--dry-run", "--report", at("e.md")]) == 0 and not (tmp_path / "dry").exists()
    with pytest.raises(FileNotFoundError):
        main(["validate", "--input", at("nothing")])


def test_validated_lines(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"post_id": "1", "author": ""}\n{"author": "a"}\n')
    got = readers.read_validated(spark, str(tmp_path / "p.jsonl"), "post_id string, author string", ["post_id", "author"]).collect()
    assert [(len(r["errors"]), len(r["warnings"])) for r in got] == [(0, 1), (1, 0)]
    assert readers.read_validated(spark, str(tmp_path / "no"), "post_id string", ["post_id"]).count() == 0


def rasterise(content):
    return content.split(b"-")


def listed(asked):
    return ['{"section_id": "21", "section_name": "Clutch", "procedures": [{"code": "2100", "name": "Remove", "page": "21-1"}]}' for _ in asked]


def written(asked):
    return ['[{"question": "What does page one of it show?", "answer": "It shows the clutch.", "question_type": "visual"}]' if a["page_id"].startswith("21-01") else None for a in asked]


def test_stages_from_files_to_pairs(spark, tmp_path, capsys):
    png = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR\0\0\0\x80\0\0\0\x80" + bytes(40)
    src = tmp_path / "src" / "21 - Clutch"
    src.mkdir(parents=True)
    for name, content in (("21-01.png", png), ("21-02.png", b""), ("21-00-index-a.png", png), ("m.pdf", b"one-two")):
        (src / name).write_bytes(content)
    at = lambda n: str(tmp_path / n)
    assert main(["inventory", "--input", at("src"), "--output", at("inv")]) == 0
    assert main(["prepare", "--input", at("inv"), "--root", at("src"), "--output", at("prepared"), "--log", at("plog"), "--report", at("p.md"), "--provider", "tests.test_cli:rasterise"]) == 0
    assert (src / "m" / "002.jpg").read_bytes() == b"two"
    made = {r["file_path"]: r["original_source"] for r in readers.read_csv(spark, at("prepared"), readers.PREPARED).collect()}
    assert made == {"21 - Clutch/21-01.png": None, "21 - Clutch/21-00-index-a.png": None, "21 - Clutch/m/001.jpg": "21 - Clutch/m.pdf", "21 - Clutch/m/002.jpg": "21 - Clutch/m.pdf"}
    assert "failure" in (tmp_path / "p.md").read_text()
    assert main(["indices", "--input", at("prepared"), "--output", at("indices"), "--report", at("i.md"), "--provider", "tests.test_cli:listed"]) == 0
    assert json.loads((tmp_path / "indices" / "21-clutch.json").read_text())["procedures"] == [{"code": "2100", "name": "Remove", "pages": ["21-1"]}]
    assert main(["classify", "--input", at("prepared"), "--output", at("pages"), "--report", at("r.md"), "--provider", "tests.test_cli:answers"]) == 0
    assert main(["generate", "--input", at("pages"), "--output", at("qa"), "--indices", at("indices"), "--report", at("g.md"), "--log", at("glog"), "--dry-run"]) == 0
    assert not (tmp_path / "qa").exists() and "pages to ask" in (tmp_path / "g.md").read_text()
    assert main(["generate", "--input", at("pages"), "--output", at("qa"), "--indices", at("indices"), "--report", at("g.md"), "--log", at("glog"), "--provider", "tests.test_cli:written"]) == 0
    assert sorted(p.name for p in (tmp_path / "qa").glob("*.json")) == ["21-01_clutch.json"]
    assert main(["generate", "--input", at("pages"), "--output", at("qa"), "--report", at("g.md"), "--provider", "tests.test_cli:written"]) == 0
    assert "already exists" in (tmp_path / "g.md").read_text()
    assert main(["emit", "--input", at("qa"), "--output", at("data"), "--root", at("src"), "--copy-images", "--report", at("e.md")]) == 0
    assert (tmp_path / "data" / "images" / "21_-_Clutch_21-01.png").read_bytes() == png
    assert main(["validate", "--input", at("data"), "--report", at("v.md")]) == 0
    (tmp_path / "data" / "images" / "21_-_Clutch_21-01.png").write_bytes(b"junk")
    assert main(["validate", "--input", at("data"), "--report", at("v.md")]) == 1 and "not readable" in (tmp_path / "v.md").read_text()
    assert main(["validate", "--input", at("data"), "--report", at("v.md"), "--skip-image-check"]) == 0
    assert main(["upload", "--input", at("data"), "--output", at("map")]) == 0 and "images/21_-_Clutch_21-01.png" in capsys.readouterr().out


def test_crawl_and_spot_check(spark, tmp_path, capsys):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "in").mkdir()
    page = {"url": "https://x.org/t/9", "thread_id": "9", "html": "<div class='b-post' data-post-id='1'><p class='post-content'>hi</p></div><div class='b-post' data-post-id='2'></div>"}
    (tmp_path / "in" / "a.json").write_text(json.dumps(page) + "\n" + json.dumps(page) + "\n")
    for _ in range(2):
        assert main(["crawl", "--input", at("in"), "--output", at("posts"), "--what", "posts", "--base-url", "https://x.org"]) == 0
    assert sorted(r["post_id"] for r in spark.read.parquet(at("posts")).collect()) == ["1", "2"]
    with pytest.raises(SystemExit, match="--base-url"):
        main(["crawl", "--input", at("in"), "--output", at("posts")])
    (tmp_path / "labelled.csv").write_text("filename,section_dir,expected\na.jpg,s,procedure\nb.jpg,s,text\n")
    assert main(["spot-check", "--input", at("labelled.csv"), "--report", at("s.md"), "--provider", "tests.test_cli:answers"]) == 0
    assert "| 2 | 1 | 0.50 |" in (tmp_path / "s.md").read_text()

