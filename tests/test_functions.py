import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from winnow.functions import jsonx, paths, text, web


def value(spark, expr, **row):
    cols = [F.lit(v).alias(k) if not isinstance(v, (list, dict)) else F.lit(v).alias(k) for k, v in row.items()]
    return spark.range(1).select(*cols).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("filename", "section", "want"),
    [
        ("21-03.jpg", "21 - Clutch", "21-03_clutch"), ("00-01.jpg", "00 - Maintenance", "00-01_maintena"), ("00-01.jpg", "00 - Torque Specs", "00-01_torque-s"), ("001.jpg", "Getrag265", "getrag-001"),
        ("x.jpg", "21 - Clutch", "21-clutch-x"), ("001.jpg", "Bosch Motronic ML 3-1", "bosch-motronic-ml-3-1-001"),
    ],
)
def test_page_id(spark, filename, section, want):
    assert value(spark, paths.page_id("f", "s"), f=filename, s=section) == want


@pytest.mark.parametrize(("section", "want"), [("12 - Engine Electrical Equipment", "12-engine-electrical-equipment"), ("  A & B ", "a-b"), ("", "")])
def test_slug(spark, section, want):
    assert value(spark, paths.section_slug("s"), s=section) == want


@pytest.mark.parametrize(("page", "want"), [("21-01", "21-1"), ("ETM-001", "ETM-1"), ("21-00", "21-0"), ("a-b-c", "a-b-c"), ("x", "x")])
def test_normal_page_id(spark, page, want):
    assert value(spark, paths.normal_page_id("p"), p=page) == want


@pytest.mark.parametrize(("section", "name", "want"), [("21 - Clutch", "a.jpg", "service_manual"), ("Getrag 265", "a.jpg", "service_manual"), ("1990 M3 Electrical Troubleshooting Manual", "a.jpg", "electrical_manual"), ("Bosch Motronic", "a.jpg", "ecu_technical"), ("", "A.HTML", "html_specs"), ("x", "a.jpg", "unknown")])
def test_source_type(spark, section, name, want):
    assert value(spark, paths.source_type("s", "n"), s=section, n=name) == want


def test_paths(spark):
    assert value(spark, paths.file_type("p"), p="a/B.JPEG") == "jpg"
    assert value(spark, paths.file_type("p"), p="a/b.txt") is None
    assert value(spark, paths.is_index_page("p"), p="21-00-Index-a.jpg") is True
    assert value(spark, paths.is_index_page("p"), p="21-01.jpg") is False
    assert value(spark, paths.section_id("p"), p="21 - Clutch") == "21"
    assert value(spark, paths.section_name("p"), p="21 - Clutch") == "Clutch"
    assert value(spark, paths.section_id("p"), p="Getrag 265") == "getrag"
    assert value(spark, paths.derived_slug("a", "b"), a="ETM", b="Electrical Troubleshooting") == "etm-electrical-troubleshooting"
    assert value(spark, paths.numbered_id("p", "n"), p="x", n=3) == "x-q03"
    assert value(spark, paths.numbered_id("p", "n"), p="x", n=123) == "x-q123"
    assert value(spark, paths.model_of("p"), p="M3-techspec.html") == "M3"
    assert value(spark, paths.model_of("p"), p="other.html") == "E30"
    assert value(spark, paths.matches_glob("p", "*-blank-*"), p="21-blank-1") is True
    assert value(spark, paths.matches_glob("p", "blank-?"), p="21-blank-1") is False
    assert value(spark, paths.media_type("p"), p="a.PNG") == "image/png"
    assert value(spark, paths.parent_name("p"), p="a.jpg") == ""
    assert value(spark, paths.parent_name("p", "/r"), p="/r/s/a.jpg") == "s"


def test_text(spark):
    nbsp = " "
    assert value(spark, text.strip("t"), t=f"{nbsp} a b\t{nbsp}\n") == "a b"
    assert value(spark, text.collapse("t"), t=f" a{nbsp}{nbsp}b \n") == "a b"
    assert value(spark, text.match_key("t"), t="  Naïve, TEST?  ") == "nave test"
    assert value(spark, text.match_key("t"), t="日本") == ""
    assert value(spark, text.match_key("t", unicode=True), t="日本!") == "日本"
    assert sorted(value(spark, text.word_set("t"), t="naïve naïve x_1 ²!")) == ["naïve", "x_1", "²"]
    assert value(spark, text.flat_image_name("t"), t="21 - Clutch/21-03.jpg") == "21_-_Clutch_21-03.jpg"
    assert value(spark, text.safe_filename("t"), t="a b/cé-1.x") == "a_b_cé-1_x"
    assert value(spark, text.first_phrase("t", ["b", "A"]), t="xaBx") == "b"
    assert value(spark, text.jaccard(text.word_set("a"), text.word_set("b")), a="", b="x") == 0.0


@pytest.mark.parametrize(("given", "want"), [("1,234", 1234), ("1.2K", 1200), ("3m", 3000000), ("", 0), ("25 replies", 0), ("x", 0), (None, 0)])
def test_count(spark, given, want):
    assert spark.createDataFrame([(given,)], "c string").select(web.parse_count("c")).first()[0] == want


def test_labelled_count(spark):
    assert value(spark, web.parse_count("c", labelled=True), c="25 replies") == 25


@pytest.mark.parametrize(("given", "want"), [("Dec 15, 2023", "2023-12-15T00:00:00"), ("December 15, 2023", "2023-12-15T00:00:00"), ("12-15-2023", "2023-12-15T00:00:00"), ("2023-12-15", "2023-12-15T00:00:00"), ("15 Dec 2023", "2023-12-15T00:00:00"), (" last  week ", "last week"), ("", "")])
def test_date(spark, given, want):
    assert value(spark, web.parse_date("c"), c=given) == want


def test_urls(spark):
    base = "https://x.org/f"
    assert value(spark, web.resolve_url("u", base), u="//y.org/a") == "https://y.org/a"
    assert value(spark, web.resolve_url("u", base), u="/a") == "https://x.org/a"
    assert value(spark, web.resolve_url("u", base), u="a") == "https://x.org/f/a"
    assert value(spark, web.resolve_url("u", base), u="") == ""
    r, refs = random.Random(1), ["../a", ".", "..", "./", "a/./b/../c", "/x//y/", "?q=1", "#top", "a?b=/../c", "../../..", "mailto:a@b", "a//b/", "/"]
    refs += ["".join(r.choices(["a", "b", "/", ".", "..", "?", "#", "-1"], k=r.randint(1, 7))) for _ in range(300)]
    refs = [x for x in refs if not x.startswith("//") and "?#" not in x]
    got = spark.createDataFrame([(x,) for x in refs], "u string").select("u", web.resolve_url("u", "https://x.org/f/g").alias("v")).collect()
    tidy = lambda x: x.removesuffix("#").removesuffix("?").removesuffix("#")
    for x in got:
        assert tidy(x["v"]) == tidy(urljoin("https://x.org/f/g/", x["u"])), x["u"]
    assert value(spark, web.id_from_url("u"), u="https://x.org/threads/12345-a-title") == "12345"
    assert value(spark, web.id_from_url("u"), u="/forum/s14/faqs/no-start") == "no-start"
    assert value(spark, web.id_from_url("u", allow_slug=False), u="/forum/faqs") == ""
    assert value(spark, web.id_after("u"), u="/threads/12345-a") == "12345"
    assert value(spark, web.id_after("u"), u="/forum/67-name") == "67"
    assert value(spark, web.id_after("u"), u="/a/b") is None
    assert value(spark, web.looks_like_thread("u"), u="/forum/s14/general/1330282-t") is True
    assert value(spark, web.looks_like_thread("u"), u="/forum/5-general") is False
    assert value(spark, web.is_symbol("u"), u="/A.GIF") is True
    assert value(spark, web.image_filename("u", F.lit("p"), F.lit(0)), u="http://x/a.PNG?b").endswith(".png")


def test_json(spark):
    good = '[{"question": "q", "answer": "a", "question_type": "t"}]'
    for given in (good, f"```json\n{good}\n```", f"Here: {good} done"):
        assert value(spark, jsonx.parse_list("t"), t=given)[0]["question"] == "q", given
    for given in ("", "no", '{"a": 1}', "[broken"):
        assert value(spark, jsonx.parse_list("t"), t=given) == [], given
    assert value(spark, jsonx.parse_object("t"), t='```\n{"content_type": "text", "confidence": 0.5}\n```')["content_type"] == "text"
    assert value(spark, jsonx.parse_first_object("t"), t='x {"content_type": "text"} y')["content_type"] == "text"
    assert value(spark, jsonx.parse_first_object("t"), t="nothing")["confidence"] == 0.0
