import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.text import RECORD_MARK as M
from tallyloom.operators import fixes


class Model:
    """Says every value in capitals; writes each request to a folder. A value with `fatal` ends the process while the folder has no file `mended`."""

    def __init__(self, folder, fatal=None):
        self.folder, self.fatal = str(folder), fatal

    def __call__(self, request):
        if self.fatal and self.fatal in request and not os.path.exists(os.path.join(self.folder, "mended")):
            os._exit(1)
        open(os.path.join(self.folder, uuid.uuid4().hex), "w").write(request)
        return "\n".join(line.split(M, 1)[0] + M + line.split(M, 1)[1].upper() for line in request.split("\n"))


def requests(folder):
    return [line.split(M, 1)[1] for p in folder.iterdir() if p.name != "mended" for line in p.read_text().split("\n")]


def test_a_killed_run_goes_on_where_it_was(spark, tmp_path):
    calls, done = tmp_path / "calls", f"file://{tmp_path}/done"
    calls.mkdir()
    fields = [(f"f{k}", f"kind{k % 3}", k, f"value {k}" if k % 7 else " ") for k in range(120)] + [("n", None, 1, None)]
    frame = spark.createDataFrame(fields, "id string, kind string, ord int, value string").repartition(3)
    existing = spark.createDataFrame([("f1", "there"), ("f2", "  "), ("f3", None), ("zz", "unknown")], "id string, translation string")
    ask = Model(calls, "value 50")
    with pytest.raises(Exception):  # noqa: B017, PT011  whatever Spark says of a dead worker
        fixes.fill_gaps(frame, existing, ask, done, most_fields=6, slices=6).collect()
    before = {r["id"] for r in fixes.done_translations(spark, done).collect()}
    first = requests(calls)
    (calls / "mended").touch()
    want = {}
    for i, _, _, v in fields:
        blank = v is None or not v.strip()
        want[i] = ("there", "existing") if i == "f1" else (None, "blank") if blank else (v.upper(), "done")
    for _ in range(2):
        got = {r["id"]: (r["translation"], r["origin"]) for r in fixes.fill_gaps(frame, existing, ask, done, most_fields=6, slices=6).collect()}
        assert got == want
    later = requests(calls)[len(first) :] if False else requests(calls)
    values = {v: i for i, _, _, v in fields}
    assert all(later.count(v) == 1 for v in later if values[v] in before), "what was done is not asked again"
    assert sorted(set(later)) == sorted(v for i, _, _, v in fields if want[i][1] == "done")


def test_audits_and_keys(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    problems = [("P", "g1", "title", "short"), ("P", "g1", "title", "short"), ("P", "g1", "handle", "h"), ("P", "g2", "body", "cut sho"), ("Q", "g3", "x", "own")]
    content = [("g2", "body", "cut short no more", "d2"), ("g1", "title", "short", "d1"), ("g3", "x", "", None)]
    got = fixes.fix_from_audit(spark.createDataFrame(problems, "resource_type string, resource_id string, key string, english string"), spark.createDataFrame(content, "resource_id string, key string, value string, digest string"), Model(calls), f"file://{tmp_path}/a")
    assert sorted(map(tuple, got.collect()), key=repr) == [("g1", "title", "d1", "short", "SHORT"), ("g2", "body", "d2", "cut short no more", "CUT SHORT NO MORE"), ("g3", "x", None, "own", "OWN")]
    keys = [
        ("r", "a", "Add to cart", None, False, "useful"), ("r", "b", "Add to cart", "", True, "useful"), ("r", "c", "Add", "نص", True, "useful"), ("r", "d", "{{ shop.name }}", None, False, None), ("r", "e", "Text", None, False, "junk"),
        ("r", "f", "<b>1</b>", None, False, None), ("r", "g", " ", None, False, None), ("r", "h", "{% if %}Go on", "نص", False, None),
    ]
    frame = spark.createDataFrame(keys, "resource_id string, key string, english string, arabic string, has_translation boolean, category string")
    before = len(requests(calls))
    got = fixes.translate_keys(frame, Model(calls), f"file://{tmp_path}/k")
    assert sorted((r["key"], r["translation"]) for r in got.collect()) == [("a", "ADD TO CART"), ("b", "ADD TO CART"), ("h", "{% IF %}GO ON")]
    assert len(requests(calls)) - before == 2


def test_content_fixes_in_order(spark):
    values = [("p", "1", "body", "<style>x</style>Hola"), ("p", "2", "body", "bad"), ("p", "3", "title", "Hola"), ("p", "4", "body", "fine"), ("p", "5", "body", "silent"), ("p", "6", "body", "x")]
    findings = [("p", "1", "body", "spanish"), ("p", "1", "body", "bloat"), ("p", "1", "body", "bloat"), ("p", "2", "body", "bloat"), ("p", "2", "body", "spanish"), ("p", "3", "title", "spanish"), ("p", "4", "body", "bloat"), ("p", "5", "body", "spanish"), ("p", "9", "body", "bloat")]
    strip = lambda c: F.when(c != "bad", F.regexp_replace(c, "<style>.*?</style>", ""))

    def ask(request):
        return "\n".join(f"{k}{M}" + ("" if v == "silent" else f"EN {v}") for k, v in (line.split(M, 1) for line in request.split("\n")))

    got = fixes.content_fixes(spark.createDataFrame(findings, "type string, id string, field string, issue string"), spark.createDataFrame(values, "type string, id string, field string, value string"), [("bloat", strip)], ("spanish", ask))
    assert {r["id"]: (r["issues"], r["new_value"], r["status"]) for r in got.collect()} == {
        "1": (["bloat", "spanish"], "EN Hola", "updated"), "2": (["bloat", "spanish"], "bad", "failed"), "3": (["spanish"], "EN Hola", "updated"), "4": (["bloat"], "fine", "unchanged"), "5": (["spanish"], "silent", "failed"),
    }


def test_levels_with_a_diamond_and_a_cycle(spark):
    nodes = spark.createDataFrame([(n,) for n in "abcdexyzw"], "node string")
    edges = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "none"), ("x", "y"), ("y", "x"), ("z", "x"), ("z", "a"), ("w", "w")], "node string, needs string")
    got = {r["node"]: (r["level"], r["state"]) for r in fixes.dependency_levels(nodes, edges).collect()}
    o, c = "ordered", "cycle"
    assert got == {"a": (0, o), "b": (1, o), "c": (1, o), "d": (2, o), "e": (0, o), "x": (None, c), "y": (None, c), "w": (None, c), "z": (None, "behind")}
    assert fixes.dependency_levels(nodes.limit(0), edges).collect() == []


def test_missing_definitions(spark):
    source = [
        ("benefit", "g1", 0, "name", "text", None), ("ingredient", "g2", 0, "icon", "file", None), ("ingredient", "g2", 1, "title", "text", None), ("ingredient", "g2", 2, "benefits", "list", "g1"), ("ingredient", "g2", 3, "faq", "ref", "g3"),
        ("faq", "g3", 0, "question", "text", None), ("shopify--x", "g4", 0, "a", "text", None), ("loop", "g5", 0, "b", "ref", "g5"), ("after", "g6", 0, "c", "ref", "g5"), ("lost", "g7", 0, "d", "ref", "gone"),
    ]
    got = fixes.missing_definitions(spark.createDataFrame(source, "type string, id string, pos int, key string, kind string, needs string"), spark.createDataFrame([("faq", "t3"), ("other", "t9")], "type string, id string"))
    rows = {r["type"]: (r["level"], r["state"], r["display_key"], [tuple(f) for f in r["fields"]]) for r in got.collect()}
    assert rows == {
        "benefit": (0, "ordered", "name", [("name", "text", None, None)]),
        "ingredient": (1, "ordered", "title", [("icon", "file", None, None), ("title", "text", None, None), ("benefits", "list", "benefit", None), ("faq", "ref", "faq", "t3")]),
        "loop": (None, "cycle", "b", [("b", "ref", "loop", None)]), "after": (None, "behind", "c", [("c", "ref", "loop", None)]), "lost": (0, "ordered", "d", [("d", "ref", None, None)]),
    }


def test_structural_checks(spark):
    page = {"sections": {"s1": {"type": "featured-collection", "settings": {"collection": "all", "Image": "a.jpg"}}, "s2": {"type": "rich", "settings": {"title": "Best sellers", "image_2": ""}, "blocks": {"b": {"settings": {"bg_image": None, "image": "x"}}}}, "s3": {"type": "text", "settings": {"heading": "Hi"}}}, "order": ["s1"]}
    plain = {"sections": {"t": {"type": "text"}}}
    frame = spark.createDataFrame([("home", json.dumps(page)), ("plain", json.dumps(plain)), ("none", json.dumps({})), ("broken", "{"), ("null", None)], "name string, value string")
    got = sorted(map(tuple, fixes.homepage_checks(frame).collect()), key=repr)
    assert got == sorted([
        ("home", "s1", "product_section", "ok", 1), ("home", "s2", "product_section", "fail", 1), ("home", None, "images", "ok", 2), ("home", None, "images", "warn", 2), ("plain", None, "no_product_section", "warn", 1),
        ("none", None, "no_product_section", "warn", 1), ("broken", None, "unreadable", "fail", 1), ("null", None, "unreadable", "fail", 1),
    ], key=repr)
    items = spark.createDataFrame([("main", "Shop All", "/collections/ALL"), ("main", None, "/pages/about")], "menu string, title string, url string")
    expected = spark.createDataFrame([("main", "shop"), ("main", "about"), ("main", "blog"), ("footer", "terms")], "menu string, keyword string")
    assert {(r[0], r[1]): r[2] for r in fixes.menu_checks(items, expected).collect()} == {("main", "shop"): "ok", ("main", "about"): "ok", ("main", "blog"): "warn", ("footer", "terms"): "fail"}
    listing = {"sections": {"a": {"type": "grid"}, "b": {"type": "cards"}, "c": {"type": "plain"}, "d": {"type": "lost"}}}
    assets = spark.createDataFrame([("t.json", json.dumps(listing)), ("d.json", "{"), ("sections/grid.liquid", "{% for m in metaobjects %}{{ m.url }}"), ("sections/cards.liquid", "<a HREF='x'>"), ("sections/plain.liquid", "text")], "name string, value string")
    definitions = spark.createDataFrame([("ingredient", True, None), ("faq", False, False)], "type string, renderable boolean, publishable boolean")
    got = {(r[0], r[1]): r[2] for r in fixes.listing_checks(assets, "t.json", "d.json", definitions, "ingredient").collect()}
    assert got == {("template", "t.json"): "ok", ("detail_template", "d.json"): "fail", ("section_links", "a"): "ok", ("section_links", "b"): "info", ("section_links", "c"): "warn", ("section_links", "d"): "unknown", ("renderable", "ingredient"): "ok", ("publishable", "ingredient"): "fail"}
