import json

from pyspark.sql import functions as F

from tallyloom.functions import trees
from tallyloom.operators import extract

PRODUCT = """id long, handle string, title string, body_html string, tags string, variants array<struct<title:string,option1:string,option2:string>>, options array<struct<name:string,values:array<string>>>,
 images array<struct<src:string,alt:string>>, metafields array<struct<namespace:string,key:string,value:string,type:string>>"""


def test_document_fields(spark):
    data = [
        (1, "soap", "Soap", "", "a, b", [("Default Title", "Default Title", None), ("Big", "Large", "Red")], [("Size", ["S", ""])], [("u", "front"), ("v", None)], [("c", "note", "text", "single_line_text_field"), ("c", "ref", "gid", "file_reference")]),
        (2, "", "Other", None, None, None, None, None, None),
    ]
    got = {r["field_id"]: r["value"] for r in extract.document_fields(spark.createDataFrame(data, PRODUCT), "prod", ["handle", "title", "body_html", "tags"]).collect()}
    assert got == {
        "prod.soap.handle": "soap", "prod.soap.title": "Soap", "prod.soap.tags": "a, b", "prod.soap.v1.title": "Big", "prod.soap.v1.option1": "Large", "prod.soap.v1.option2": "Red", "prod.soap.opt0.name": "Size", "prod.soap.opt0.val0": "S",
        "prod.soap.img0.alt": "front", "prod.soap.mf.c.note": "text", "prod.2.title": "Other",
    }
    pages = spark.createDataFrame([(3, "about", "About", ("s", "alt text"))], "id long, handle string, title string, image struct<src:string,alt:string>")
    assert sorted(r["field_id"] for r in extract.document_fields(pages, "coll", ["title"]).collect()) == ["coll.about.image.alt", "coll.about.title"]


def test_visible_literals(spark):
    lines = ['<p>Our Amazing Products</p>', "<p>{{ 'products.title' | t }}</p>", '<input placeholder="Enter your email" aria-label="{{ x }}">', "{% schema %}", '{"name": "<b>Schema text</b>"}', "{% endschema %}", "<b>Shopify</b><i>12px</i>", '<a title="/collections/all">x</a>', "<b>Brandy</b>"]
    table = spark.createDataFrame([("f", k + 1, x) for k, x in enumerate(lines)], "file string, line_number int, line string")
    got = sorted((r["line_number"], r["kind"], r["english"]) for r in extract.visible_literals(table, ("brandy",)).collect())
    assert got == [(1, "text", "Our Amazing Products"), (3, "attribute", "Enter your email")]


def test_json_dictionary(spark):
    docs = [json.dumps({"a": 1, "b": {"c": "de la piel"}, "d": [{"e": "x"}, {"e": None}], "z": 0}), json.dumps({"a": "one", "d": [], "z": False}), "{broken", None]
    got = {r["path"]: r for r in extract.json_dictionary(spark.createDataFrame([(d,) for d in docs], "v string"), "v").collect()}
    assert set(got) == {"$.a", "$.b.c", "$.d[]", "$.d[].e", "$.z"}
    assert (got["$.a"]["kinds"], got["$.a"]["n"], got["$.a"]["n_filled"], got["$.a"]["longest"], got["$.a"]["samples"]) == (["int", "str"], 2, 2, 3, ["1", "one"])
    assert (got["$.b.c"]["n_spanish"], got["$.d[]"]["n_items"], got["$.d[]"]["n"], got["$.d[].e"]["kinds"], got["$.d[].e"]["n_filled"], got["$.z"]["n_filled"]) == (1, 2, 2, ["null", "str"], 1, 0)


def test_status_digest_and_first_rows(spark):
    cases = [("v", None, False, "MISSING"), ("v", "v", False, "IDENTICAL"), ("v", "نص", True, "OK [OUTDATED]"), ("v", "other", False, "NOT_ARABIC")]
    table = spark.createDataFrame(cases, "v string, t string, o boolean, want string")
    for r in table.select("want", extract.simple_status(F.col("v"), F.col("t"), F.col("o"), trees.rich_text("t")).alias("got")).collect():
        assert r["got"] == r["want"]
    rows = spark.createDataFrame([("s", 3, "c"), ("s", 1, "a"), ("s", 2, "a"), ("t", 1, "bbbb"), ("s", 4, "")], "s string, o int, v string")
    assert {r["s"]: r["text"] for r in extract.digest(rows, "s", "o", F.col("v"), 2, 3).collect()} == {"s": "a\nc", "t": "bbb"}
    assert [r["o"] for r in extract.first_rows(rows, "o", 1, ["s"]).orderBy("s").collect()] == [1, 1]
    assert [tuple(r) for r in extract.most_common(rows, "v", 2, "o").collect()] == [("a", 2), ("bbbb", 1)]
    found = spark.createDataFrame([(0, "script", "why", "high", None), (1, "model", "why", "high", 0.9)], "row int, source string, reason string, severity string, confidence double")
    csv = spark.createDataFrame([(0, "P", "1", "f", "<b>x</b>" + "y" * 200, "t"), (1, "P", "1", "g", "x", None)], "_row int, Type string, Identification string, Field string, `Default content` string, `Translated content` string")
    got = {r["row"]: r for r in extract.mismatches(found, csv).collect()}
    assert len(got[0]["english"]) == 120 and got[0]["severity"] == "high" and got[1]["severity"] is None
