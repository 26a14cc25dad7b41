import json

from pyspark.sql import functions as F

from tallyloom.functions import language
from tallyloom.operators import jobs, reshape

ROWS = "_row long, Type string, Identification string, Field string, `Default content` string, `Translated content` string"


def arabic(texts):
    """Stands for a translator: knows all but one text."""
    return [None if "unknown" in t else f"نص {len(t)}" for t in texts]


def test_translate_rows(spark):
    tree = json.dumps({"type": "root", "children": [{"type": "text", "value": "one"}, {"type": "text", "value": "two!"}]})
    data = [
        (0, "P", "1", "title", "Hello", ""), (1, "P", "1", "handle", "hello", "hello"), (2, "P", "1", "hero.image", "a.png", ""), (3, "P", "1", "body", tree, ""), (4, "P", "2", "title", "unknown thing", "old"),
        (5, "P", "3", "title", "Good day", "نص جيد"), (6, "P", "4", "title", "Earlier", ""), (7, "P", "5", "body", "A long one. " * 20, ""), (8, "P", "6", "title", "", ""),
    ]
    done = spark.createDataFrame([("P|4|title", "سابق")], "id string, translation string")
    got = {r["_row"]: (r["bucket"], r["Translated content"]) for r in jobs.translate_rows(spark.createDataFrame(data, ROWS), arabic, done, most_tokens=30).collect()}
    assert got[0] == ("translate", "نص 5") and got[1] == ("skip", "") and got[2] == ("keep", "a.png") and got[4] == ("bad", "old") and got[5] == ("from_csv", "نص جيد") and got[6] == ("from_previous", "سابق") and got[8] == ("skip_empty", "")
    assert [c["value"] for c in json.loads(got[3][1])["children"]] == ["نص 3", "نص 4"]
    assert got[7][1].count("نص") > 1


def test_validate_rows(spark):
    long = "نص عربي طويل جدا هنا كامل"
    data = [
        (0, "P", "1", "a.x", "Hello World there", "Hello World there"), (1, "P", "2", "a.x", "red green blue", long), (2, "P", "2", "a.y", "sun moon stars", long), (3, "P", "3", "a.x", "alpha beta gamma delta", "نص one two three"),
        (4, "P", "3", "a.y", "one two three four", "نص عربي"), (5, "P", "4", "x.image", "a", "b"), (6, "P", "5", "a.x", "Fine words", "كلمات"),
    ]
    got = {r["row"]: r["source"] for r in jobs.validate_rows(spark.createDataFrame(data, ROWS)).collect()}
    assert got == {0: "script_high", 1: "duplicate", 2: "duplicate", 3: "heuristic"}


def test_audit_fix_verify(spark):
    fields = spark.createDataFrame([("a", "title", "Hello there", "d", None, False, False), ("b", "title", "Good day", "d", "نص جيد", True, True), ("c", "title", "unknown", "d", "Bonjour", False, True), ("d", "link", "/x", "d", None, False, False)], "resource_id string, key string, value string, digest string, translation string, outdated boolean, has_translation boolean")
    after, delta = jobs.audit_fix_verify(fields, arabic)
    assert {r["resource_id"]: r["status"] for r in after.collect()} == {"a": "OK", "b": "OK", "c": "NOT_ARABIC", "d": "SKIP"}
    assert {r["status"]: (r["before"], r["after"]) for r in delta.collect()} == {"MISSING": (1, 0), "OUTDATED": (1, 0), "OK": (0, 2), "NOT_ARABIC": (1, 1), "SKIP": (1, 1)}


def test_maps_and_records(spark):
    make = spark.createDataFrame
    items = make([("s", "old", 1.0, None, "SAR", 1), ("s", "new", 2.5, 3.5, "SAR", 2), ("", "x", 1.0, 1.0, "SAR", 3)], "sku string, name string, final_price double, regular_price double, currency string, ord int")
    assert [tuple(r) for r in reshape.price_map(items, "ord").collect()] == [("s", "new", 2, 4, "SAR")]
    media = make([("s", "b", 2), ("s", "a", 1), ("s", "b", 3)], "sku string, url string, pos int")
    assert [tuple(r) for r in reshape.media_by_key(media, "sku", "url", "pos").collect()] == [("s", ["a", "b"])]
    xml = make([("<loc> https://x/y.xml </loc><loc>https://x/products/a</loc><loc>https://x/about</loc>",)], "v string")
    assert sorted(map(tuple, reshape.sitemap_urls(xml, "v").collect())) == [("page", "https://x/about"), ("product", "https://x/products/a"), ("sitemap", "https://x/y.xml")]
    assert [tuple(r) for r in reshape.key_sets(make([("k", "b"), ("k", "a"), ("k", ""), (None, "x")], "k string, i string"), "k", "i").collect()] == [("k", ["a", "b"])]
    assert sorted(map(tuple, reshape.weighted_outcomes(make([("a",), ("a",), ("b",), ("",)], "v string"), "v", F.when(F.col("v") == "", "empty").otherwise("ok")).collect())) == [("empty", 1, 1), ("ok", 2, 3)]
    budget = reshape.key_budget(make([("x", "t"), ("x", ""), ("y", "t")], "c string, translation string"), F.col("c"), 1)
    assert sorted(map(tuple, budget.collect()), key=repr) == [("x", 2, 1, 0), ("y", 1, 1, 0), (None, 3, 2, 1)]
    assert reshape.pruned(make([('{"a": {"b": "x"}, "c": "y"}',)], "v string"), "v", make([("a.b",)], "k string")).first()[0] == '{"c": "y"}'
    template = json.dumps({"sections": {"s": {"type": "t", "settings": {"heading": "Our story", "color": "#fff"}, "blocks": {"b": {"type": "u", "settings": {"text": "More"}}}}}})
    texts = reshape.template_texts(make([(template,)], "v string"), "v", language.needs_translation).collect()
    assert sorted((r["block_id"] or "", r["value"]) for r in texts if not r["value"].startswith("#")) == [("", "Our story"), ("b", "More")]
    names = ["ID", "Name", "Email", "Phone", "Country", "City", "State/Province", "ZIP", "Company", "Street Address", "Billing Firstname", "Billing Lastname"]
    people = make([("7", "ann lee", "A.Lee@X.Y", "00 966 50 12", "Kuwait", "jeddah", "Texas", "1", "", "a\nb", "", ""), ("8", "", "noura.saleh@x.y", None, "", "", "", "", "", "", "", "")], ", ".join(f"`{n}` string" for n in names))
    first, second = reshape.customer_records(people).orderBy("tags").collect()
    assert (first["first_name"], first["last_name"], first["email"], first["phone"]) == ("Ann", "Lee", "a.lee@x.y", "+9665012")
    assert (first["address"]["address1"], first["address"]["city"], first["address"]["province"]) == ("a, b", "Jeddah", "") and (second["first_name"], second["last_name"]) == ("Noura", "Saleh")
