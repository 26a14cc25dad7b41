"""Literal cases of the rules for texts, keys, trees, HTML and customers."""

import json

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import classify, html, language, people, text, trees
from tallyloom.operators import reshape, rows


def check(spark, column, cases, names=("v",)):
    """cases: (values..., expected), all evaluated in one job."""
    schema = "_k int, " + ", ".join(f"{n} string" for n in names)
    table = spark.createDataFrame([(k, *c[:-1]) for k, c in enumerate(cases)], schema)
    got = {r["_k"]: r["r"] for r in table.select("_k", column.alias("r")).collect()}
    plain = lambda x: x.asDict(recursive=True) if hasattr(x, "asDict") else [plain(y) for y in x] if isinstance(x, list) else x
    wrong = [(c, plain(got[k])) for k, c in enumerate(cases) if plain(got[k]) != c[-1]]
    assert not wrong





def test_keys(spark):
    s = "section.x.settings."
    cases = [
        ("shopify.checkout.title", "Checkout", "shopify_platform"), ("customer_accounts.login.title", "Log in", "shopify_platform"), ("accessibility.skip_to_content", "Skip to content", "theme_locale"),
        ("products.product.add_to_cart", "Add to cart", "theme_locale"), (s + "text", "", "junk"), (s + "text", None, "junk"), (s + "image", "shopify://shop_images/hero.jpg", "junk"), (s + "link", "https://example.com", "junk"),
        (s + "color", "#ff0000", "junk"), (s + "count", "42", "junk"), (s + "flag", "true", "junk"), (s + "data", '{"reviewCount": 5}', "junk"), (s + "id", "a1b2c3d4-e5f6-7890-abcd-ef1234567890", "junk"), (s + "width", "16px", "junk"),
        (s + "bg", "hero-banner.jpg", "junk"), (s + "link", "/collections/all", "junk"), (s + "stat", "<h2>01</h2>", "junk"), (s + "x", "{{ a }}", "junk"), (s + "x", "eu1", "junk"), (s + "x", "=", "junk"), (s + "x", "¿¡«»", "review"),
        (s + "heading", "Sulfate Free", "useful"), (s + "heading", "خالٍ من الكبريتات", "useful"), (s + "text", "<h2>Our Story</h2>", "useful"), (s + "heading", "Free Shipping on orders over 200 SAR", "useful"), ("section.a.form_id:b", "Some text", "junk"),
    ]
    check(spark, classify.key_class(F.col("k"), F.col("v"))["category"], cases, ("k", "v"))
    check(spark, classify.key_source(F.col("v")), [("section.a", "theme_editor"), ("general.a", "theme_locale"), ("shopify.checkout.a", "checkout"), ("shopify.a", "shopify_system"), ("cart.a", "theme_locale"), ("SHOP_POLICY.b", "policy"), ("zzz", "other")])


def test_classes_of_rows(spark):
    check(spark, classify.removal_reason(F.col("f"), F.col("v")), [("a", "", "empty"), ("a.color_2", "x", "field_pattern"), ("a", "No", "untranslatable_value"), ("a", "#abc", "untranslatable_value"), ("a", '["1"]', "untranslatable_value"), ("a", "Text", None), ("a", "<style>" + "x" * 200 + "</style>", "untranslatable_value")], ("f", "v"))
    check(spark, classify.content_kind(F.col("f"), F.col("v")), [("Main.Title", "x", "heading"), ("a.body_html", "x", "body"), ("a", "Water, Sea Salt", "ingredients"), ("a", "plain", "text"), ("a", None, "text")], ("f", "v"))
    check(spark, classify.is_not_uploaded(F.col("f"), F.col("v")), [("handle", "x", True), ("a", "{{ x }}", False), ("a", "[]", True), ("a", '{"reviewCount":1}', False), ("a", "12", True)], ("f", "v"))
    tree = json.dumps({"type": "root", "children": [{"type": "text", "value": "a text of more than twenty letters"}]})
    cases = [("Plain", '{"type": "root"}', "rich_text_json_in_plain_field"), (tree, "قصير", "truncated_json_translation"), ("How to Use", "x" * 51, "heading_got_content_translation"), ("A", 'x "reviewCount"', "review_json_leaked"), ("A", "B", None), ("A", "", None), (None, "x", None)]
    check(spark, classify.misplacement(F.col("s"), F.col("t"), trees.rich_text("s")), cases, ("s", "t"))
    issue = classify.script_issue(F.lit("a.title"), F.col("s"), F.col("t"), F.col("t"))
    arabic = "نص عربي طويل جدا "
    cases = [
        ("Hello World there", "Hello World there", {"reason": "untranslated: Arabic identical to English", "severity": "high"}), ("{{ x }}", "{{ x }}", None), ("Brand™", "Brand™", None), ("word", "word", None),
        ("Hello there", "bonjour a tous", {"reason": "no Arabic script in translation", "severity": "high"}), ("Hello", arabic, None), ("A longer sentence is here", arabic * 20, {"reason": "Arabic is 13.6x longer than English", "severity": "medium"}),
        ("Short title", arabic * 20, {"reason": "heading has paragraph-length translation (340 chars)", "severity": "medium"}), ("x", None, None),
        ("a" * 400, "كلمة عربية قصيرة للاختبار", {"reason": "Arabic is 0.1x shorter than English", "severity": "medium"}),
    ]
    check(spark, issue, cases, ("s", "t"))
    check(spark, classify.html_issues(F.col("s"), F.col("t")), [("<p>a</p>", "<p>b</p>", []), ("<p>a</p>", "<p>b", ["tag count: 2 -> 1", "unclosed <p>"]), ("a<br>", "b<br>", []), ("<b>x</b>", "<i>x</b>", ["unclosed <i>"])], ("s", "t"))
    untranslated = classify.is_untranslated(F.col("t"), F.col("s"), trees.rich_text("t"), trees.rich_text("s"))
    check(spark, untranslated, [("A", "a ", True), ("A", "B", False), (None, "A", False), (tree, tree.replace("root", "root "), True)], ("t", "s"))
    check(spark, classify.is_translatable_field(F.col("k"), F.col("v")), [("title", "x", True), ("handle", "x", False), ("a", "gid://x/1", False), ("a", " ", False), ("a", None, False)], ("k", "v"))
    check(spark, classify.is_image_setting(F.col("v")), [("hero_image", True), ("image_position", False), ("title", False)])
    check(spark, classify.image_preset(F.col("s"), F.col("v")), [("slideshow", "x", "hero"), ("my-icon-row", "x", "icon"), ("other", "top_banner", "hero"), ("other", "thumbnail_1", "thumbnail"), ("other", "x", "default")], ("s", "v"))
    check(spark, classify.normal_json(F.col("v")), [('{"a": 1}', '{"a":1}'), ("{a", None), (None, None)])
    check(spark, classify.has_arabic_for_upload(F.col("v"), trees.rich_text("v")), [("", False), ("12", True), ("مرحبا", True), ("hello", False), ("م hello", False), (tree, False)])


def test_languages(spark):
    check(spark, language.is_visibly_arabic(F.col("v")), [(None, True), ("ab", True), ("SAR", True), ("12 apples here", True), ("Hello world", False), ("مرحبا hi", True), ("م hello world", False), ("pH balanced", True)])
    check(spark, language.is_visibly_arabic(F.col("v"), allowed=("Brand",)), [("Brand name here", True), ("Other name here", False)])
    check(spark, language.mixed_language(F.col("v")), [("نص Hello World again", "English"), ("نص tratamiento hidratante", "Spanish"), ("Hello World again", None), ("نص عربي طويل جدا هنا abc", None), (None, None)])
    check(spark, language.spanish_hint(F.col("v")), [("el cuidado de la piel", "likely_spanish"), ("something longer than that de x", "possibly_spanish"), ("de", None), ("plain English words", None)])
    tree = json.dumps({"type": "root", "children": [{"type": "text", "value": "aceite de argán"}]}).replace('{"type": ', '{"type":')
    check(spark, language.is_spanish(F.col("v"), trees.rich_text_nodes("v")), [("para el pelo", True), ("champú", True), ("abc", False), ("English only", False), (None, False), (tree, True)])
    check(spark, language.keeps_spanish(F.col("v")), [("نص aceite de oliva virgen", True), ("نص aceite", False), ("نص", False)])
    check(spark, language.needs_translation(F.col("v")), [("Add to cart", True), ("267 mL", False), ("12 %", False), ("دفع آمن مشفر Mask", True), ("دفع آمن مشفر كامل NMF", False), ("نص", False), ("a", False), (None, False)])
    check(spark, language.english_terms(F.col("v")), [("<b>Shampoo</b> و Dry Oil", ["Shampoo", "Dry Oil"]), ("نص", []), (None, [])])
    check(spark, language.keeps_english(F.col("v")), [("نص Shampoo", True), ("Shampoo", False), ("نص Full INCI: Mask", False), ("نص", False)])
    names = {"Deep Blue": "أزرق", "Deep Blue Sea": "بحر"}
    check(spark, language.names_replaced(F.col("v"), names), [("a deep blue SEA and Deep Blue", "a بحر and أزرق"), ("x", "x"), (None, None)])
    check(spark, language.names_left(F.col("v"), names), [("a deep blue SEA", [{"name": "deep blue SEA", "translation": "بحر"}]), ("x", []), (None, [])])
    check(spark, text.normal_form(F.col("v")), [("A  <b>B</b> %{count}\n c", "a b c")])
    check(spark, trees.unicode_slug(F.col("v")), [("Crème & Thé™ No. 1", "crème-and-thé-no-1"), ("نص عربي", "نص-عربي"), (None, None)])


TREE = {"type": "root", "children": [{"type": "list", "children": [{"type": "paragraph", "children": [{"type": "text", "value": "a"}]}]}, {"type": "text", "value": "b"}]}


def test_trees(spark):
    both = spark.createDataFrame([(json.dumps(TREE), [("0.0.0", "x"), ("9.9", "no")]), ("{", [("", "x")]), (None, None), (json.dumps(TREE), None)], "v string, t array<struct<path:string,value:string>>")
    got = [r[0] for r in both.select(trees.with_texts("v", "t")).collect()]
    assert json.loads(got[0])["children"][0]["children"][0]["children"][0]["value"] == "x" and got[1:3] == ["{", None] and got[3] == json.dumps(TREE)
    check(spark, trees.sane_json(F.col("v")), [('{"a": "x\ny"}', '{"a": "x\\ny"}'), ('{"a": "x\x01y"}', '{"a": "xy"}'), ('{"a": 1}', '{"a": 1}'), ("text", "text"), ("{broken", "{broken"), (None, None), ('{"a": "x\\\ny"}', '{"a": "x\\ny"}')])
    model = {"type": "root", "children": [{"type": "list", "listType": "ordered", "children": [{"type": "list-item", "children": []}]}]}
    mended = spark.createDataFrame([(json.dumps(TREE) + " trailing", json.dumps(model)), ("no", "{}"), (None, "{}")], "v string, m string").select(trees.mended_tree("v", "m")).collect()
    first = json.loads(mended[0][0])["children"][0]
    assert first["listType"] == "ordered" and first["children"][0]["type"] == "list-item" and mended[1][0] == "no" and mended[2][0] is None
    check(spark, trees.texts_anywhere(F.col("v")), [('{"x": {"type": "text", "value": "a"}, "y": [{"type": "text", "value": "b"}]}', ["a", "b"]), ("{", None)])
    check(spark, trees.json_leaves(F.col("v")), [('{"a": {"b": "x"}, "c": ["y", 1]}', [{"path": "a.b", "value": "x"}, {"path": "c.0", "value": "y"}]), ("{", [])])
    check(spark, trees.dotted(F.col("v")), [('{"a": {"b": "x", "c": 1}, "d": null}', {"a.b": "x", "a.c": "1", "d": None}), ("[1]", None)])
    check(spark, trees.nested(trees.dotted(F.col("v"))), [('{"a": {"b": "x"}, "d": "y"}', '{"a": {"b": "x"}, "d": "y"}')])
    check(spark, trees.answered_items(F.col("v")), [('```json\n[{"i": 1}]\n``` and [2] done', ['{"i": 1}', "2"]), ("none", None), ("[", []), (None, None)])
    check(spark, reshape.category_rows(F.col("v")), [(json.dumps([{"name": "A", "children": [{"name": "B", "product_count": 2}]}, {"name": "C"}]), [{"path": [0], "url_key": None, "name": "A", "product_count": 0}, {"path": [0, 0], "url_key": None, "name": "B", "product_count": 2}]), ("{", [])])


def test_tree_fields_there_and_back(spark):
    table = spark.createDataFrame([("a", json.dumps(TREE)), ("b", "plain"), ("c", "untranslated")], "id string, v string")
    fields = rows.tree_fields(table, "id", "v")
    assert sorted((r["id"], r["value"]) for r in fields.collect()) == [("a::node0", "a"), ("a::node1", "b"), ("b", "plain"), ("c", "untranslated")]
    translated = fields.filter("parent <> 'c'").withColumn("value", F.upper("value"))
    got = {r["id"]: r["translation"] for r in rows.apply_tree_fields(table, "id", "v", translated).collect()}
    assert got["b"] == "PLAIN" and got["c"] is None and '"A"' in got["a"] and '"B"' in got["a"] and json.loads(got["a"])["children"][0]["listType"] == "unordered"


def test_html(spark):
    cases = [
        ('<div class="pagebuilder-row x" data-a="1" onclick="f()"><p>Hi</p> there</div>', '<div class="x"><p>Hi</p> there</div>'), ("<div><span><b>x</b></span></div>", "<b>x</b>"), ("<p></p><img src='a'><br>y", '<img src="a"><br>y'),
        ("<style>a</style><script>b</script>z", "z"), ("a &amp; b <!-- c -->", "a &amp; b <!-- c -->"), ('<a href="#t">u</a><i id="t">v</i>', '<a href="#t">u</a><i id="t">v</i>'), ("", ""), (None, None), ("<p>open", "<p>open</p>"),
    ]
    check(spark, html.clean_html(F.col("v")), cases)
    check(spark, html.has_bloat(F.col("v")), [("<p>x</p>", False), ("<p  >x</p>", True), (None, False), ("<div><p>x</p></div>", True)])
    check(spark, html.clean_html_of_theme({"x"}, set())(F.col("v")), [('<b class="x y" id="z">a</b>', '<b class="x">a</b>')])


def test_customers(spark):
    check(spark, people.phone(F.col("v")), [("00 966-50 123", "+96650123"), ("+1 (2) 345", "+12345"), ("12", ""), (None, ""), ("12345", "+12345")])
    check(spark, people.split_name(F.col("v")), [("Ann  Lee Po", {"first": "Ann", "last": "Lee Po"}), ("Ann", {"first": "Ann", "last": ""}), (None, {"first": "", "last": ""})])
    check(spark, people.name_case(F.col("v")), [("ALFHIMANI", "Alfhimani"), ("o'neil-smith", "O'Neil-Smith"), ("AlSanie", "AlSanie"), ("نورة", "نورة"), ("a@b.c", "")])
    check(spark, people.name_of_email(F.col("v")), [("noura.mubaireek@x.com", {"first": "Noura", "last": "Mubaireek"}), ("mohammed_ali123@y.com", {"first": "Mohammed", "last": "Ali"}), ("sarah@x", {"first": "Sarah", "last": ""}), ("no", {"first": "", "last": ""}), (None, {"first": "", "last": ""})])
    check(spark, people.province(F.col("v"), F.lit("Kuwait")), [("Texas", ""), ("Hawalli", "Hawalli"), (None, "")])
    check(spark, people.address_lines(F.col("v")), [("a \n\n b", ["a", "b"]), (None, [])])
    check(spark, F.get(people.city_candidates(F.col("v")), F.lit(0)), [("Dhahran 34248", "dhahran"), ("Riyadh, Saudi Arabia", "riyadh"), (" Jeddah ", "jeddah"), ("", None)])
    check(spark, F.array_contains(people.city_candidates(F.col("v")), "jubail"), [("Ksa / jubail", True), ("Jubail Industrial City", True), ("139/ jubail", True), ("Asir- jubail", True), ("Elsewhere", False)])


def test_ids_and_arrays(spark):
    check(spark, reshape.global_id(F.lit("Page"), F.col("v")), [("'12", "gid://shopify/Page/12"), ("gid://shopify/Page/3", "gid://shopify/Page/3"), (None, None)])
    check(spark, reshape.id_type(F.col("v")), [("gid://shopify/Page/3", "Page"), ("x", None)])
    check(spark, reshape.id_number(F.col("v")), [("gid://shopify/Page/3", 3), ("x", None)])
    table = spark.createDataFrame([([("n", "a", "1"), ("n", "b", "2")],), (None,)], "f array<struct<namespace:string,key:string,value:string>>")
    got = [[tuple(x) for x in r[0]] for r in table.select(reshape.upserted(F.col("f"), F.lit("n"), F.lit("b"), F.lit("9"))).collect()]
    assert got == [[("n", "a", "1"), ("n", "b", "9")], [("n", "b", "9")]]
    assert [r[0] for r in table.select(reshape.field_value(F.col("f"), "a")).collect()] == ["1", None]
    assert spark.createDataFrame([(["a", "b"],)], "t array<string>").select(reshape.joined_tags(F.col("t"), True)).first()[0] == "a, b"


@pytest.mark.parametrize("value", ["a\n\nb\n\n\nc", "x\ny\nz", "One. Two! Three?", "z" * 500, "", "\n\n\n", "a b"])
def test_pieces_join_to_the_text(spark, value):
    parts = spark.createDataFrame([(value,)], "v string").select(rows.pieces(F.col("v"), 10)).first()[0]
    assert "".join(parts) == value and all(len(p) <= 30 for p in parts)
