import random

from pyspark.sql import functions as F

from tallyloom.operators import changes, match


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_fields_and_status(spark):
    node = "resourceId string, translatableContent array<struct<key:string,value:string,digest:string>>, translations array<struct<key:string,value:string,outdated:boolean>>"
    nodes = spark.createDataFrame([("g1", [("title", "Deep Blue Serum", "d1"), ("body", "Some text", "d2")], [("title", "نص", True)]), ("g2", [("title", "Aceite de oliva virgen", "d3")], [("title", "نص <div><p>x</p></div>", False)]), ("g3", [], [])], node)
    fields = changes.translatable_fields(nodes)
    assert rows_of(fields, "resource_id", "key", "translation", "outdated", "has_translation") == [("g1", "body", None, False, False), ("g1", "title", "نص", True, True), ("g2", "title", "نص <div><p>x</p></div>", False, True)]
    assert {r["resource_id"]: r["fields"] for r in changes.translated_resources(fields).collect()} == {"g1": {"title": "نص"}, "g2": {"title": "نص <div><p>x</p></div>"}}
    more = spark.createDataFrame([("g4", "title", "Plain words here", "d", "نص عربي طويل جدا جدا Serum", False, True), ("g5", "title", "Aceite de oliva virgen", "d", "نص عربي", False, True), ("g6", "title", "Plain words", "d", "نص عربي", False, True)], fields.schema)
    got = {(r["resource_id"], r["key"]): r["status"] for r in changes.checked_fields(fields.unionByName(more)).collect()}
    assert got == {("g1", "title"): "OUTDATED", ("g1", "body"): "MISSING", ("g2", "title"): "HTML_BLOAT", ("g4", "title"): "HAS_ENGLISH", ("g5", "title"): "SOURCE_SPANISH", ("g6", "title"): "OK"}


def test_small_plans(spark):
    make = spark.createDataFrame
    rows = make([("a", "title", "x"), ("b", "seo", "y")], "id string, key string, value string")
    assert rows_of(changes.missing_rows(rows, "id", "key", [{"key": "seo", "value": ""}]), "id", "key", "value") == [("a", "seo", ""), ("a", "title", "x"), ("b", "seo", "y")]
    assert rows_of(changes.resolved(make([("RESOLVE:n",), ("RESOLVE:z",), ("v",)], "c string"), "c", make([("n", "id1")], "name string, id string")), "c") == [("",), ("id1",), ("v",)]
    kinds = make([("https://x.y/collections/a", None), ("/", None), ("/blogs/a/b", None), ("/zzz", None), ("/a", "gid://shopify/Page/1"), ("/pages/a", None)], "u string, g string")
    assert [r[0] for r in kinds.select(changes.menu_kind(F.col("u"), F.col("g"))).collect()] == ["COLLECTION", "FRONTPAGE", "ARTICLE", "HTTP", "PAGE", "PAGE"]
    some = make([("r", k, f"k{k}") for k in range(5)], "rid string, ord int, key string")
    assert [(r["batch"], [x["key"] for x in r["rows"]]) for r in changes.batches(some, "rid", "ord", 2, "key").orderBy("batch").collect()] == [(0, ["k0", "k1"]), (1, ["k2", "k3"]), (2, ["k4"])]
    owners = make([("m1", "p1", "ns.k"), ("m2", None, None)], "resource_id string, owner_id string, owner_key string")
    moved = changes.by_owner(make([("m1", "value", "t"), ("m2", "value", "t"), ("p9", "title", "t")], "resource_id string, key string, translation string"), owners)
    assert rows_of(moved, "resource_id", "key") == [("p1", "ns.k"), ("p9", "title")]
    digests = changes.with_digests(moved, make([("p1", "ns.k", "d")], "resource_id string, key string, digest string"))
    assert rows_of(digests, "resource_id", "matched") == [("p1", True), ("p9", False)]
    kv = "id int, k string, value string"
    assert rows_of(changes.fill_empty(make([(1, "a", ""), (1, "b", "x")], kv), make([(1, "a", "n"), (1, "b", "n"), (2, "a", " ")], kv), ["id", "k"]), "id", "k", "value") == [(1, "a", "n")]
    prices = make([("s", 2.5, 9.0), ("t", 1.0, 1.0), ("u", 3.0, 3.0)], "sku string, final double, regular double")
    variants = make([("s", 5.0, 7.0), ("t", 1.0, 2.0), ("u", 1.0, 4.0)], "sku string, price double, compare_at double")
    assert rows_of(changes.price_changes(variants, prices), "sku", "price", "compare_at") == [("s", 2.0, 9.0), ("u", 3.0, 4.0)]
    pairs = make([(1, 10), (2, 10), (3, 30)], "old int, new int")
    assert rows_of(changes.inverse_map(pairs), "old", "new") == [(10, 2), (30, 3)]
    links = changes.links_to_make(make([(1, 3), (2, 3), (9, 3)], "left_id int, right_id int"), pairs, pairs, make([], "left_new int, right_new int"))
    assert rows_of(links, "left_new", "right_new") == [(10, 30)]
    plan = changes.creation_plan(make([(1, "a"), (2, "b"), (3, ""), (4, "c")], "id int, handle string"), make([("b", 7), ("", 8)], "handle string, target_id int"), make([(1,)], "id int"), "id", "handle")
    assert rows_of(plan, "id", "action", "target_id") == [(1, "done", None), (2, "exists", 7), (3, "create", None), (4, "create", None)]
    named = changes.by_name_or_handle(make([("sea-salt", "X", "o"), ("y", "Aloe ", "o"), ("z", "Q", "o")], "handle string, name string, value string"), make([("", "Sea salt", "n1"), ("", "aloe", "n2"), ("", "q", "")], "handle string, name string, value string"))
    assert rows_of(named, "handle", "value") == [("sea-salt", "n1"), ("y", "n2"), ("z", "o")]
    assert rows_of(changes.to_import(make([("a",), ("b",), ("",), ("c",)], "e string"), "e", make([("a",)], "x string"), make([("b",)], "y string")), "e") == [("c",)]
    wanted = make([("m", None, 1, "b"), ("m", None, 0, "a"), ("m", "a", 0, "c"), ("m", None, 2, "gone")], "menu string, parent string, pos int, handle string")
    items = changes.ordered_items(wanted, make([("a", 1), ("b", 2), ("c", 3)], "handle string, id long")).first()["items"]
    assert [(x["handle"], x["id"], [c["handle"] for c in x["children"]]) for x in items] == [("a", 1, ["c"]), ("b", 2, [])]


def test_checks(spark):
    make = spark.createDataFrame
    products = make([(1, "aceite-de-oliva", "draft", [], [("0.00",)]), (2, "soap", "active", ["i"], [("2",)])], "id int, handle string, status string, images array<string>, variants array<struct<price:string>>")
    assert rows_of(changes.catalog_faults(products), "subject", "code") == [(1, "no_images"), (1, "not_active"), (1, "spanish_handle"), (1, "zero_price")]
    assert rows_of(changes.absent(make([("a",), ("b",)], "k string"), make([("a",)], "k string"), "k", "gone"), "code", "subject") == [("gone", "b")]
    gi = "g string, i string"
    diff = changes.group_differences(make([("x", "1"), ("x", "2"), ("y", "1")], gi), make([("x", "2"), ("x", "3"), ("z", "9")], gi), "g", "i").orderBy("g").collect()
    assert [(r["g"], r["missing"], r["extra"], r["n_left"], r["n_right"]) for r in diff] == [("x", ["1"], ["3"], 2, 2), ("y", ["1"], [], 1, 0), ("z", [], ["9"], 0, 1)]
    pages = changes.page_differences(make([("/a", '<img><img><a href="/x">'), ("/b", "<img><img><img>"), ("/c", "")], "p string, h string"), make([("/a", "<img>"), ("/b", "<img>")], "p string, h string"), "p", "h")
    assert rows_of(pages, "p", "verdict", "missing_links") == [("/a", "other_links", ["/x"]), ("/b", "too_few_images", []), ("/c", "missing", [])]
    abc = "k int, a string, b string, o int"
    assert changes.copied_share(make([(1, "x", "y", 0), (2, "x", "y", 0)], abc), make([(1, "x", "y", 1), (2, "x", "y", 2)], abc), "k", ["a", "b"], "o").first().asDict() == {"n": 4, "n_equal": 4, "is_copy": True}
    cover = changes.key_coverage(make([(1, "a", "x"), (2, "a", "x"), (1, "b", "x"), (2, "b", "")], "id int, key string, value string"), ["a", "b", "c"], "key", "id")
    assert rows_of(cover, "key", "n", "state") == [("a", 2, "OK"), ("b", 1, "PARTIAL"), ("c", 0, "MISSING")]


def test_dissimilar_sources_against_all_pairs(spark):
    rng = random.Random(4)
    words = "red blue green deep sea salt sand".split()
    data = [(k, " ".join(rng.choice(words[: 4 + 3 * (k % 2)]) for _ in range(rng.randrange(2, 6))), f"translation number {k % 4} of many") for k in range(120)] + [(200, "one two three", "too short"), (201, None, "x" * 30)]
    table = spark.createDataFrame(data, "id int, s string, t string")
    want = set()
    for i, a, t in data:
        for j, b, u in data:
            x, y = (set((v or "").lower().split()) for v in (a, b))
            if i != j and t == u and len(t) > 20 and min(len(x), len(y)) >= 3 and len(x & y) / max(len(x), len(y)) < 0.3:
                want.add(i)
    for width in (64, 3):
        assert {r["id"] for r in changes.dissimilar_sources(table, "id", "s", "t", width=width).collect()} == want


def test_translation_by_a_function(spark):
    def shout(texts):
        return [None if t == "never" else t.upper() for t in texts]

    table = spark.createDataFrame([("1", "a"), ("2", "never"), ("3", " "), ("4", None), ("5", "a")], "id string, value string")
    assert rows_of(changes.translated_fields(table, shout, size=2), "id", "translation") == [("1", "A"), ("2", None), ("3", None), ("4", None), ("5", "A")]


def test_rule_remap_and_entries_without_rows(spark):
    empty = spark.createDataFrame([], "type string, id int, handle string")
    assert match.entry_status(empty, empty, empty.select("type", "id")).collect() == []
