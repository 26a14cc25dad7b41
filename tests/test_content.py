import json

from tallyloom.operators import content
from tallyloom.sources import export

MF = "array<struct<namespace:string,key:string,value:string,type:string>>"


def test_snapshots_of_pages_under_one_schema(spark, tmp_path):
    pages = {"products/page-1.json": [{"id": 1, "handle": "a", "title": "عربي", "vendor": "x"}, {"id": 2, "title": "B"}], "products/page-2.json": [{"id": 3, "handle": "c", "body_html": "<p>\n</p>"}], "pages/p.json": [{"id": 9, "handle": "about"}], "blogs/none.json": []}
    for name, rows in pages.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps(rows, ensure_ascii=False, indent=1), encoding="utf-8")
    schema = "id long, handle string, title string, body_html string"
    kinds = {k: export.snapshot(spark, f"file://{tmp_path}", k, schema) for k in ("products", "pages", "blogs", "missing")}
    assert {k: v.count() for k, v in kinds.items()} == {"products": 3, "pages": 1, "blogs": 0, "missing": 0}
    metafields = spark.createDataFrame([("1", "n", "b", "2", "text"), ("1", "n", "a", "1", "text"), ("1", "n", "a", "0", "text"), ("7", "n", "a", "1", "text")], "owner_id string, namespace string, key string, value string, type string")
    kinds["products"] = export.with_metafields(kinds["products"], metafields)
    kinds["odd"] = spark.createDataFrame([("gid://x/1", "only a type")], "id string, type string")
    got = {r["id"]: (r["kind"], r["handle"], r["title"], None if r["metafields"] is None else [tuple(m) for m in r["metafields"]]) for r in export.all_resources(kinds).collect()}
    assert got == {
        "1": ("products", "a", "عربي", [("n", "a", "1", "text"), ("n", "b", "2", "text")]), "2": ("products", None, "B", []), "3": ("products", "c", None, []), "9": ("pages", "about", None, None), "gid://x/1": ("odd", None, None, None),
    }


def test_content_audit(spark):
    tree = json.dumps({"type": "root", "children": [{"type": "paragraph", "children": [{"type": "text", "value": "champú para el cabello"}]}]})
    rows = [
        ("product", "1", "a", "Champú para el cabello", '<div data-x="1"><p>Tratamiento para el cabello seco</p></div>', [("n", "k", tree, "rich_text_field"), ("n", "e", "", "text")]), ("page", "2", "b", "Plain title", "<p>Plain words here</p>", None),
        ("page", "3", "c", None, "<p>de la</p>", [("n", "m", "champú para cabello", "text")]), ("page", "4", "d", "", None, []),
    ]
    frame = spark.createDataFrame(rows, f"kind string, id string, handle string, title string, body_html string, metafields {MF}")
    got = sorted((r["id"], r["field"], r["issue"]) for r in content.audit_content(frame).collect())
    assert got == [("1", "body_html", "html_bloat"), ("1", "body_html", "spanish"), ("1", "metafield:k", "spanish"), ("1", "title", "spanish"), ("3", "metafield:m", "spanish")]
    assert {r["issue"] for r in content.audit_content(frame, spanish=False).collect()} == {"html_bloat"}


def test_product_faults_and_preparation(spark):
    variants = "array<struct<title:string,sku:string,price:string,compare_at_price:string,inventory_management:string,inventory_quantity:int>>"
    rows = [
        (1, "champu-x", "active", [("s", "")], [("T", "k1", "0.00", None, "shop", 0), ("U", "k2", "2.5", "3", None, 0)]), (2, "plain", None, None, None), (3, "ok", "active", [("s", "alt"), ("", "x"), (None, None)], [("V", None, None, None, "shop", 3), (None, "k9", "9", "10", "", None)]),
    ]
    frame = spark.createDataFrame(rows, f"id int, handle string, status string, images array<struct<src:string,alt:string>>, variants {variants}")
    got = sorted((r["code"], r["subject"]) for r in content.product_faults(frame).collect())
    assert got == [("no_images", "2"), ("no_inventory", "1/T"), ("not_active", "2"), ("spanish_handle", "1"), ("zero_price", "1/T"), ("zero_price", "3/V")]
    whole = frame.selectExpr("*", "'t' AS title", "null AS body_html", "'v' AS vendor", "'' AS product_type", "'x, y' AS tags")
    prices = spark.createDataFrame([("k1", 10, 12), ("k9", 7, 7)], "sku string, final_price int, regular_price int")
    got = {r["id"]: r for r in content.prepared_products(whole, prices).collect()}
    assert [tuple(v) for v in got[1]["variants"]] == [("k1", "10", "12"), ("k2", "2.5", "3")] and [tuple(v) for v in got[3]["variants"]] == [("", "0", None), ("k9", "7", None)]
    assert (got[1]["published"], got[2]["status"], got[2]["published"], got[2]["variants"], got[2]["images"], got[2]["body_html"]) == (True, "draft", False, [], [], "")
    assert [tuple(i) for i in got[3]["images"]] == [("s", "alt")] and [tuple(i) for i in got[1]["images"]] == [("s", None)]
