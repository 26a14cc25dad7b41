import json

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import match, reshape, rows
from tallyloom.sources import files


def test_csv_there_and_back(spark, tmp_path):
    data = [("PRODUCT", 'a "quoted" word', "two\nlines"), ("PAGE", "", "comma, here"), ("PAGE", "نص", " blanks ")]
    table = spark.createDataFrame(data, "Type string, `Default content` string, `Translated content` string").coalesce(1)
    files.write_csv(table.withColumn("_row", F.lit(1)), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfType")
    back = files.read_csv(spark, str(tmp_path / "out"))
    assert back.columns == ["Type", "Default content", "Translated content", "_row"]
    assert [tuple(r)[:3] for r in back.orderBy("_row").collect()] == data
    plain = tmp_path / "plain.csv"
    plain.write_text('ID,Email,Country\n1,a@x.y,Spain\n2,A@X.Y,Spain\n3,,Spain\n4,b@x.y,Kuwait\n')
    people = files.read_csv(spark, str(plain))
    assert sorted(r["ID"] for r in files.customers(people).collect()) == ["1", "4"]
    assert [r["ID"] for r in files.customers(people, "Spain").collect()] == ["1"]


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 2, "title": "b", "tags": ["x"]}, {"id": 1}]))
    schema = "id long, title string, tags array<string>"
    assert [(r["id"], r["title"]) for r in files.read_json(spark, str(tmp_path / "a.json"), schema).orderBy("_ord").collect()] == [(2, "b"), (1, None)]
    missing = files.read_json(spark, str(tmp_path / "none.json"), schema)
    assert missing.collect() == [] and missing.columns == ["id", "title", "tags", "_ord"]
    files.write_json(files.read_json(spark, str(tmp_path / "a.json"), schema).drop("_ord"), str(tmp_path / "out"))
    assert sorted(r["id"] for r in spark.read.schema(schema).json(str(tmp_path / "out")).collect()) == [1, 2]
    (tmp_path / "c.json").write_text('/* note\n more */ {"a": /* x */ {"b": 1}}')
    (tmp_path / "d.json").write_text("{broken")
    read = files.read_commented_json(spark, str(tmp_path / "[cd].json")).select(F.try_variant_get("value", "$.a.b", "int").alias("b")).collect()
    assert sorted((r["b"] for r in read), key=str) == [1, None]


def test_lines_and_progress(spark, tmp_path):
    (tmp_path / "x.liquid").write_text("one\r\ntwo\n\nfour")
    assert [(r["line_number"], r["line"]) for r in files.read_lines(spark, str(tmp_path / "*.liquid")).orderBy("line_number").collect()] == [(1, "one"), (2, "two"), (3, ""), (4, "four")]
    table, done = spark.createDataFrame([("a",), ("b",), (None,)], "key string"), str(tmp_path / "done")
    assert files.pending(table, done, "key").count() == 3
    for _ in range(2):
        files.mark_done(table.filter("key = 'a'"), done, "key")
    assert spark.read.parquet(done).count() == 1
    assert sorted((r["key"] for r in files.pending(table, done, "key").collect()), key=str) == [None, "b"]
    css = spark.createDataFrame([(".a { } .b-c #d .a",)], "css string")
    assert sorted(map(tuple, files.selectors(css, "css").collect())) == [("class", "a"), ("class", "b-c"), ("id", "d")]


def test_ladder_takes_the_first_key(spark):
    source = spark.createDataFrame([(1, ["b", "a"], ["i.png"]), (2, ["z"], ["J.png"])], "id int, skus array<string>, images array<string>")
    target = spark.createDataFrame([(10, ["a"], ["x.png"]), (11, ["b"], ["j.png"])], "id int, skus array<string>, images array<string>")
    lower = lambda c: F.transform(c, F.lower)
    steps = [("sku", F.col("skus")), ("image", lower(F.col("images")))]
    assert sorted(map(tuple, match.key_ladder(source, target, "id", "id", steps, steps).collect())) == [(1, 11, "sku"), (2, 11, "image")]
    dotted = source.withColumn("a.b", F.lit(1)).withColumn("_k", F.lit(2))
    assert match.unmatched(dotted, target.limit(0), [(F.col("skus"), F.col("skus"))]).count() == 2
    assert [r["id"] for r in match.unmatched(dotted, target, [(F.col("skus"), F.col("skus"))]).collect()] == [2]


def test_handles_templates_and_fields(spark):
    objects = spark.createDataFrame([("faq", "old1", "What is it?", 1), ("faq", "old2", "What is it", 2), ("faq", "", None, 3), ("faq", "", None, 4), ("benefit", "kept", "What is it?", 5)], "type string, handle string, name string, ord int")
    got = reshape.new_handles(objects, "type", "handle", "name", F.col("type") == "benefit", "ord").orderBy("ord").collect()
    assert [(r["handle"], r["ord"]) for r in got] == [("what-is-it", 1), ("", 3), ("", 4), ("kept", 5)]
    template = {"sections": {"s": {"type": "slideshow", "settings": {"image": "shopify://shop_images/a.png", "image_size": "x", "title": "t"}, "blocks": {"b": {"type": "icon-block", "settings": {"img_1": "u", "logo": ""}}}}}}
    images = reshape.template_images(spark.createDataFrame([(1, json.dumps(template)), (2, "{")], "id int, v string"), "v", "id").collect()
    assert sorted((r["setting_key"], r["block_id"] or "", r["preset"]) for r in images) == [("image", "", "hero"), ("img_1", "b", "icon")]
    values = spark.createDataFrame([("prod.h1.title", "a"), ("prod.h1.mf.x.y", "b"), ("bad", "c")], "id string, value string")
    remap = spark.createDataFrame([("h1", "n1")], "old string, new string")
    by = reshape.values_by_document(values, "id", "value", remap)
    assert sorted(map(tuple, by.collect())) == [("prod", "n1", "mf.x.y", "b"), ("prod", "n1", "title", "a")]
    assert reshape.field_maps(by, ["handle"]).first()["fields"] == {"title": "a", "mf.x.y": "b"}
    base = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, x string, y string")
    new = spark.createDataFrame([(1, "", "n"), (3, "p", None)], "id int, x string, y string")
    assert sorted(map(tuple, reshape.overlaid(base, new, "id").collect())) == [(1, "a", "n"), (2, "c", "d"), (3, "p", None)]
    assert reshape.same_rows(base, base) and not reshape.same_rows(base, new)
    assert [r["x"] for r in reshape.by_rank(base, "x", ["c"], "id").collect()] == ["c", "a"]
    fields = spark.createDataFrame([("faq", "h", [("q", "A", "single_line_text_field"), ("r", "gid", "file_reference"), ("s", " ", "rich_text_field")])], "type string, handle string, f array<struct<key:string,value:string,type:string>>")
    assert [tuple(r) for r in reshape.object_fields(fields, "type", "handle", "f").collect()] == [("mo.faq.h.q", "A")]


def test_titles_and_samples(spark):
    left = spark.createDataFrame([(1, 1, "Deep Blue Sea"), (2, 2, "Red Hot"), (3, 3, None)], "id int, ord int, title string")
    right = spark.createDataFrame([(10, 2, "sea of deep green"), (11, 1, "the deep blue"), (12, 3, "hot")], "id int, ord int, title string")
    words = lambda c: F.filter(F.split(F.lower(c), " "), lambda w: F.length(w) > 2)
    assert [tuple(r) for r in match.similar_titles(left, right, words).collect()] == [(1, 11)]
    table = spark.createDataFrame([(k, "a" if k < 90 else "b") for k in range(100)], "id int, g string")
    drawn = rows.stratified_sample(table, "g", "id", 10).collect()
    assert len(drawn) == 10 and sum(r["g"] == "b" for r in drawn) >= 5
    assert sorted(r["id"] for r in drawn) == sorted(r["id"] for r in rows.stratified_sample(table.repartition(3), "g", "id", 10).collect())


@pytest.mark.parametrize("overwrite", [False, True])
def test_buckets_know_earlier_runs(spark, overwrite):
    data = [("P", "1", "title", "Hello there", "Hello there"), ("P", "2", "title", "Hello there", "نص عربي"), ("P", "3", "title", "Hello there", ""), ("P", "4", "handle", "x", ""), ("P", "5", "title", "Hello", "نص Shampoo")]
    table = spark.createDataFrame(data, "Type string, Identification string, Field string, `Default content` string, `Translated content` string")
    done = spark.createDataFrame([("P|3|title",)], "id string")
    got = {r["Identification"]: r["bucket"] for r in rows.row_buckets(table, done, overwrite).collect()}
    want = {"1": "bad", "2": "from_csv", "3": "from_previous", "4": "skip", "5": "bad"}
    assert got == ({k: "translate" if v in ("bad", "from_csv") else v for k, v in want.items()} if overwrite else want)
