import json

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import classify, text, trees
from tallyloom.operators import dedup, flatten, match, sequence


def value_of(spark, column, **values):
    schema = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("", True), ("  ", True), (None, True), ("https://x.y", True), ("/a", True), ("gid://x/1", True), ("-12.5", True), ("12a", False), ("deadbeef", True), ("DEADBEEF", False),
        ("[]", True), ('["gid://a/1","22"]', True), ("[1,2]", False), ('["a"]', False), ("[1,", False), ("{{ a }}", True), ("<b>{{ a }}:</b>", True), ("{{ a }} b", False), ('{"reviewCount":1}', True), ("A title", False),
    ],
)
def test_values_that_are_not_text(spark, value, expected):
    assert value_of(spark, classify.is_not_text(F.lit("title"), F.col("v")), v=value) is expected


@pytest.mark.parametrize(("value", "expected"), [("#fff", True), ("rgba(1,2)", True), ("TRUE", True), ("16px", True), ("{{ a }}", False), ("yes", False)])
def test_skipped_values(spark, value, expected):
    assert value_of(spark, classify.is_skipped_value(F.col("v")), v=value) is expected


@pytest.mark.parametrize(("field", "expected"), [("hero.image", True), ("a.image_1:x", True), ("facebook_url", True), ("general.logo", True), ("title", False), (None, False)])
def test_kept_fields(spark, field, expected):
    assert value_of(spark, classify.is_kept(F.col("v")), v=field) is expected


@pytest.mark.parametrize(
    ("source", "translated", "outdated", "expected"),
    [
        ("Hello there", "مرحبا بكم", False, "OK"), ("Hello there", None, False, "MISSING"), ("Hello", "Hello", False, "IDENTICAL"), ("Hello", "Bonjour", False, "NOT_ARABIC"),
        ("Hello", "مرحبا Hello", False, "MIXED_LANGUAGE"), ("Hello", "مرحبا", True, "OUTDATED"), ("Hello", "123", False, "OK"), ("12", "x", False, "SKIP"), ("<b></b>", "x", False, "SKIP"), ("مرحبا", "مرحبا", False, "OK"),
    ],
)
def test_translation_status(spark, source, translated, outdated, expected):
    assert value_of(spark, classify.translation_status(F.col("s"), F.col("t"), F.lit("title"), F.col("o")), s=source, t=translated, o=outdated) == expected


def test_scripts(spark):
    assert value_of(spark, text.has_script(F.col("v")), v="") is False
    assert value_of(spark, text.has_script(F.col("v")), v="<p>{x}</p>") is True
    assert value_of(spark, text.has_script(F.col("v")), v="مرحبا abc") is True
    assert value_of(spark, text.has_script(F.col("v")), v="م abcdef") is False
    assert value_of(spark, text.has_foreign_share(F.col("v")), v="مرحبا abc") is True
    assert value_of(spark, text.hinted_language(F.col("v")), v="el champú para niños") == "es"
    assert value_of(spark, text.hinted_language(F.col("v")), v="a shampoo") == "en"
    assert value_of(spark, text.hinted_language(F.col("v")), v="12") is None


def test_codec_loses_only_escaped_line_ends(spark):
    line = text.encoded_record(F.lit("a"), F.col("v"))
    for value, back in (("x\ny", "x\ny"), ("p§q", "p§q"), ("a\\b", "a\\b"), ("a\\nb", "a\\\nb")):
        assert value_of(spark, text.decoded_record(line)["value"], v=value) == back
    assert value_of(spark, text.decoded_record(F.col("v")), v="no mark") is None


def test_slugs_and_trees(spark):
    assert value_of(spark, trees.ascii_slug(F.col("v")), v="Crème Brûlée — No. 5!") == "creme-brulee-no-5"
    tree = {"type": "root", "children": [{"type": "p", "children": [{"type": "text", "value": "a"}, {"type": "text", "value": "b"}]}, {"type": "text", "value": "c"}]}
    assert value_of(spark, trees.rich_text("v"), v=json.dumps(tree)) == "a b c"
    assert value_of(spark, trees.rich_text("v"), v="{broken") is None
    assert [tuple(x) for x in value_of(spark, trees.rich_text_nodes("v"), v=json.dumps(tree))] == [("0.0", "a"), ("0.1", "b"), ("1", "c")]


def test_references(spark):
    assert value_of(spark, flatten.references(F.col("v")), v='["gid://a/1","x","gid://a/2"]') == ["gid://a/1", "gid://a/2"]
    assert value_of(spark, flatten.references(F.col("v")), v="gid://a/1") == ["gid://a/1"]
    assert value_of(spark, flatten.references(F.col("v")), v="text") == []
    assert value_of(spark, flatten.references(F.col("v")), v=None) == []


def test_ladder_prefers_earlier_steps_and_last_targets(spark):
    source = spark.createDataFrame([(1, ["a", "b"], "h1"), (2, ["z"], "h2"), (3, None, None)], "id int, skus array<string>, handle string")
    target = spark.createDataFrame([(10, ["b"], "x"), (11, ["b"], "h2"), (12, ["q"], "h1")], "id int, skus array<string>, handle string")
    steps = [("sku", F.col("skus")), ("handle", F.col("handle"))]
    got = match.key_ladder(source, target, "id", "id", steps, steps).collect()
    assert sorted(map(tuple, got)) == [(1, 11, "sku"), (2, 11, "handle")]
    assert [tuple(r) for r in match.one_to_one(match.key_ladder(source, target, "id", "id", steps, steps), F.col("source_id")).collect()] == [(1, 11, "sku")]


def test_jaccard_best_against_all_pairs(spark):
    import random

    rng = random.Random(1)
    sets = [[(k, rng.sample(range(25), rng.randrange(1, 9))) for k in range(60)] for _ in range(2)]
    left, right = (spark.createDataFrame(s, "id int, items array<int>") for s in sets)
    got = {r["left_id"]: (r["right_id"], r["score"]) for r in match.jaccard_best(left, right, 0.3).collect()}
    for k, own in sets[0]:
        scores = [(len(set(own) & set(o)) / len(set(own) | set(o)), -j) for j, o in sets[1]]
        best = max(scores)
        assert got.get(k) == ((-best[1], best[0]) if best[0] >= 0.3 else None)


def test_paths_move_at_slashes_only(spark):
    paths = spark.createDataFrame([("/a/b",), ("/ab",), ("/a",), ("",), (None,)], "path string")
    mapping = spark.createDataFrame([("/a", "/z", 1), ("/a/b", "/y", 2)], "old string, new string, ord int")
    assert {r["path"]: r["new_path"] for r in match.remap_paths(paths, "path", mapping).collect()} == {"/a/b": "/y", "/ab": "/ab", "/a": "/z", "": "", None: None}


def test_choices_and_batches(spark):
    rows = spark.createDataFrame([("k", 1, 5), ("k", 2, 9), ("k", 3, 9), ("j", 4, 1)], "key string, ord int, score int")
    assert sorted(r["ord"] for r in dedup.first_wins(rows, ["key"], F.col("ord")).collect()) == [1, 4]
    assert sorted(r["ord"] for r in dedup.best_by(rows, ["key"], F.col("score"), F.col("ord")).collect()) == [2, 4]
    packed = sequence.greedy_batches(rows, "key", "ord", "score", 10, 2).collect()
    assert sorted((r["ord"], r["batch"]) for r in packed) == [(1, 0), (2, 1), (3, 2), (4, 0)]
