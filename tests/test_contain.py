import random

from tallyloom.functions import text
from tallyloom.operators import contain


def words(rng, n):
    return " ".join(rng.choice(["the", "red", "blue", "garden", "über", "stone", "日本", "a", "of the"]) for _ in range(n))


def first(t, right, size, least):
    found = [(o, w, r) for r, o, w in right if r and len(r) >= least and t is not None and (t in r or r in t)]
    return min(found) if t and len(t) >= size and found else None


def test_first_contained_in_either_direction(spark):
    rng = random.Random(2)
    left = [words(rng, rng.randrange(1, 7)) for _ in range(200)] + ["the", "a%b_c'd", "ü", "日本", None, "", "x" * 20_000 + " red stone " + "y" * 20_000]
    right = [(words(rng, rng.randrange(1, 9)), k, f"w{k}") for k in range(150)] + [("of", 900, "short"), (None, 901, "n"), ("xa%b_c'dx", 902, "signs"), ("the", 903, "t"), ("xxxx", 904, "long")]
    l = spark.createDataFrame([(t,) for t in left], "text string")
    r = spark.createDataFrame(right, "text string, ord int, what string")
    for short, least in ((4, 1), (4, 4), (1, 1)):
        got = {x.text: (x.ord, x.what, x.other) for x in contain.first_contained(l, r, 4, short, least).collect()}
        assert got == {t: f for t in left if (f := first(t, right, short, least))}
    assert contain.first_contained(l.limit(0), r).collect() == [] and contain.first_contained(l, r.limit(0)).collect() == []


def test_a_part_that_all_texts_share_is_spread(spark):
    l = spark.range(3000).selectExpr("concat('all rights reserved ', id % 1000) as needle")
    r = spark.range(3000).selectExpr("concat('(c) all rights reserved ', id % 700, '.') as hay")
    got = {(x.needle, x.hay) for x in contain.contained(l, r).collect()}
    needles, hay = {f"all rights reserved {k}" for k in range(1000)}, {f"(c) all rights reserved {k}." for k in range(700)}
    assert got == {(n, h) for h in hay for n in {h[4:-1][:k] for k in range(len(h))} & needles}
    assert "NestedLoop" not in contain.contained(l, r)._jdf.queryExecution().toString()


def test_matched_keys(spark):
    fields = [("f1", 1, " Add to cart "), ("f2", 2, "Add to Cart"), ("f3", 3, "<b>Free</b> shipping on all orders"), ("f4", 4, ""), ("f5", 5, None), ("f6", 6, "Our Story"), ("f7", 7, "cart")]
    texts = ["Add to cart", "ADD TO  CART", "shipping on all", "see our story today", "zzz", "  ", None, "car", "Add to cart"]
    got = contain.matched_keys(spark.createDataFrame([(t,) for t in texts], "text string"), spark.createDataFrame(fields, "id string, ord int, english string"), text.normal_form)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("Add to cart", "f1", "exact"), ("ADD TO  CART", "f1", "normalized"), ("shipping on all", "f3", "substring"), ("see our story today", "f6", "substring"), ("zzz", None, None), ("car", None, None)], key=repr
    )


def test_suffix_join(spark):
    keys = [("ingredient.rose", 2, "a"), ("benefit.rose", 1, "b"), ("x.y.z", 3, "c"), ("rose", 0, "d"), ("t.", 4, "e"), (None, 5, "f"), ("q.a+b", 6, "g")]
    handles = ["rose", "y.z", "z", "", None, "none", "a+b", "x.y.z"]
    got = contain.by_suffix(spark.createDataFrame(keys, "key string, ord int, what string"), spark.createDataFrame([(h,) for h in handles], "handle string")).collect()
    want = {}
    for h in handles:
        found = [(o, k, w) for k, o, w in keys if h and k and k.endswith("." + h)]
        if found:
            want[h] = min(found)[1:]
    assert {r.handle: (r.key, r.what) for r in got} == want


def test_store_matches(spark):
    rng = random.Random(5)
    left = [(k, k, f"h{rng.randrange(40)}" if k % 9 else None, words(rng, rng.randrange(0, 5)).title() or None) for k in range(120)] + [(500, 500, "only", "zzz yyy"), (501, 501, "", "qq")]
    right = [(1000 + k, 200 - k, f"h{rng.randrange(60)}", words(rng, rng.randrange(1, 4))) for k in range(60)] + [(2000, 300, "e", "")]
    handles = [(f"h{k}", f"h{(k * 7) % 70}" if k % 4 else "") for k in range(0, 40, 2)]
    for more in (right, right[:-1]):
        got = contain.store_matches(spark.createDataFrame(left, "id int, ord int, handle string, title string"), spark.createDataFrame(more, "id int, ord int, handle string, title string"), spark.createDataFrame(handles, "old string, new string"))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(by_hand(left, more, dict(handles)), key=repr)


def by_hand(left, right, handles):
    in_order = sorted(right, key=lambda r: r[1])
    dest, seen, out = {h or "": i for i, _, h, _ in in_order}, set(), []
    for i, _, handle, title in sorted(left, key=lambda r: r[1]):
        handle, title, hit, step = handle or "", (title or "").lower(), None, None
        new = handles.get(handle)
        if new:
            hit, step = dest.get(new), "mapped"
            if new in seen:
                continue
            seen.add(new)
        if hit is None:
            hit, step = dest.get(handle), "handle"
            if hit is not None:
                if handle in seen:
                    continue
                seen.add(handle)
        if hit is None:
            hit = next((j for j, _, _, t in in_order if len(set(title.split()) & set(t.lower().split())) >= 2 or title in t.lower() or t.lower() in title), None)
            step = "title" if hit is not None else None
        out.append((i, hit, step))
    return out


def test_lookup_verdict_has_a_third_step(spark):
    from tallyloom.functions import classify

    site = spark.createDataFrame([("Free shipping on orders", ["/a", "/b"]), ("Our story", ["/c"]), ("abc", ["/d"])], "text string, pages array<string>")
    values = ["Free shipping on orders", "free  SHIPPING on orders", "shipping on", "this is our story today", "abcd", "abc", "", "https://x.y", "nothing here", None]
    got = contain.lookup_verdict(spark.createDataFrame(list(enumerate(values)), "k int, v string"), "v", site, text.normal_form, classify.is_no_display_text, pages=1)
    assert [tuple(r)[2:] for r in sorted(got.select("k", "v", "verdict", "match_type", "pages", "matched_text").collect())] == [
        ("visible", "exact", ["/a"], None), ("visible", "normalized", ["/a"], None), ("visible", "substring", ["/a"], "Free shipping on orders"), ("visible", "substring", ["/c"], "Our story"),
        ("not_visible", None, None, None), ("visible", "exact", ["/d"], None), ("empty", None, None, None), ("non_text", None, None, None), ("not_visible", None, None, None), ("empty", None, None, None),
    ]
