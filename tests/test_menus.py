import random

import pytest

from tallyloom.operators import menus

SCHEMA = "tree int, id int, parent int, pos int, name string, url_key string, product_count int"


def by_hand(rows, collections, skipped, tree, parent=None, above=None):
    out = []
    for r in sorted((r for r in rows if r[0] == tree and r[2] == parent), key=lambda r: r[3]):
        _, i, _, _, name, key, n = r
        children = [x for x in rows if x[0] == tree and x[2] == i]
        if not key or key in skipped or not name:
            out += by_hand(rows, collections, skipped, tree, i, above)
            continue
        c = collections.get(key)
        if not c and not n and not children:
            continue
        out.append((above, i, name, f"gid://shopify/Collection/{c}" if c else None, None if c else f"/collections/{key}"))
        out += by_hand(rows, collections, skipped, tree, i, i)
    return out


def test_menu_against_recursion(spark):
    rng = random.Random(3)
    rows = []
    for tree in (1, 2):
        for k in range(150):
            parent = rng.randrange(max(0, k - 12), k) if k > 3 else None
            name, key = rng.choice(["Skin", "Hair", "", None]) if k % 3 == 0 else f"N{k}", rng.choice(["root", "default", "", None]) if rng.random() < 0.4 else f"key{k % 40}"
            rows.append((tree, k, parent, rng.randrange(1000) * 1000 + k, name, key, rng.choice([0, 0, 3, None])))
    rows += [(3, k, k - 1 if k else None, 0, "", "", 0) for k in range(300)] + [(3, 300, 299, 0, "deep", "deep", 1), (4, 1, 99, 0, "lost parent", "lp", 1)]
    collections = {f"key{k}": 100 + k for k in range(0, 40, 3)}
    got = menus.category_menu(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(list(collections.items()), "url_key string, id int"), ("root", "default")).collect()
    for tree in (1, 2, 3):
        want, mine = by_hand(rows, collections, ("root", "default"), tree), [r for r in got if r.tree == tree]
        assert sorted(map(str, want)) == sorted(str((r.above, r.id, r.title, r.resource_id, r.url)) for r in mine)
        for above in {r.above for r in mine}:
            assert [r.id for r in sorted((r for r in mine if r.above == above), key=lambda r: r.place)] == [w[1] for w in want if w[0] == above]
    assert [(r.id, r.above) for r in got if r.tree == 4] == [(1, None)]
    assert menus.category_menu(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "url_key string, id int")).collect() == []


def test_cycles(spark, monkeypatch):
    monkeypatch.setattr(menus, "MOST_DOUBLINGS", 5)
    rows = [(1, 1, 2, 0, "", "", 0), (1, 2, 1, 0, "", "", 0), (1, 3, 2, 0, "x", "x", 1)]
    with pytest.raises(ValueError, match="cycle"):
        menus.category_menu(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], "url_key string, id int"))
    edges = [(1, k, k - 1 if k else None) for k in range(20)] + [(2, 1, 2), (2, 2, 1), (2, 3, 2), (3, 7, 99)]
    monkeypatch.setattr(menus, "MOST_DOUBLINGS", 8)
    got = {(r.tree, r.id): (r.depth, r.root) for r in menus.depths(spark.createDataFrame(edges, "tree int, id int, parent int")).collect()}
    assert got == {(1, k): (k, 0) for k in range(20)} | {(2, k): (None, None) for k in (1, 2, 3)} | {(3, 7): (0, 7)}
