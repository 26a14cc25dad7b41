from collections import Counter

import numpy as np

from tallyloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, value string, `rank` int, _lang int, `a.b` int"


def terms_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [x for x in "".join(c if "a" <= c <= "z" or ord(c) > 127 else " " for c in low).split(" ") if x]


def plain(rows, min_docs=3, top=200):
    groups, docs_with = {}, {}
    for text, lang, source in rows:
        lang, source, terms = lang or "", source or "", terms_of(text)
        groups.setdefault(lang, {}).setdefault(source, Counter()).update(terms)
        docs_with.setdefault(lang, Counter()).update(set(terms))
    out = []
    for lang, own in groups.items():
        kept = [t for t, n in docs_with[lang].items() if n >= min_docs]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}  # noqa: E731, B023
        p, q = {s: share(c) for s, c in own.items()}, share(sum(own.values(), Counter()))
        f = lambda a, b: (a - b) * (a - b) // b
        for s in own:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in own if o != s))
            words = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if own[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, i.decode(), -v, k + 1) for part, items in (("pair", pairs), ("term", words)) for k, (v, i) in enumerate(items)]
    return sorted(out)


def rows_of(n=300):
    words = ["House", "tree", "garden", "Été", "straße", "x9y", "日本語", "the", "of", "a"]
    rows = [(" ".join(words[(k * j + j * j + k // 7) % len(words)] for j in range(k % 19)) + f" rare{'abcdefghij'[k % 10]}", ["en", "de", None, ""][k % 4], [f"s{k % 5}", None, "é"][k % 3]) for k in range(n)]
    return [*rows, (None, "en", "s0"), ("", "xx", "only"), ("two words", "yy", "p"), ("", "yy", "q"), (None, None, None), rows[5], rows[5]]


def frame(spark, rows):
    return spark.createDataFrame([(k, *r, "v", 1, 2, 3) for k, r in enumerate(rows)], SCHEMA).repartition(5)


def test_against_a_plain_version(spark):
    rows = rows_of()
    for how in ({}, {"min_docs": 1, "top": 3, "block_terms": 2}):
        got = sorted(map(tuple, divergence.audit(frame(spark, rows), **how).collect()))
        assert got == plain(rows, how.get("min_docs", 3), how.get("top", 200))


def test_small_tasks_slices_and_tiles_give_the_same(spark, monkeypatch):
    rows = [*rows_of(60), (" House garden" * 400_000, "en", "s1")]  # a text of five MB
    want = plain(rows)
    assert sorted(map(tuple, divergence.audit(frame(spark, rows)).collect())) == want
    assert [t for part in divergence.term_slices(b"Ab c9d " * 400_000) for t in part] == [b"ab", b"c", b"d"] * 400_000
    p = np.random.default_rng(1).integers(1, 10**9, (37, 50))
    whole = divergence.differences(p[:, None, :], p[None, :, :]).sum(-1)
    for cells in (1, 40, 1000, 1 << 21):
        monkeypatch.setattr(divergence, "TILE_CELLS", cells)
        assert (divergence.pair_sums(p) == whole).all()


def test_shares_are_exact_at_any_size():
    for total, kinds in ((0, 1), (10**15, 10**6), (7 * 10**15, 3)):
        counts = [0, 1, total // 3, total]
        assert divergence.shares(np.array(counts), total, kinds).tolist() == [1 + 10**9 * (c + 1) // (total + kinds) for c in counts]


def test_a_source_of_a_third_and_an_empty_table(spark):
    rows = [(f"the w{'abcdefgh'[k % 8]} the", "en", "hot" if k % 3 else f"s{k % 9}") for k in range(400)]
    assert sorted(map(tuple, divergence.audit(frame(spark, rows)).collect())) == plain(rows)
    assert divergence.audit(frame(spark, rows).limit(0)).collect() == []
    assert divergence.audit(frame(spark, [(None, None, None)])).collect() == []
