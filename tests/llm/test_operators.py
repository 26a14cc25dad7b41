import hashlib
import math
import random


import pytest

from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.packing_check import check_packing
from tallyloom.llm import components, exact_dedup, language_id, line_dedup, lm_scoring, mixing, nearest, packing, queries, simhash, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _key int, score double, kept string, size int, `a.b` int"
WORDS = ["the", "of", "and", "House", "garden", "tree", "river,", "stone.", "wind", "é", "straße", "naïve", "x", "10"]


def texts(seed=1, n=60):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    near = [t.replace("tree", "bush", 1) for t in base[:10]]
    lines = ["\n".join([t, "  All rights Reserved ", str(k), ""]) for k, t in enumerate(base[10:24])]
    return [*base, *near, *base[:7], *lines, None, "", " \t\n", "...", "word " * 5000, "z" * 9000, "Übung\x00macht", "A b", "日本語 テキスト"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(k, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None, "a"]), None) for k, t in enumerate(texts())]
    out += [out[3], out[3], (None, "a text without an id", "en", None, 1), (None, None, None, None, None), (5, "another text of five", "de", "b", 2)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "q", 1, 2.0, "w", 3, 4) for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def digest(data):
    return hashlib.sha256(data).hexdigest()


def test_exact_dedup(docs, rows, empty):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    for keep, best in (("largest", max), ("smallest", min)):
        got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_dedup(docs, keep=keep, fan_in=2).collect()]
        want = []
        for t, ids in groups.items():
            chosen = best((i for i in ids if i is not None), default=None)
            want += [(i, chosen, len(ids), i == chosen, digest(t.encode())) for i in ids]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(empty).collect() == []
    kept = exact_dedup.survivors(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_exact_dedup_merges_sorted_runs(docs):
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert "SortAggregate" in plan and "HashAggregate" not in plan and "shufflepartitionidpassthrough" in plan


def test_line_dedup(docs, rows, empty):
    for least in (10, 3):
        got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_dedup.dedup_lines(docs, min_docs=least).collect())
        keys = [[brute.ascii_lower(x.strip(brute.BLANKS)) for x in (t or "").split("\n")] for _, t, *_ in rows]
        often = {}
        for own in keys:
            for k in set(own):
                often[k] = often.get(k, 0) + 1
        want = []
        for (i, t, *_), own in zip(rows, keys, strict=True):
            stay = [line for line, k in zip((t or "").split("\n"), own, strict=True) if not (k and often[k] >= least)]
            want.append((-1 if i is None else i, len(own), len(own) - len(stay), "\n".join(stay)))
        assert got == sorted(want)
    assert line_dedup.dedup_lines(empty).collect() == []


def test_mixing(docs, rows, empty):
    got = mixing.mix_documents(docs, block=4, shard_blocks=8).collect()
    assert len(got) == len(rows)
    again = mixing.mix_documents(docs.repartition(3), block=4, shard_blocks=8).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    names = sorted(x for x in sizes if x is not None) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, rest, total = {}, set(names), 1.5 * sum(sizes.values())
    while rest:  # excess is shared again until no target is above its stop
        level = (total - sum(target.values())) / sum(weight[s] for s in rest)
        over = {s for s in rest if level * weight[s] > 2 * sizes[s]}
        target |= {s: 2 * sizes[s] if s in over else level * weight[s] for s in (over or rest)}
        rest -= over or rest
    by_id = {}
    for r in got:
        assert r["taken"] <= 2 * r["size"]
        by_id.setdefault(r["doc_id"], []).append(r)
    taken = {}
    for i, t, _, s, _ in rows:
        r = next(x for x in by_id[i] if x["size"] == len(brute.words(t)) and x["source_size"] == sizes[s])
        assert math.isclose(r["target"], target[s])
        by_id[i].remove(r)
        taken[s] = taken.get(s, 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= 2 * 4 for s in names)
    assert mixing.mix_documents(empty).collect() == []
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns and 0 < mix.count() <= 2 * len(rows)
    assert mixing.mixed(empty).collect() == []


def test_mixing_draws_counts_of_shards(spark):
    sources = spark.createDataFrame([("a", 50_000), ("b", 700), (None, 3), ("c", 0)], "_source string, _takes long")
    rows = mixing.shard_counts(sources, 4, 1).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.shard_counts(sources.repartition(3), 4, 1).collect()), key=repr)
    for source, takes in (("a", 50_000), ("b", 700), (None, 3)):
        own = sorted((r["_shard"], r["_first_take"], r["_count"]) for r in rows if r["_source"] == source)
        at = 0
        for shard, first, n in own:
            assert first == at and n > 0 and 0 <= shard < 16
            assert abs(n - takes / 16) < 6 * math.sqrt(takes / 16) + 3
            at += n
        assert at == takes
    assert not [r for r in rows if r["_source"] == "c"]
    large = [r["h"] for r in spark.range(2000).select(mixing.heads(F.lit(10**6).cast("long"), F.col("id")).alias("h")).collect()]
    small = [r["h"] for r in spark.range(2000).select(mixing.heads(F.lit(100).cast("long"), F.col("id")).alias("h")).collect()]
    for drawn, n in ((large, 10**6), (small, 100)):
        mean = sum(drawn) / 2000
        assert abs(mean - n / 2) < 5 * math.sqrt(n / 4 / 2000)
        assert 0.9 < sum((x - mean) ** 2 for x in drawn) / 2000 / (n / 4) < 1.1


def test_mixing_draws_follow_the_binomial_law(spark):
    """Chi-square over ranges of about equal probability, for numbers of throws beyond those that are counted."""
    for n in (1_000_000, 1_000_001, 1_999):
        drawn = [r["h"] for r in spark.range(20_000).select(mixing.heads(F.lit(n).cast("long"), F.col("id"), F.lit(n)).alias("h")).collect()]
        low = range(max(0, n // 2 - 4000), min(n, n // 2 + 4000) + 1)
        log = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) - n * math.log(2) for k in low]
        bounds, chance, total = [], [], 0.0
        for k, x in zip(low, log, strict=True):
            total += math.exp(x)
            if total >= 0.05 and len(bounds) < 19:
                bounds.append(k)
                chance.append(total)
                total = 0.0
        chance.append(1 - sum(chance))
        seen = [0] * len(chance)
        for x in drawn:
            seen[sum(x > b for b in bounds)] += 1
        chi = sum((o - 20_000 * p) ** 2 / (20_000 * p) for o, p in zip(seen, chance, strict=True))
        assert chi < 45  # 19 degrees of freedom: 0.9993 lie below


def test_mixing_counts_whole_passes_without_slots(spark):
    docs = spark.createDataFrame([(k, "w " * (1 + k % 90), "a" if k % 3 else "b") for k in range(300)] + [(900, "v " * 2_500_000, "b")], "doc_id long, text string, source string")
    _, targets, shards = mixing.mix_plan(docs, total_share=1.5, max_repeats=2.0)
    every = mixing.slots(shards).groupBy("_source", "_block").count().collect()
    broken = {(r[0], r[1]): r[2] for r in mixing.slots(shards, True).groupBy("_source", "_block").count().collect()}
    about = {r["_source"]: (r["_takes"] // r["_blocks"], r["_takes"] % r["_blocks"]) for r in targets.collect()}
    assert any(whole for whole, _ in about.values()) and set(broken.values()) == {1}
    assert {(r[0], r[1]): r[2] for r in every} == {(s, b): n for s, (whole, _) in about.items() for b in {r[1] for r in every if r[0] == s} if (n := whole + broken.get((s, b), 0))}
    assert {s: sum(n for (x, _), n in broken.items() if x == s) for s in about} == {s: rest for s, (_, rest) in about.items()}
    got = mixing.mix_documents(docs).collect()
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    for s in about:
        own = [r for r in got if (900 if r["doc_id"] == 900 else r["doc_id"] % 3 and "a" or "b") in (s, 900 if s == "b" else s)]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 128


def test_packing(docs, rows, empty):
    path = queries.tokenizer_path()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ids = {}
    odd = "It's o'clock x's. İstanbul, ÅNGSTRÖM! a1b2 ½ tab\there\r\nx ﬁne éa naïve，全角 ΣΑΣ. (q) r$$$%%% w.　x. \x1cb.\x1cc İ. ́a. b́. d.e f.' g.'s ×. y”."
    unique = [(k, t) for k, (_, t, *_) in enumerate(rows)] + [(1000, odd)]
    for i, t in unique:
        ids[i] = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    table = docs.sparkSession.createDataFrame(unique, "doc_id long, text string").repartition(6)
    for window, open_windows in ((2048, 16), (32, 2)):
        pieces = [r.asDict() for r in packing.pack_documents(table, path, window=window, open_windows=open_windows, merge_parts=4).collect()]
        padding, sequences = check_packing(pieces, ids, window)
        assert padding <= 0.02 * window * sequences
    assert packing.pack_documents(empty, path).collect() == []
    assert packing.pack_documents(docs, path).select(F.sum(F.when(F.col("start") == 0, 1).otherwise(0))).first()[0] == len(rows)


def test_suffix_dedup(spark, docs, rows, empty, monkeypatch):
    rng = random.Random(7)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(20, 70))) for _ in range(6)]
    made = ["a" * 300, "ab" * 90, "é" * 40, "x\x00" * 30 + "\x00" * 40]
    for _ in range(60):
        made.append("".join(rng.choice(passages)[rng.randrange(8) : rng.randrange(20, 70)] if rng.random() < 0.5 else "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 50))) for _ in range(rng.randrange(1, 8))))
    for data, match, gram in ((texts(), 200, 32), (made, 40, 8)):
        table = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(3)
        raw = [(t or "").encode() for t in data]
        want = brute.repeated_bytes(raw, match)
        for how in ({"per_merge": 50}, {"per_merge": 10, "fan": 3, "merged_runs": 2, "piece": 4 * match}):
            monkeypatch.setattr(suffix_dedup, "RUN", 50_000 if len(how) == 1 else 30)
            got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(table, match=match, gram=gram, **how).collect()}
            for k, (b, flags) in enumerate(zip(raw, want, strict=True)):
                stay = bytes(c for c, f in zip(b, flags, strict=True) if not f)
                assert (got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], bytes(got[k]["kept"])) == (len(b), sum(flags), brute.runs(flags), stay)
    assert suffix_dedup.remove_repeats(docs).count() == len(rows)
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_suffix_dedup_with_a_hot_gram(spark, monkeypatch):
    rng = random.Random(11)
    footer = "All of this is under the licence of the house and its garden."  # under 200 bytes, so nothing of it alone repeats
    other = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(150, 300))) for _ in range(60)]
    data = [a + footer + b for a, b in zip(other, other[::-1], strict=True)] + [other[0] + footer + "x" * 90, other[3], None, "y" * 700]
    table = spark.createDataFrame([*enumerate(data), (0, data[0])], "doc_id long, text string").repartition(3)
    most = []

    def runs(match, gram, targets, width, make=suffix_dedup._make_runs):
        most.append(targets)
        return make(match, gram, targets, width)

    monkeypatch.setattr(suffix_dedup, "_make_runs", runs)
    for hot, piece in ((20, 1 << 18), (10**6, 1 << 18), (20, 230)):
        got = sorted((r["doc_id"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(table, per_merge=20, hot=hot, piece=piece).collect())
        every = [*data, data[0]]
        raw = [(t or "").encode() for t in every]
        want = []
        for k, (b, flags) in enumerate(zip(raw, brute.repeated_bytes(raw, 200), strict=True)):
            want.append((k % len(data), sum(flags), brute.runs(flags), bytes(c for c, f in zip(b, flags, strict=True) if not f)))
        assert got == sorted(want)
    assert most[0] < most[1]  # the footer's places did not go to merging tasks


def test_suffix_dedup_with_long_texts(spark):
    rng = random.Random(6)
    noise = "".join(rng.choice("abcdefgh ") for _ in range(600_000))
    data = [(1, "a" * 2_000_000), (2, noise), (3, noise[100_000:100_300] + "xyz" + noise[500_000:500_150])]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: (2_000_000, 2_000_000, 1), 2: (600_000, 300, 1), 3: (453, 300, 1)}


def test_loser_tree():
    import numpy as np

    rng = random.Random(2)
    for k in range(1, 8):
        keys = [sorted({bytes(rng.choice(b"ab") for _ in range(9)) for _ in range(rng.randrange(1, 30))}) for _ in range(k)]
        runs = [suffix_dedup.Run(*suffix_dedup.Run.coded(np.frombuffer(b"".join(own), np.uint8).reshape(-1, 9)), 9) for own in keys]
        out = list(suffix_dedup.merged(runs))
        assert [x[2] for x in out] == sorted(x for own in keys for x in own)
        for a, b in zip(out, out[1:], strict=False):
            assert b[3] == next((n for n in range(9) if a[2][n] != b[2][n]), 9)


def test_simhash(spark, docs, rows, empty):
    got = simhash.near_duplicates(docs, shingle=3, words=1, max_diff=3).collect()
    prints = {k: brute.simhash(t, 3) for k, (_, t, *_) in enumerate(rows)}
    found = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    groups = {}
    for k, root in found.items():
        groups.setdefault(root, []).append(k)
    want = []
    for own in groups.values():
        least = min((rows[k][0] for k in own if rows[k][0] is not None), default=None)
        want += [(rows[k][0], f"{prints[k]:016x}", least) for k in own]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    split = simhash.near_duplicates(docs, shingle=3, words=1, max_diff=3, hot=2).collect()
    assert sorted(map(tuple, split), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(empty).collect() == []
    kept = simhash.survivors(docs)
    assert kept.columns == docs.columns
    assert 0 < kept.count() <= len({t for _, t, *_ in rows})
    assert simhash.survivors(empty).collect() == []


def test_simhash_finds_near_copies(spark):
    rng = random.Random(9)
    base = [[f"w{rng.randrange(5000)}" for _ in range(200)] for _ in range(80)]
    near = [[*w[:100], "changed", *w[101:]] for w in base]
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(base + near)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(table).collect()}
    assert all(got[k + 80] == got[k] == k for k in range(80))


def test_near_duplicates_at_the_similarity_are_found_and_others_left(spark):
    """Pairs of Jaccard similarity 0.8 and just over, and pairs of 0.7 to 0.79."""
    rng = random.Random(21)
    data, want = [], {}
    for k in range(300):
        w = [f"w{rng.randrange(9000)}" for _ in range(300)]
        changed, least = list(w), 0.8 if k % 3 else 0.7
        while True:
            before = list(changed)
            changed[rng.randrange(300)] = f"v{rng.randrange(9000)}"
            one, other = ({tuple(x[j : j + 5]) for j in range(296)} for x in (w, changed))
            if len(one & other) / len(one | other) < least:
                changed = before
                break
        one, other = ({tuple(x[j : j + 5]) for j in range(296)} for x in (w, changed))
        want[2 * k] = len(one & other) / len(one | other)
        data += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(changed))]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    linked = [got[k + 1] == k for k, j in want.items() if j >= 0.8]
    assert sum(linked) >= 0.95 * len(linked)
    assert not any(got[k + 1] == k for k, j in want.items() if j < 0.8)


def test_gray_index_with_dense_groups():
    import numpy as np

    rng = random.Random(3)
    for words, limit in ((1, 3), (2, 9)):
        codes = {rng.getrandbits(64 * words) for _ in range(40)}
        for _ in range(300):
            x = rng.choice(sorted(codes))
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64 * words)
            codes.add(x)
        codes = sorted(codes)
        table = np.array([[x >> 64 * (words - 1 - w) & (1 << 64) - 1 for w in range(words)] for x in codes], np.uint64)
        a, b = simhash.GrayIndex(np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64), table).links(limit)
        linked = set(zip(a.tolist(), b.tolist(), strict=True))
        got = brute.components({k: k for k in range(len(codes))}, lambda p, q: (p, q) in linked or (q, p) in linked)
        want = brute.components(dict(enumerate(codes)), lambda p, q: (p ^ q).bit_count() <= limit)
        assert got == want


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (95, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_nearest(spark):
    rng = random.Random(5)
    vectors = [[rng.gauss(0, 1) + (k % 4) * 3 for _ in range(16)] for k in range(400)]
    data = list(enumerate(vectors)) + [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [None] * 16), (404, [1.0, 2.0]), (405, []), (50, vectors[50]), (406, vectors[50]), (407, vectors[50]), (None, vectors[1]), (50, vectors[60]), *[(k, vectors[100]) for k in range(500, 560)]]
    table = spark.createDataFrame([(*x, 1.0, 2) for x in data], "vec_id long, embedding array<double>, score double, rank int").repartition(3)
    good = [(i, tuple(v)) for i, v in data if i is not None and v and len(v) == 16 and None not in v and all(map(math.isfinite, v)) and any(v)]
    for block, chunk in ((90, 3), (5000, 5000)):
        got = nearest.nearest_neighbours(table, F.col("vec_id") % 50 == 0, projected=8, block=block, query_chunk=chunk).collect()
        hit = total = 0
        for at, (i, v) in enumerate(good):
            if i % 50 == 0:
                want = sorted((brute.distance(v, w), j) for k, (j, w) in enumerate(good) if k != at)[:10]
                own = [(r["score"], r["vec_id"]) for r in got if r["query_id"] == i]
                hit += sum(any(math.isclose(d, e) and j == k for e, k in own) for d, j in want)
                total += 10
        assert len(got) == total and hit >= 0.9 * total
        assert {r["rank"] for r in got} == set(range(1, 11))
    assert nearest.nearest_neighbours(table.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    few = nearest.nearest_neighbours(table.filter("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert [r["vec_id"] for r in few] == [j for _, j in sorted((brute.distance(vectors[0], vectors[j]), j) for j in (1, 2))]


def test_nearest_looks_at_half_of_all_vectors_at_most(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]
    import numpy as np

    ids, vectors = np.array([i for i, _ in data]), np.array([v for _, v in data], np.float64)
    for block, most in ((nearest.BLOCK, 0.5), (300, 0.75)):  # small trees know little of how near the nearest are
        got = nearest.nearest_neighbours(table, F.col("vec_id") % 100 == 0, block=block).collect()
        found, seen = {}, {}
        for r in got:
            found.setdefault(r["query_id"], set()).add(r["vec_id"])
            seen[r["query_id"]] = r["n_verified"]
        hits = []
        for q, own in found.items():
            far = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
            far[ids == q] = np.inf
            hits.append(len(own & set(ids[np.lexsort((ids, far))[:10]].tolist())) / 10)
        assert len(found) == sum(i % 100 == 0 for i, _ in data)
        assert sum(hits) / len(hits) >= 0.9
        assert sum(seen.values()) / len(seen) <= most * len(data)


def test_lm_scoring(spark, docs, rows, empty, monkeypatch):
    """Against the definition, with chunks of a few documents and few classes."""
    import zlib

    import xxhash

    rng = random.Random(5)
    fill = [" ".join(f"w{int(rng.random() ** 2 * 300)}" for _ in range(40)) for _ in range(100)]
    texts = [*fill, "The quoxan runs", "the quoxan runs", "the blivan runs", "the blivan runs far", "of the of the of the", "  ", None]
    table = spark.createDataFrame([*enumerate(texts), (100, texts[100]), (None, "the blivan")], "doc_id long, text string").repartition(3)
    chosen = [*range(30), 100, 101]
    frequent, endings, prior, floor = 20, 8, 50.0, 0.5
    held = [(r["doc_id"], [w.encode() for w in brute.words(brute.ascii_lower(r["text"] or ""))]) for r in table.collect()]
    once = [{}, {}]
    for i, w in held:
        for k in (0, 1):
            if k or i in chosen:
                for x in w:
                    once[k][x] = once[k].get(x, 0) + 1
    signed = lambda w: (h := xxhash.xxh3_64_intdigest(w)) - (h >> 63 << 64)
    own = sorted(once[1], key=lambda w: (-once[1][w], signed(w)))[:frequent]
    code = {w: 1 + endings + own.index(w) if w in own else 1 + zlib.crc32(w[-2:]) % endings for w in once[1]}
    size = 1 + endings + frequent
    pairs = [[[0] * size for _ in range(size)] for _ in (0, 1)]
    for i, w in held:
        for k in (0, 1):
            if k or i in chosen:
                for x, y in zip([0, *[code[z] for z in w]], [code[z] for z in w], strict=False):
                    pairs[k][x][y] += 1
    scale = sum(once[0].values()) / sum(once[1].values())

    def loss(w, k):
        s, total = (scale if k else 1.0), 0.0
        column = [sum(row[c] for row in pairs[k]) * s + floor for c in range(size)]
        for x, z in zip([0, *[code[z] for z in w]], w, strict=False):
            c = code[z]
            total -= math.log2((pairs[k][x][c] * s + prior * column[c] / sum(column)) / (sum(pairs[k][x]) * s + prior))
            if c <= endings:
                mates = [v for v in once[1] if code[v] == c]
                total -= math.log2((once[k].get(z, 0) * s + floor) / (sum(once[k].get(v, 0) for v in mates) * s + floor * (len(mates) + 1)))
        return total / max(len(w), 1)

    want = sorted((str(i), len(w), round(loss(w, 0), 4), round(loss(w, 1), 4)) for i, w in held)
    target = spark.createDataFrame([(k,) for k in [*chosen, None, 999]], "doc_id long")
    for chunk, listed in ((600, 40), (1 << 20, 20)):
        monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", chunk)
        models = lm_scoring.fit(table, target, frequent=frequent, endings=endings, listed=listed)
        got = lm_scoring.score(table, models).collect()
        assert sorted((str(r[0]), r[1], round(r[2], 4), round(r[3], 4)) for r in got) == want
        assert all(math.isclose(r["score"], r["loss_background"] - r["loss_target"], abs_tol=1e-9) for r in got)
    one, other = (next(r["score"] for r in got if r["doc_id"] == k) for k in (101, 102))
    assert one > other
    everything = lm_scoring.score(docs, models).collect()
    assert len(everything) == len(rows) and all(math.isfinite(r["score"]) for r in everything)
    assert {r["score"] for r in everything if not r["n_tokens"]} == {0.0}
    assert lm_scoring.score(empty, lm_scoring.fit(empty, target)).collect() == []
    assert len(lm_scoring.score(docs, lm_scoring.fit(empty, target)).collect()) == len(rows)


def test_lm_scoring_tells_held_out_labels(spark):
    got = queries.op9_lm_scoring(spark, "/root/testdata/sf0.1").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").filter("quality is not null")
    scored = sorted((r["score"], r["quality"]) for r in got.join(labels.dropDuplicates(["doc_id"]), "doc_id").select("score", "quality").collect())
    good = sum(q for _, q in scored)
    below = ranks = 0
    for _, q in scored:
        ranks += below if q else 0
        below += 0 if q else 1
    assert ranks / (good * (len(scored) - good)) > 0.95


def test_language_id(spark, docs, rows, empty):
    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = language_id.fit(sf.filter(~queries.held_out(3, 1)))
    tried = sf.filter(queries.held_out(3, 1) & (F.length("text") > 30))
    right = tried.join(language_id.predict(tried, profiles), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    told = language_id.predict(docs, profiles).collect()
    assert len(told) == len(rows) and all(0 <= r["score"] <= 1 for r in told)
    unknown = {r["doc_id"] for r in told if r["lang_pred"] == "und"}
    assert {i for i, t, *_ in rows if not any(c.isalpha() for c in t or "")} == unknown
    assert language_id.predict(empty, profiles).collect() == []
    assert {r["lang_pred"] for r in language_id.predict(docs, language_id.fit(empty)).collect()} == {"und"}


def test_toxicity(spark, docs, rows, empty):
    sf = "/root/testdata/sf0.1"
    table, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    known = table.join(labels.select("doc_id", "toxic"), "doc_id")
    lexicon = toxicity.fit(table, labels.filter(~queries.held_out(5, 0)))
    tried = known.filter(queries.held_out(5, 0))
    counts = tried.join(toxicity.score(tried, lexicon), "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in counts}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85 and n.get((0, 1), 0) <= 0.01 * n[0, 0]
    scored = toxicity.score(docs, lexicon).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)
    assert toxicity.score(empty, lexicon).collect() == []
    assert toxicity.fit(empty, labels.limit(0)).weights == {}
    word = max(lexicon.weights, key=lexicon.weights.get)
    disguised = word.replace("o", "0").replace("i", "1").replace("a", "а")
    assert toxicity.fold(disguised) == word
    guarded = toxicity.Matcher(toxicity.Lexicon({"trash": 2.0}, ("trash can", "no trash at all")))
    assert guarded.hits("a trash here") and not guarded.hits("the trash can here") and not guarded.hits("trashy") and not guarded.hits("no trash at all")
    assert len(guarded.hits("trash can trash " * 50_000)) == 50_000


def test_toxicity_learns_exceptions_and_agrees_with_a_plain_version(spark):
    rng = random.Random(12)
    fill = ["".join(rng.choice("bcdfg") for _ in range(5)) for _ in range(60)]
    data, labels = [], []
    for k in range(400):
        w = [rng.choice(fill) for _ in range(30)]
        toxic = int(k % 4 == 0)
        if toxic:
            w[rng.randrange(30)] = rng.choice(["zork", "z0rk", "ZORK"])
            w[rng.randrange(30)] = "blarg"
        elif k % 40 == 1:  # a lexicon word that does no harm here
            at = rng.randrange(29)
            w[at : at + 2] = ["zork", "salad"]
        data.append((k, " ".join(w)))
        labels.append((k, toxic))
    table, known = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.fit(table, known)
    assert {"zork", "blarg"} <= set(lexicon.weights) and "zork salad" in lexicon.exceptions
    got = {r["doc_id"]: r for r in toxicity.score(table, lexicon).collect()}
    assert all(got[k]["predicted"] == y for k, y in labels)
    for k, text in data:  # word by word, without an automaton
        w = toxicity._WORD.findall(toxicity.fold(text))
        excused = {p + j for e in lexicon.exceptions for p in range(len(w)) for n in (len(e.split()),) if w[p : p + n] == e.split() for j in range(n)}
        hits = [x for j, x in enumerate(w) if x in lexicon.weights and j not in excused]
        total, distinct = sum(lexicon.weights[x] for x in hits), sum(lexicon.weights[x] for x in set(hits))
        x = (1.0, math.log1p(total), math.log1p(distinct), math.log1p(30))
        assert math.isclose(got[k]["score"], 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, lexicon.model, strict=True)))), rel_tol=1e-9)


def test_language_id_counts_in_slices(monkeypatch):
    import numpy as np

    some = ["ab cd ef gh" * 10, "hello world", "", "日本語 x", "Straße\n12 a", " "] * 3
    whole = language_id.Encoder().bundles(some)
    for name, value in (("SLICE_GRAMS", 7), ("BATCH_CHARS", 37)):
        with monkeypatch.context() as m:
            m.setattr(language_id, name, value)
            part = language_id.Encoder().bundles(some)
        assert np.allclose(whole[0], part[0]) and (whole[1] == part[1]).all()
    # by the definition: the sum over 3-grams of the product of rotated letter vectors
    encode, text = language_id.Encoder(dimensions=64), " ab cb "
    want = np.zeros(64, np.float32)
    points = [ord(c) if c.isalpha() else 0 for c in text]
    for k in range(len(points) - 2):
        vectors = [np.roll(language_id.letter_vectors(np.array([p]), 64, language_id.SEED)[0], 2 - j) for j, p in enumerate(points[k : k + 3])]
        want += vectors[0] * vectors[1] * vectors[2]
    assert np.allclose(encode.bundles(["ab cb"])[0][0], want)


def test_language_id_with_many_languages_and_long_texts(spark):
    rng = random.Random(3)
    letters = [[chr(0x4E00 + 4 * k + j) for j in range(4)] for k in range(600)]
    data = [(600 * j + k, "".join(rng.choice(letters[k]) for _ in range(200)), f"l{k:03}") for k in range(600) for j in range(2)]
    table = spark.createDataFrame([*data, (9999, "abc", None), (9998, None, "l000")], "doc_id long, text string, lang string").repartition(4)
    profiles = language_id.fit(table.filter("doc_id < 600"))
    assert len(profiles.languages) == 600
    told = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(table, profiles).collect()}
    assert sum(told[i] == lang for i, _, lang in data) >= 0.98 * len(data)
    long = spark.createDataFrame([(1, "".join(rng.choice(letters[7]) for _ in range(1000)) * 1000)], "doc_id long, text string")
    assert language_id.predict(long, profiles).first()["lang_pred"] == "l007"


def test_hot_keys_are_spread(spark):
    from tallyloom.llm import shared

    left = shared.durable(spark.createDataFrame([(0 if k % 2 else k, k) for k in range(4000)] + [(None, -1)], "k long, v long"))
    right = spark.createDataFrame([(0, "hot"), (2, "two"), (9999, "none")], "k long, w string")
    for how in ("inner", "left"):
        met = shared.spread_join(left, right, ["k"], how)
        got = sorted((r["k"] if r["k"] is not None else -5, r["v"], r["w"]) for r in met.collect())
        want = [(k if k is not None else -5, v, {0: "hot", 2: "two"}.get(k)) for k, v in map(tuple, left.collect()) if how == "left" or k in (0, 2)]
        assert got == sorted(want)
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in plain.items():
        spark.conf.set(name, value)
    try:
        parts = shared.spread_join(left, right, ["k"]).withColumn("p", F.spark_partition_id())
        assert max(r["count"] for r in parts.groupBy("p").count().collect()) < 1600  # of 2,001 rows of the hot key, over 4 partitions
    finally:
        for name in plain:
            spark.conf.unset(name)


def test_components_with_a_star(spark):
    edges = [(5, k) for k in range(10, 3000)] + [(k, k + 1) for k in range(3000, 3040)] + [(2999, 3000)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == {k: 5 for k in [5, *range(10, 3041)]}


def test_durable_tables_are_listed_and_discarded(spark, tmp_path):
    from tallyloom.llm import shared

    mark = len(shared.written())
    kept = shared.durable(spark.range(5))
    shared.durable(spark.range(3))
    shared.discard(spark, shared.written(mark)[1:])
    assert len(shared.written(mark)) == 1 and kept.count() == 5
    shared.discard(spark, shared.written(mark))
    assert shared.written(mark) == []
