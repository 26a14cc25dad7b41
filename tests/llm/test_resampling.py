import hashlib
import math
import zlib
from collections import Counter

from tallyloom.llm import resampling

SCHEMA = "doc_id long, text string, rank int, weight string, _row int, _place int, `a.b` int"
LETTERS = set("abcdefghijklmnopqrstuvwxyz0123456789")
TARGET = ["alpha beta gamma alpha", "beta delta 7", None, "", "étude alpha"]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c in LETTERS or ord(c) > 127 else " " for c in low).split(" ")


def features(text, max_n):
    w = [x for x in words(text) if x]
    return w, [" ".join(w[k : k + n]) for n in range(1, max_n + 1) for k in range(len(w) - n + 1)]


def plain(rows, target, max_n, buckets, min_words, percent, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, features(text, max_n)[1]))
    for text in target:
        t.update(map(bucket, features(text, max_n)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets)))) for b in s}
    out = []
    for i, text in rows:
        w, f = features(text, max_n)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x)] for x in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= min_words])
    drawn = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = drawn[: percent * len(drawn) // 100]
    return sorted([(x[0] is None, x[0] or 0, *x[1:4], y) for x, y in ((x, next((k + 1 for k, d in enumerate(drawn) if d is x), None)) for x in out)], key=repr)


def rows_of():
    kinds = ["alpha", "Beta", "gamma", "delta", "Étude", "straße", "x7", "don't", "日本語", "the"]
    rows = [(k, " ".join(kinds[(k * j + j * j) % len(kinds)] for j in range(k % 23)) + ("!\n" if k % 3 else "")) for k in range(80)]
    return [*rows, (80, None), (81, ""), (82, " ..\t"), (3, rows[3][1]), (3, rows[3][1]), (None, "alpha beta " * 9), (None, None), (83, "Alpha\x00beta")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA).repartition(3)


def held(spark, rows, **how):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = resampling.resample(frame(spark, rows), target, **how).collect()
    return sorted([(r[0] is None, r[0] or 0, r[1], r[2], r[3], r[4]) for r in got], key=repr)


def test_against_a_plain_version(spark):
    for max_n, buckets, min_words, percent in ((1, 10_000, 5, 30), (3, 17, 1, 100)):
        rows = rows_of()
        got = held(spark, rows, max_n=max_n, buckets=buckets, min_words=min_words, percent=percent)
        want = plain(rows, TARGET, max_n, buckets, min_words, percent)
        # rows that repeat share score and id, so their ranks may change places
        assert [x[:5] for x in got] == [x[:5] for x in want]
        assert sorted(x[5] for x in got if x[5]) == sorted(x[5] for x in want if x[5])
        once = Counter(x[:2] for x in got)
        assert [x for x in got if once[x[:2]] == 1] == [x for x in want if once[x[:2]] == 1]


def test_long_texts_are_cut_between_words_and_lose_no_feature(spark, monkeypatch):
    text = b"one two, three four-five six seven \xc3\xa9t\xc3\xa9 eight nine ten " * 40
    for max_n in (1, 2, 4):
        whole = Counter(features(text.decode(), max_n)[1])
        pieces = list(resampling.cut(text, max_n, 50))
        assert len(pieces) > 20
        cut = Counter()
        for piece, extra in pieces:
            w = features(piece.decode(), 1)[0]
            cut.update(" ".join(w[k : k + n]) for n in range(1, max_n + 1) for k in range(len(w) - extra) if k + n <= len(w))
        assert cut == whole
    rows = [(1, "alpha beta gamma " * 600_000), (2, "alpha " * 30), (3, "beta")]
    for max_n in (1, 2):
        assert held(spark, rows, max_n=max_n) == plain(rows, TARGET, max_n, 10_000, 20, 10)


def test_a_word_and_a_text_in_a_third_of_all_rows(spark):
    rows = [(k, "the same alpha words " * 6) if k % 3 == 0 else (k, f"the w{k} v{k % 7} alpha " * 6) for k in range(300)]
    assert held(spark, rows) == plain(rows, TARGET, 1, 10_000, 20, 10)


def test_empty_tables(spark):
    target = spark.createDataFrame([], "text string")
    assert resampling.resample(frame(spark, rows_of()).limit(0), target).collect() == []
    got = resampling.resample(frame(spark, rows_of()), target, min_words=1, percent=50).collect()
    want = plain(rows_of(), [], 1, 10_000, 1, 50)
    assert sorted([(r[0] is None, r[0] or 0, *r[1:4]) for r in got], key=repr) == [x[:5] for x in want]
