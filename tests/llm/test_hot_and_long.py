"""A key of a third of all rows, and one text of five megabytes, for the operators whose other tests have neither."""

import hashlib

import pytest

from tests.llm import brute
from tallyloom.llm import exact_dedup, line_dedup, lm_scoring, packing, queries, simhash

LONG = "\n".join(f"line {k % 7000} of a very long text, number {k}" for k in range(120_000))
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def rows():
    hot = [(k, "the very same words in a third of all rows\nand a second line") for k in range(300, 460)]
    own = [(k, f"a text of its own {k} {k * k}\nwith {k % 90} lines\nthe very same words in a third of all rows" if k % 2 else f"number {k} alone, {k % 7} {k % 11} {k % 13}") for k in range(300)]
    return [*hot, *own, (900, LONG), (901, LONG), (902, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def test_line_dedup(docs, rows):
    keys = {i: [brute.ascii_lower(x.strip(brute.BLANKS)) for x in (t or "").split("\n")] for i, t in rows}
    often = {}
    for own in keys.values():
        for k in set(own):
            often[k] = often.get(k, 0) + 1
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], hashlib.md5(r["kept_text"].encode()).hexdigest()) for r in line_dedup.dedup_lines(docs).collect()}
    for i, t in rows:
        stay = [x for x, k in zip((t or "").split("\n"), keys[i], strict=True) if not (k and often[k] >= 10)]
        assert got[i] == (len(keys[i]), len(keys[i]) - len(stay), hashlib.md5("\n".join(stay).encode()).hexdigest())
    assert often["and a second line"] == 160


def test_exact_dedup(docs, rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {i: (max(groups[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows}


def test_simhash(docs, rows):
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.near_duplicates(docs, shingle=3, words=1, max_diff=3).collect()}
    prints = {t: brute.simhash(t, 3) for t in {t for _, t in rows}}
    want = brute.components({i: prints[t] for i, t in rows}, lambda a, b: (a ^ b).bit_count() <= 3)
    assert got == {i: (prints[t], want[i]) for i, t in rows}
    near = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert near[901] == near[900] == 900 and {near[k] for k in range(300, 460)} == {300} and near[902] == 902


def test_lm_scoring(spark, docs, rows):
    models = lm_scoring.fit(docs, spark.createDataFrame([(k,) for k in range(300, 400)], "id long"))
    got = {r["doc_id"]: (r["n_tokens"], r["score"]) for r in lm_scoring.score(docs, models).collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: len((t or "").encode().lower().split()) for i, t in rows}
    assert len({got[k][1] for k in range(300, 460)}) == 1 and got[900] == got[901] and got[300][1] > max(got[900][1], got[10][1]) and got[902][1] == 0


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    count = {t: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in {t for _, t in rows}}
    pieces = {}
    for r in packing.pack_documents(docs, queries.tokenizer_path()).select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset").collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    places = {}
    for i, t in rows:
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == count[t] and 0 < r["length"] <= 2048
            at += r["length"]
            places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert at == count[t]
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
