import json

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.text import RECORD_MARK as M
from tallyloom.operators import answers


def test_answers_taken_apart(spark):
    cases = [
        (f"0{M}a\n1{M}b", 2, "accepted"), (f"```toon\n0{M}a\n1{M}b\n```", 2, "accepted"), (f"<TOON>\n0{M}a\n</TOON>", 1, "accepted"), ("", 1, "empty"), (None, 1, "empty"), ("  \n", 1, "empty"), ("I'm Sorry, no.", 3, "refusal"),
        ("We can't process this", 1, "refusal"), (f"sorry 0{M}a", 1, "accepted"), (f"0{M}a", 2, "short"), ("nothing", 1, "short"), ("\n".join(f"{k}{M}v" for k in range(9)), 10, "accepted"), ("\n".join(f"{k}{M}v" for k in range(8)), 10, "short"),
    ]
    got = spark.createDataFrame(cases, "raw string, n int, want string").withColumn("got", answers.answer_kind(F.col("raw"), F.col("n"))).collect()
    assert [r["got"] for r in got] == [c[2] for c in cases]
    raw = [("b", ["x", "y"], f"0{M}one\n1{M}two\n1{M}last\n7{M}none\nz{M}none\n00{M}no")]
    frame = spark.createDataFrame(raw, "batch string, ids array<string>, raw string")
    assert sorted(map(tuple, answers.taken(frame).collect())) == [("x", "one"), ("y", "last")]
    lone = spark.createDataFrame([("b", ["x"], f"title.x{M}one\nq{M}two"), ("c", ["y"], f"0{M}right")], "batch string, ids array<string>, raw string")
    assert sorted(map(tuple, answers.taken(lone, mangled=True).collect())) == [("x", "one"), ("y", "right")]


def parsed(request):
    return [line.split(M, 1) for line in request.split("\n")]


class Model:
    """Answers by what stands in a batch's values; calls are counted in files, as it runs in several processes."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, request):
        import os
        import uuid

        entries = parsed(request)
        kind = entries[0][1].split(":")[0]
        earlier = sum(name.startswith(kind + "-") for name in os.listdir(self.folder))
        open(os.path.join(self.folder, f"{kind}-{uuid.uuid4().hex}"), "w").write(request)
        said = [f"{k}{M}T {v}" for k, v in entries]
        if kind == "refuse":
            return "Sorry, I can not"
        if kind == "late":  # answers at the third attempt
            if earlier == 0:
                raise ConnectionError("429 try again")
            return None if earlier == 1 else "\n".join(said)
        if kind == "most":
            return "\n".join(said[1:] if len(said) > 1 else said)
        if kind == "half":
            return "\n".join(said[: len(said) // 2])
        return "```\n" + "\n".join(said) + "\n```"


def test_protocol(spark, tmp_path):
    sizes = {"fine": 12, "refuse": 3, "late": 4, "most": 15, "half": 30}
    fields = [(kind, pos, f"{kind}/{pos}", f"{kind}:value {pos}\nline") for kind, n in sizes.items() for pos in range(n)]
    frame = spark.createDataFrame(fields, "batch string, pos int, id string, value string").repartition(3)
    got = {r["id"]: (r["translation"], r["outcome"]) for r in answers.answered(frame, Model(tmp_path)).collect()}
    shout = lambda v: f"T {v}"
    want = {}
    for kind, pos, i, v in fields:
        if kind == "refuse":
            want[i] = (None, "refusal")
        elif kind == "most":
            want[i] = (shout(v), "retried" if pos == 0 else "translated")
        elif kind == "half":
            want[i] = (shout(v), "translated") if pos < 15 else (None, "missing")
        else:
            want[i] = (shout(v), "translated")
    assert got == want
    calls = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert {k: calls.count(k) for k in sizes} == {"fine": 1, "refuse": 4, "late": 3, "most": 2, "half": 4}
    assert answers.answered(frame.limit(0), Model(tmp_path)).collect() == []


def verdicts(what):
    def judge(request):
        out = []
        for line in request.split("\n"):
            k, rest = line.split("\t", 1)
            out += what(int(k), rest)
        return "Here: " + json.dumps(out)

    return judge


def test_three_passes(spark):
    pairs = [(1, "good words", "xx"), (2, "surely wrong", "xx"), (3, "cleared later", "xx"), (4, "confirmed then", "xx"), (5, "nothing said again", "xx"), (6, "same", "same"), (7, "ab", "xx"), (8, "rescued by words", "xx"), (9, None, "xx"), (10, "no confidence", "xx")]
    frame = spark.createDataFrame(pairs, "row long, source string, target string")
    first = verdicts(lambda k, t: [] if t.startswith("good") else [{"i": k, "ok": False, "reason": "first", **({} if t.startswith("no conf") else {"confidence": "high" if t.startswith("surely") else "low"})}])
    second = verdicts(lambda k, t: [] if t.startswith("nothing") else [{"i": k, "ok": t.startswith("cleared"), "reason": "second"}])
    third = verdicts(lambda k, t: [{"i": k, "en": "rescued by"}])
    only = sorted(map(tuple, answers.validated(frame, first).collect()))
    assert only == [(2, "first", "high"), (3, "first", "low"), (4, "first", "low"), (5, "first", "low"), (8, "first", "low"), (10, "first", "medium")]
    two = sorted(map(tuple, answers.validated(frame, first, second).collect()))
    assert two == [(2, "first", "high"), (4, "second", "confirmed"), (5, "first", "confirmed"), (8, "second", "confirmed"), (10, "second", "confirmed")]
    assert sorted(map(tuple, answers.validated(frame, first, second, third).collect())) == [x for x in two if x[0] != 8]
    assert sorted(map(tuple, answers.validated(frame, first, second, third, most_back=3).collect())) == two  # too many to translate back
    assert answers.validated(frame.limit(0), first, second, third).collect() == []


def test_verdicts_of_many_batches(spark):
    frame = spark.range(2000).selectExpr("id * 7 as row", "concat('source ', id) as source", "'target' as target")
    judge = verdicts(lambda k, t: [{"i": k, "ok": int(t.split(" ")[1]) % 10 != 0, "confidence": "high"}])
    assert sorted(r["row"] for r in answers.validated(frame, judge, judge, judge).collect()) == [7 * k for k in range(0, 2000, 10)]


@pytest.mark.parametrize("n", [1, 3])
def test_no_answer_is_an_error_of_its_request_alone(spark, n):
    def ask(request):
        if "bad" in request:
            raise ValueError("x" * 500)
        return request

    rows = spark.createDataFrame([(k, "bad" if k == 0 else "good") for k in range(n)], "k int, request string").repartition(2)
    got = {r["k"]: (r["raw"], r["error"]) for r in answers.asked(rows, ask).collect()}
    assert got == {k: (None, "x" * 200) if k == 0 else ("good", None) for k in range(n)}
