"""Fill-in-the-middle against a plain Python version."""

import hashlib
import random
import re

import pytest
from candela.llm import fim
from candela.llm.queries import op12_fim
from pyspark.sql import functions as F


def plain_version(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, None, text
    if h[3] % 100 < 20:
        return n, "spm", prefix, middle, suffix, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", prefix, middle, suffix, f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rng = random.Random(4)
    signs = "abcXYZ \n\t.,<>PSM\\$éß中\U0001f600́{}1\r \x00"
    out = [None, "", "a", "<P>", "x<S", "S>y", "a<M>b", "$1 \\2 {3}", "word " * 50, "\U0001f600" * 40, "no1signs2at3all"]
    return out + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 80))) for _ in range(300)]


def seed():
    return F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def test_parts_and_output_equal_the_plain_version(docs_of):
    rows = [*enumerate(texts()), (None, "no id here"), (7, "x<S"), (7, "x<S")]
    out = fim.transform(docs_of(rows, clashing=True), seed=seed())
    got = out.withColumn("back", fim.restore(F.col("fim.output"), F.col("fim.form"))).collect()
    assert len(got) == len(rows) and {r["fim"]["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert tuple(r["fim"]) == plain_version(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "") and r["spans"] == "x"


def test_a_column_named_like_the_result_is_kept(docs_of):
    out = fim.transform(docs_of(["some text"]).withColumn("FIM", F.lit(3)), seed=seed())
    assert out.columns[-2:] == ["FIM", "_fim"] and out.first()["FIM"] == 3


def test_long_texts_and_letter_runs_over_seams(docs_of, monkeypatch):
    monkeypatch.setattr(fim, "SLICE", 7)
    rng = random.Random(5)
    rows = ["".join(rng.choice("ab é\U0001f600") * rng.randrange(1, 12) for _ in range(30)) for _ in range(40)] + ["a" * 100]
    got = docs_of(rows).select("text", fim.count_units(F.col("text")).alias("n")).collect()
    assert all(r["n"] == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", r["text"])) for r in got)
    monkeypatch.undo()
    rows = ["q" * 2_000_000, "ab, " * 400_000, "\U0001f600é" * 300_000]
    for r in fim.transform(docs_of(rows), seed=seed()).collect():
        assert tuple(r["fim"]) == plain_version(r["doc_id"], r["text"])


def test_shares_of_the_forms(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"))
    out = fim.transform(docs, seed=seed(), plain_percent=50, spm_percent=50)
    share = {r["form"]: r["count"] / 4000 for r in out.groupBy(F.col("fim.form").alias("form")).count().collect()}
    assert abs(share["plain"] - 0.5) < 0.04 and abs(share["spm"] - 0.25) < 0.04


def test_markers_are_checked():
    assert fim.Markers("<PRE>", "<SUF>", "<MID>").all()
    for bad in (("<P>", "<P>", "<M>"), ("a.b", "<S>", "<M>"), ("xa", "ay", "<M>"), ("aba", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.Markers(*bad)


def test_empty_table(docs_of):
    assert fim.transform(docs_of([]), seed=seed()).count() == 0


def test_query_is_native_and_reads_two_columns(spark):
    plan = op12_fim(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert plan.split("== Physical Plan ==")[1].count("regexp_extract_all") == 1
