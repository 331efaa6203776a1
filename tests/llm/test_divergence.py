"""Source divergence audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from candela.llm import divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def plain_version(rows, min_docs, top=50, smooth=5, scale=10**9):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: [t for t, n in c.items() if n >= min_docs] for lang, c in docs.items()}
    whole = defaultdict(Counter)
    for (lang, _), c in groups.items():
        whole[lang].update(c)

    def shares(counts, terms):
        total = sum(counts[t] for t in terms) + smooth * len(terms)
        return {t: 1 + scale * (counts[t] + smooth) // total for t in terms}

    p = {g: shares(c, kept[g[0]]) for g, c in groups.items()}
    q = {lang: shares(c, kept[lang]) for lang, c in whole.items()}
    out = []
    for g in groups:
        pairs = [(h[1], sum(abs(p[g][t] - p[h][t]) for t in kept[g[0]])) for h in groups if h[0] == g[0] and h != g]
        terms = [(t, p[g][t] - q[g[0]][t]) for t in kept[g[0]] if groups[g][t] > 0 and p[g][t] > q[g[0]][t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(*g, part, item, value, k + 1) for k, (item, value) in enumerate(found)]
    return sorted(out)


def corpus(n=400, sources=9, seed=6):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "été", "ÉTÉ", "naïve", "中文", "z", "Z"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)]
    rows = []
    for _ in range(n):
        source = 0 if rng.random() < 0.4 else rng.randrange(sources)
        near = words[source * 7 : source * 7 + 40] + words[:12]
        text = " ".join(rng.choice(near) + rng.choice(["", "", ",", "9", "_x"]) for _ in range(rng.randrange(0, 40)))
        rows.append((rng.choice(["en", "en", "de"]), f"s{source}", text))
    return rows + [
        (None, "s1", "lonely"), (None, None, None), ("xx", "a", "rare words"), ("xx", "b", ""), ("xx", "c", None), ("one", "only", "x"),
        ("en", "silent", "1 2 3 !"), ("en", None, "alpha alpha"), rows[0], rows[0],
    ]


def frame(spark, rows, extra=False):
    schema = "lang string, source string, text string"
    if extra:
        rows, schema = [(*r, "x", 1, "y") for r in rows], schema + ", term string, value long, path string"
    return spark.createDataFrame(rows, schema)


def collected(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("min_docs", "task_rows"), [(1, 20_000), (4, 7), (30, 1), (10_000, 20_000)])
def test_equals_plain_counting(spark, monkeypatch, min_docs, task_rows):
    monkeypatch.setattr(divergence, "TASK_ROWS", task_rows)
    rows = corpus()
    got = collected(divergence.audit(frame(spark, rows, extra=True).repartition(5), min_docs=min_docs))
    assert got == plain_version(rows, min_docs)


def test_ties_rank_by_bytes_and_top_is_kept(spark):
    rows = [("en", s, f"{a} {b}") for s in "ab" for a, b in [("zz", "é"), ("Aa", "b")] for _ in range(3)] + [("en", "a", "zz é aa b")]
    got = collected(divergence.audit(frame(spark, rows), min_docs=1, top=2))
    assert got == plain_version(rows, 1, top=2)


def test_counts_beyond_a_task_and_long_texts(spark, monkeypatch):
    rows = corpus(120) + [("en", "s2", "alpha beta " * 300_000), ("en", "s3", "q" * 1_500_000)]
    assert collected(divergence.audit(frame(spark, rows), min_docs=2)) == plain_version(rows, 2)
    # handing on early changes no sum
    monkeypatch.setattr(divergence, "HELD_TERMS", 10)
    batch = pa.record_batch([pa.array(c) for c in zip(*rows[:100], strict=True)], names=["lang", "source", "text"])
    sums = Counter()
    for out in divergence.count_batches(iter([batch])):
        for r in out.to_pylist():
            sums[r["lang"], r["source"], r["term"]] += r["n"]
    plain = Counter()
    for lang, source, text in rows[:100]:
        plain[lang, source, None] += 0
        plain.update((lang, source, t) for t in text.encode().translate(divergence._FOLD).decode().split())
    assert sums == plain


def walked(rows):
    item = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64()), ("p", pa.int64()), ("p0", pa.int64())]))
    batches = [
        pa.record_batch(
            [pa.array([r[0] for r in part]), pa.array([r[1] for r in part], item), pa.array([r[2] for r in part], pa.int64())],
            names=["lang", "path", "times"],
        )
        for part in rows
    ]
    out = Counter()
    for b in divergence.walk_rows(iter(batches)):
        for r in b.to_pylist():
            out[r["lang"], *sorted((r["source"], r["item"]))] += r["value"]
    return {k: v for k, v in out.items() if v}


def test_the_tree_counts_every_pair_of_every_row(monkeypatch):
    rng = random.Random(3)
    absent = {s: rng.randrange(1, 50) for s in range(90)}
    share = {(s, n): rng.randrange(1, 200) for s in range(90) for n in range(1, 4)}
    rows = set()
    for _ in range(300):
        some = sorted(rng.sample(range(90), rng.choice([1, 2, 5, 80])))
        rows.add((rng.choice("ab"), tuple((f"{s:02d}", n := rng.randrange(1, 3), share[s, n], absent[s]) for s in some)))
    rows = [(lang, list(path), rng.randrange(1, 5)) for lang, path in sorted(rows)]
    plain = Counter()
    for lang, path, times in rows:
        for k, (a, _, p, p0) in enumerate(path):
            for b, _, q, q0 in path[:k]:
                plain[lang, b, a] += times * (abs(p - q) - abs(p - q0) - abs(p0 - q) + abs(p0 - q0))
    plain = {k: v for k, v in plain.items() if v}
    structs = [(lang, [dict(zip(("source", "n", "p", "p0"), x, strict=True)) for x in path], times) for lang, path, times in rows]
    assert walked([structs[:100], structs[100:101], structs[101:]]) == plain
    monkeypatch.setattr(divergence, "HELD_PAIRS", 50)
    assert walked([structs]) == plain


def test_shared_paths_are_corrected_once():
    """1,000 rows that differ only in their last item: work per node, not per row and pair."""
    sums, path = divergence.PairSums("en"), divergence.Path()
    calls = []
    plain = sums.add
    sums.add = lambda *a: (calls.append(len(a[1])), plain(*a))
    for depth in range(30):
        path.push((str(depth), 1), sums.code_of(str(depth)), 10 + depth, 3)
    last = sums.code_of("last")
    for n in range(1000):
        path.push(("last", n), last, 20 + n, 4)
        path.times[-1] += 1
        path.pop(sums)
    assert path.times[-1] == 1000 and sum(calls) == 30_000
    while path.depth:
        path.pop(sums)
    assert sum(calls) == 30_000 + 30 * 29 // 2 and np.abs(sums.sums[last]).sum() > 0


def test_empty_table(spark):
    assert collected(divergence.audit(frame(spark, []))) == []


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    big = spark.createDataFrame([(4_000_000_000_000_000, 5_000_000_000_000_001, 7)], "c long, n long, v long")
    got = big.select(divergence.share(F.col("c"), F.col("n"), F.col("v"), 5, 10**9).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (4_000_000_000_000_000 + 5) // (5_000_000_000_000_001 + 35)
