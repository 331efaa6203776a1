"""SimHash, decontamination, WARC, classifiers, neighbours and the pipeline against brute force or held-out labels."""

import base64
import gzip
import hashlib
import math
import os
import random
from collections import Counter
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from candela.llm import ann, decontam, quality, queries, simhash, toxicity, warc
from candela.session import scratch_dir

SF = "/root/testdata/sf0.001"


# -- simhash --------------------------------------------------------------


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(prints, max_bits):
    """Label of each position: the least position reachable."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if bin(prints[i] ^ prints[j]).count("1") <= max_bits and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_every_shared_choice_contains_a_position_set():
    from itertools import combinations

    for bits in range(8):
        sets = simhash.position_sets(bits)
        for shared in combinations(range(8), 8 - bits):
            assert any(set(s) <= set(shared) for s in sets)
    with pytest.raises(ValueError):
        simhash.position_sets(8)


def test_fingerprints_equal_a_plain_version(docs_of, rows_of, monkeypatch):
    texts = [
        None, "", " \t\n", "One", "one two", "ONE two three four", "a b c d e f g", "x " * 300, "é É word  word\x0bword",
        "tail\x85of words", " ".join(f"w{i}" for i in range(5000)),
    ]
    out = rows_of(docs_of(texts, clashing=True).select("doc_id", simhash.hex_fingerprint("f").alias("f")) if False else
                  docs_of(texts).select("doc_id", simhash.fingerprint("text", 4).alias("f")))
    assert [r["f"] % (1 << 64) for r in out] == [plain_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "byte_segments", lambda t: iter([t[i : i + 7] for i in range(0, len(t), 7)] or [b""]))
    cut_at_words = " ".join(f"word{i % 9}x" for i in range(40)).replace(" ", " ")
    parts = [p.encode() for p in re.findall(r"\S+\s?\S*\s?", cut_at_words)]
    monkeypatch.setattr(simhash, "byte_segments", lambda t: iter(parts))
    assert simhash.fingerprint_of(cut_at_words.encode(), 4) == plain_fingerprint(cut_at_words)


def test_sets_of_four_positions():
    assert len(simhash.position_sets(4)) == 23 and len(simhash.position_sets(4, key_bytes=4)) == 70
    assert {len(s) for s in simhash.position_sets(4, key_bytes=2)} == {2}
    for wrong in (0, 5):
        with pytest.raises(ValueError):
            simhash.position_sets(4, key_bytes=wrong)


@pytest.mark.parametrize(("chunk", "key_bytes"), [(2, None), (1024, None), (1024, 4), (2, 4)])
def test_components_equal_brute_force(spark, chunk, key_bytes, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(chunk)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for k in range(160):  # chains and clusters of near fingerprints
        x = rng.choice(prints)
        for _ in range(rng.randrange(1, 6)):
            x ^= 1 << rng.randrange(64)
        prints.append(x)
    distinct = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in distinct]
    nodes = spark.createDataFrame([(s, k) for k, s in enumerate(signed)], "fp long, id long")
    got = simhash.components(nodes, simhash.forest_edges(nodes.select("fp"), 4, key_bytes)).collect()
    want = plain_components(distinct, 4)
    assert {r["fp"]: r["label"] for r in got} == {s: want[k] for k, s in enumerate(signed)}


def test_components_of_edges_whose_evaluations_differ(spark):
    """On a cluster the rows of a group come in any order, so an edge may name its ends in another order each time."""
    rng = random.Random(7)
    pairs = [(k, k + 1) for k in range(0, 400) if k % 7] + [(rng.randrange(400), rng.randrange(400)) for _ in range(40)]
    edges = spark.createDataFrame(pairs, "x long, y long").withColumn("turn", F.rand() < 0.5)
    edges = edges.select(F.when(F.col("turn"), F.col("x")).otherwise(F.col("y")).alias("a"), F.when(F.col("turn"), F.col("y")).otherwise(F.col("x")).alias("b"))
    nodes = spark.range(400).select(F.col("id").alias("fp"), (1000 - F.col("id")).alias("id"))
    got = {r["fp"]: r["label"] for r in simhash.components(nodes, edges).collect()}
    root = list(range(400))
    for _ in range(400):
        for a, b in pairs:
            root[a] = root[b] = max(root[a], root[b])
    assert got == {k: 1000 - max(j for j in range(400) if root[j] == root[k]) for k in range(400)}


def test_forest_edges_have_one_form():
    import pyarrow as pa

    prints = [0, 1, 3, (1 << 63) + 5, (1 << 63) + 4]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    found = []
    for order in (prints, prints[::-1]):
        for some in (order, [p for p in order if p < 2]):
            rows = [(9, 0, 0, 0, signed(p)) for p in some]
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=list("klhof"))
            found.append(sorted(tuple(r.values()) for out in simhash._links(4)(iter([batch])) for r in out.to_pylist()))
    assert found[0] == found[2] and found[1] == found[3] == [(0, 1)]


def test_near_duplicates_edge_rows(docs_of, rows_of):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(7, text), (3, text), (3, text), (None, text), (9, None), (5, ""), (8, "another text of its own entirely")]
    out = rows_of(simhash.near_duplicates(docs_of(rows, clashing=True)))
    assert [(r["doc_id"], r["component_id"]) for r in out] == [(3, 3), (3, 3), (5, 5), (7, 3), (8, 8), (9, 5), (None, 3)]
    kept = rows_of(simhash.drop_near_duplicates(docs_of(rows, clashing=True)))
    assert [r["doc_id"] for r in kept] == [3, 5, 8, None]
    assert kept[0]["text"] == text and kept[0]["fp"] == "x"
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.drop_near_duplicates(docs_of([])).count() == 0


def test_copies_of_a_doc_id_with_map_columns(spark, docs_of):
    docs = docs_of([(1, "one two three four five"), (1, "one two three four five"), (2, "one two three four five"), (3, "other words")])
    docs = docs.withColumn("tags", F.create_map(F.lit("a"), F.col("doc_id"))).withColumn("parts", F.array(F.create_map(F.lit("b"), F.lit(1))))
    out = simhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3]


def test_a_doc_id_on_several_texts_leaves_one_row_of_each_component(docs_of):
    text = lambda t: " ".join(f"{t}{i}" for i in range(40))
    a, b, c, d = map(text, "abcd")
    # 2 is the smallest of a's component but not of b's; 5 names two texts without copies
    rows = [(2, a), (3, a), (1, b), (2, b), (5, c), (5, d), (5, d), (6, c)]
    kept = simhash.drop_near_duplicates(docs_of(rows, clashing=True)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, b), (2, a), (5, c), (5, d)]


# -- decontamination ------------------------------------------------------


def edit(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out.insert(at, f"new{rng.randrange(1000)}")
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out[at] = f"sub{rng.randrange(1000)}"
    return out


def plain_edits(item, words):
    """Least word edits of ``item`` to any passage of ``words``."""
    cost = [0] * (len(words) + 1)
    for k, x in enumerate(item):
        new = [k + 1]
        for j, y in enumerate(words):
            new.append(min(cost[j] + (x != y), cost[j + 1] + 1, new[j] + 1))
        cost = new
    return min(cost)


def test_leaks_against_brute_force(spark, docs_of):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(14, 60)))) for k in range(30)]
    items += [(90, "lone"), (91, "two words"), (92, None), (93, " ..."), (0, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [None, "", "...", "Alone lonely", "a LONE word", "two, words!"]
    for k in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 150))]
        if k % 2:
            item = items[k % 30][1].split()
            at = rng.randrange(len(words))
            words[at:at] = edit(item, rng.randrange(int(0.3 * len(item)) + 1), rng)
        texts.append(" ".join(words).upper() if k % 5 == 0 else ", ".join(words))
    found = decontam.find_leaks(docs_of(texts, clashing=True), bench).collect()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found}
    want = {}
    for d, t in enumerate(texts):
        for i, item in items:
            a, b = decontam.words_of(item or ""), decontam.words_of(t or "")
            if a and b and (e := plain_edits(a, b)) <= int(0.2 * len(a)):
                want[d, i] = e
    assert set(got) <= set(want)  # verified exactly
    assert all(got[k] == want[k] for k in got)
    assert len(got) >= 0.97 * len(want)  # the target recall of the LSH
    assert all(k in got for k, e in want.items() if e == 0)
    clean = decontam.drop_leaks(docs_of(texts, clashing=True), bench)
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in got}
    assert decontam.find_leaks(docs_of([]), bench).count() == 0
    assert decontam.find_leaks(docs_of(texts), bench.limit(0)).count() == 0


def test_item_blocks_give_the_same_leaks(spark, docs_of):
    rng = random.Random(4)
    items = [(k, " ".join(f"v{rng.randrange(300)}" for _ in range(20))) for k in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of([t + " and more words" for _, t in items])
    one = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()}
    assert one == {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench, block_items=15).collect()}
    assert {(k, k) for k in range(40)} <= one


def edit_by(kind, words, edits, rng):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        if kind == "insert":
            out.insert(at, f"new{rng.randrange(1000)}")
        elif kind == "delete":
            del out[at]
        else:
            out[at] = f"sub{rng.randrange(1000)}"
    return out


@pytest.mark.parametrize("kind", ["insert", "delete", "substitute"])
def test_passages_with_one_kind_of_edits_are_found_at_the_limit(kind):
    rng = random.Random(6)
    words = lambda n: [f"v{rng.randrange(400)}" for _ in range(n)]
    items = [(k, words(15 + k % 45)) for k in range(360)]
    index = decontam.Index([(k, " ".join(w)) for k, w in items], 0.2, 4, 0.99, 11)
    # amid words of the benchmark, so that a walk that leaves the passage reads no foreign words
    texts = [" ".join(words(20) + edit_by(kind, w, len(w) // 5, rng) + words(20)) for _, w in items]
    found = sum(any(h["item_id"] == k for h in hits) for (k, _), hits in zip(items, index.search(texts), strict=True))
    assert found >= 0.99 * len(items)


def test_exact_copies_of_short_items_are_always_found():
    rng = random.Random(8)
    words = lambda n: [f"v{rng.randrange(400)}" for _ in range(n)]
    items = [(k, " ".join(words(1 + k % 9))) for k in range(300)]
    index = decontam.Index(items, 0.2, 4, 0.99, 11)
    short = [(k, t) for k, t in items if len(t.split()) < 5]
    texts = [" ".join([*words(5), t, *words(5)]) for _, t in short]
    assert all(any(h["item_id"] == k for h in hits) for (k, _), hits in zip(short, index.search(texts), strict=True))


def test_pieces_find_every_passage(monkeypatch):
    monkeypatch.setattr(decontam, "MOST_REPETITIONS", 0)
    rng = random.Random(9)
    words = lambda n: [f"v{rng.randrange(60)}" for _ in range(n)]
    items = [(k, words(rng.randrange(1, 60))) for k in range(60)]
    texts = []
    for k in range(120):
        item = items[k % 60][1]
        passage = edit(item, rng.randrange(int(0.3 * len(item)) + 1), rng)
        texts.append(words(rng.randrange(4)) + passage + words(rng.randrange(4)))
    index = decontam.Index([(k, " ".join(w)) for k, w in items], 0.2, 4, 0.99, 11)
    assert all(c.pieces and not c.walks for c in index.classes)
    got = [{(h["item_id"], h["edits"]) for h in hits} for hits in index.search([" ".join(t) for t in texts])]
    costs = [[(k, plain_edits(w, t), len(w)) for k, w in items] for t in texts]
    assert got == [{(k, e) for k, e, n in row if e <= n // 5} for row in costs]


# -- WARC -----------------------------------------------------------------


def test_archive_round_trip(spark):
    hostile = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
    rows = [
        (1, "http://a.example/x?q=1#f", "<p>é</p>"), (2, "http://b.example", "<p>é</p>"), (3, None, None), (4, "", ""),
        (5, "http://c.example/\r\nInjected: 1", hostile), (6, "ftp://d", "x" * 200_000), (7, "http://e", "<p>é</p>"),
        (8, "u", "twice"), (8, "u", "twice"), (None, "u", "no name"), (9, "u", "other"), (8, "u", "third"),
    ]
    pages = spark.createDataFrame([r + ("x", "x") for r in rows], "page_id long, url string, html string, digest string, name string")
    path = scratch_dir(spark, "test-warc")
    warc.write_archive(pages, path, captures_per_file=3)
    captures = warc.assemble(warc.read_records(spark, path)).collect()
    named = [r for r in rows if r[0] is not None]
    assert len(captures) == len(named)
    latest = {}
    for i, _, html in named:
        latest[html or ""] = max(i, latest.get(html or "", i))
    got, want = [], []
    for c in captures:
        r = c["response"]
        page = int(re.search(r"pageId: (\d+)", c["metadata"]["fields"])[1])
        refers = None if r["refers_to"] is None else int(re.match(re.escape(warc.NAME) + r"(\d+)", r["refers_to"])[1])
        got.append((page, r["type"], refers, r["payload_bytes"], r["payload_digest"], r["target_uri"]))
        assert c["request"] is not None and (r["type"] == "revisit") == (r["payload"] is None)
        if r["payload"] is not None:
            assert r["digest_ok"] and base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode() == r["payload_digest"]
    for i, url, html in named:
        data = (html or "").encode()
        revisit = latest[html or ""] != i
        want.append((
            i, "revisit" if revisit else "response", latest[html or ""] if revisit else None, len(data),
            base64.b32encode(hashlib.sha1(data).digest()).decode(), re.sub(r"[\r\n]", "", url or ""),
        ))
    order = lambda x: tuple(str(v) for v in x)
    assert sorted(got, key=order) == sorted(want, key=order)
    nothing = scratch_dir(spark, "test-warc")
    warc.write_archive(pages.limit(0), nothing)
    assert warc.read_records(spark, nothing).count() == 0


def put(spark, files):
    folder = scratch_dir(spark, "test-warc-files")
    os.makedirs(folder)
    for name, data in files.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)
    return folder


def response(payload, *headers):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    lines = [b"WARC/1.1", b"WARC-Type: response", b"WARC-Record-ID: <urn:x>", *headers, b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def sha1(data):
    return b"sha1:" + base64.b32encode(hashlib.sha1(data).digest())


def test_plain_and_compressed_files_of_a_folder_are_read(spark):
    record = response(b"abc")
    folder = put(spark, {"a.warc": record * 2, "b.warc.gz": gzip.compress(record), "c.gz": gzip.compress(record) * 2, "notes.txt": b"x"})
    found = warc.read_records(spark, folder).collect()
    assert sorted(r["file"].rsplit("/", 1)[1] for r in found) == ["a.warc", "a.warc", "b.warc.gz", "c.gz", "c.gz"]


def test_wrong_digests_fail_or_are_kept_apart(spark):
    block = b"HTTP/1.1 200 OK\r\n\r\nabc"
    good = response(b"abc", b"WARC-Payload-Digest: " + sha1(b"abc"), b"WARC-Block-Digest: " + sha1(block))
    other = response(b"abc", b"WARC-Payload-Digest: md5:900150983cd24fb0d6963f7d28e17f72")  # of a kind that is not checked
    for bad in (b"WARC-Payload-Digest: " + sha1(b"abd"), b"WARC-Block-Digest: " + sha1(b"abc")):
        folder = put(spark, {"a.warc": good + other + response(b"abc", bad)})
        with pytest.raises(Exception, match="digest"):
            warc.read_records(spark, folder).collect()
        kept = warc.read_records(spark, folder, bad_digests="keep").orderBy("offset").collect()
        assert [r["digest_ok"] for r in kept] == [True, None, False]
        assert warc.read_records(spark, folder, bad_digests="drop").count() == 2


def test_archive_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    pages = spark.createDataFrame([(k, "http://a", f"{k}" * 900) for k in range(30)], "page_id long, url string, html string").coalesce(1)
    path = scratch_dir(spark, "test-warc")
    warc.write_archive(pages, path)
    assert spark.read.format("binaryFile").load(path).where("path like '%.gz'").count() >= 3
    assert warc.read_captures(spark, path).count() == 30


def test_payloads_under_the_limit_are_never_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")], "page_id long, url string, html string")
    path = scratch_dir(spark, "test-warc")
    warc.write_archive(pages, path, revisit_from=3)
    kinds = warc.read_records(spark, path).where(F.col("type").isin("response", "revisit")).select("record_id", "type").collect()
    assert sorted(r["type"] for r in kinds) == ["response"] * 3 + ["revisit"]


def test_records_of_plain_and_member_wise_files():
    record = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\na\r\nb\r\n\r\n"
    for data in (record * 3, gzip.compress(record) * 3, gzip.compress(record * 3)):
        found = list(warc.parse_records(warc._plain(data)))
        assert [(at, h["warc-type"], block) for at, h, block in found] == [(k * len(record), "warcinfo", b"a\r\nb") for k in range(3)]
    big = b"".join(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 300000\r\n\r\n" + random.Random(k).randbytes(300_000) + b"\r\n\r\n" for k in range(9))
    for data in (big, gzip.compress(big), memoryview(gzip.compress(big[: len(big) // 3]) + gzip.compress(big[len(big) // 3 :]))):
        found = [block for _, _, block in warc.parse_records(warc._plain(data))]
        assert found == [random.Random(k).randbytes(300_000) for k in range(9)]
    with pytest.raises(ValueError):
        list(warc.parse_records(iter([record[:-8]])))
    with pytest.raises((ValueError, zlib.error)):
        list(warc.parse_records(warc._plain(gzip.compress(record)[:-20])))


def oracle_rows(name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return sorted(map(str, con.execute(queries.oracle_sql()[name]).fetchall()))


@pytest.mark.parametrize(("name", "table"), [("op5_warc", "pages"), ("op10_ann", "embeddings")])
def test_queries_equal_their_sql(spark, name, table):
    out = queries.QUERIES[name](spark, SF)
    assert sorted(str(tuple(r)) for r in out.collect()) == oracle_rows(name, [table])


# -- classifiers ----------------------------------------------------------


def test_statistics_of_edge_texts(docs_of, rows_of):
    out = rows_of(docs_of([None, "", "a", "é\n\n!", "w " * 50_000]).select("doc_id", quality.statistics("text").alias("s")))
    assert all(np.isfinite(list(r["s"].values())).all() for r in out)
    assert set(out[0]["s"].values()) == {0.0} and out[0]["s"] == out[1]["s"]


def plain_statistics(text):
    """The statistics as their names say, over the whole text at one time."""
    n = len(text)
    if not n:
        return [0.0] * len(quality.STATISTICS)
    share = lambda test: sum(map(test, text)) / n
    words, lines = text.split(), text.split(b"\n")
    per = max(1, len(words))
    letters = [b for b in text if chr(b).isalpha() and b < 128]
    by_word, by_line = Counter(words), Counter(lines)
    marks, blanks = b".,;:?'\"()-", b" \t\r\x0b\x0c"
    symbol = lambda b: b < 128 and not chr(b).isalnum() and b not in marks + blanks + b"!|\n"
    p = np.array(list(Counter(text).values())) / n
    return [
        math.log1p(n), math.log1p(len(words)), sum(map(len, words)) / per, math.log1p(max(map(len, words), default=0)),
        sum(chr(b).isupper() for b in letters) / max(1, len(letters)), share(lambda b: 48 <= b <= 57), share(lambda b: b in marks),
        share(lambda b: b == ord("!")), share(symbol), share(lambda b: b == ord("|")), share(lambda b: b in blanks),
        math.log1p(n / len(lines)), share(lambda b: b >= 128), len(by_word) / per, max(by_word.values(), default=0) / per,
        sum(a == b for a, b in zip(words, words[1:])) / per, sum(len(w) <= 3 for w in words) / per, len(by_line) / len(lines),
        max(by_line.values()) / len(lines), sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / per, float(-(p * np.log2(p)).sum()),
    ]


def test_statistics_equal_a_plain_version_of_the_whole_text(docs_of, rows_of, monkeypatch):
    rng = random.Random(9)
    mixed = "".join(rng.choice(["word ", "Word\n", "é|", "12! ", "\n\n", "$ ", "same same ", "\t"]) for _ in range(400_000))
    texts = [mixed, "the same line again\n" * 160_000, "one long line without its end " * 100_000, "w" * 3_300_000, "a b\n" + " " * 1_200_000 + "\nb b"]
    for r, text in zip(rows_of(docs_of(texts).select("doc_id", quality.statistics("text").alias("s"))), texts, strict=True):
        assert list(r["s"].values()) == pytest.approx(plain_statistics(text.encode()), rel=1e-9, abs=1e-12)
    plain = quality.byte_segments
    monkeypatch.setattr(quality, "byte_segments", lambda text: plain(text, 7))
    for _ in range(300):
        text = "".join(rng.choice("ab \n\té!1") for _ in range(rng.randrange(1, 90))).encode()
        assert quality.statistics_of(text) == pytest.approx(plain_statistics(text), rel=1e-9, abs=1e-12)


def test_compiled_rules_equal_plain_evaluation(spark, docs_of):
    rng = random.Random(10)
    texts = ["".join(rng.choice("abc DEF!1|\n.") for _ in range(rng.randrange(0, 300))) for _ in range(200)] + [None]
    found = docs_of(texts).select("doc_id", quality.statistics("text").alias("_s")).collect()
    values = {r["doc_id"]: list(r["_s"]) for r in found}
    for _ in range(5):
        rules = tuple(
            tuple((k := rng.randrange(len(quality.STATISTICS)), rng.random() < 0.5, values[rng.randrange(200)][k]) for _ in range(rng.randrange(1, 4)))
            for _ in range(30)
        )
        model = quality.RuleModel(rules, tuple(rng.uniform(-2, 2) for _ in rules), rng.uniform(-1, 1))
        out = docs_of(texts).select("doc_id", quality.statistics("text").alias("_s")).select("doc_id", model.score("_s").alias("x"))
        for r in out.collect():
            v = values[r["doc_id"]]
            holds = [all(v[k] <= t if at_most else v[k] > t for k, at_most, t in rule) for rule in rules]
            total = model.intercept + sum(w for w, h in zip(model.weights, holds, strict=True) if h)
            assert r["x"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_samples_of_very_many_rows_are_not_empty(spark):
    class Many:
        """A frame that says it has 1e13 rows."""

        def __init__(self, df):
            self.df = df

        def count(self):
            return 10**13

        def where(self, condition):
            return condition

    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    limit = quality.sample_by_hash(Many(df), 30_000)
    assert str(int((1 << 62) * 30_000 / 10**13)) in str(limit) and df.where(limit).count() == 0
    assert 380 < quality.sample_by_hash(df, 500).count() < 620 and quality.sample_by_hash(df, 1000).count() == 1000


def test_tree_paths_are_conjunctions():
    tree = (
        "DecisionTreeClassificationModel: depth=2\n  If (feature 3 <= 0.5)\n   If (feature 3 <= 0.2)\n    Predict: 0.0\n"
        "   Else (feature 3 > 0.2)\n    Predict: 1.0\n  Else (feature 3 > 0.5)\n   Predict: 1.0\n"
    )
    assert quality.tree_paths(tree) == [
        ((3, True, 0.5),), ((3, True, 0.2),), ((3, False, 0.2), (3, True, 0.5)), ((3, False, 0.5),),
    ]


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_documents(docs, labels)
    both = scored.join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert len(both) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in both]) >= 0.95
    assert scored.count() == docs.count()
    assert all(0 <= r["score"] <= 1 for r in both)


def test_classifiers_without_two_classes(spark, docs_of, rows_of):
    docs = docs_of([(1, "some words"), (1, "some words"), (2, None), (3, ""), (None, "x")], clashing=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    only = spark.createDataFrame([(k, 1, 0) for k in range(9)] + [(None, None, None)], "doc_id long, quality int, toxic int")
    for f, label in ((quality.score_documents, "quality"), (toxicity.score_documents, "toxic")):
        assert len({r["score"] for r in rows_of(f(docs, none))}) == 1
        out = rows_of(f(docs, only))
        assert len(out) == 5 and {r["predicted"] for r in out} == ({1} if label == "quality" else {0})
        assert f(docs_of([]), only).count() == 0
    assert quality.keep_quality(docs, only).columns == docs.columns


def test_viterbi_restores_disguised_words():
    words = "idiot moron stupid worthless scum pathetic loser trash clown disgusting the and of with normal line words people"
    rows = "  ".join([words] * 50)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([rows])], names=["text"])
    out = list(toxicity._count_trigrams([batch]))[0]
    counts = np.zeros(toxicity.SYMBOLS**3)
    counts[out.column(0).to_numpy()] = out.column(1).to_numpy()
    assert counts.sum() == len(rows) + 4 - 2
    restorer = toxicity.Restorer(toxicity.language_model(counts))
    pairs = {
        "you 1d10t, and m0r0n": "you idiot, and moron", "i d i o t": "idiot", "idiiiiot": "idiot", "w.o.r.t.h.l.e.s.s": "worthless",
        "$cum": "scum", "p@thetic": "pathetic", "lo$er people": "loser people", "a normal line, of words!": "a normal line, of words!",
        "": "", "line one\ncl0wn\nline two": "line one\nclown\nline two",
    }
    assert {k: restorer.restore(k) for k in pairs} == pairs


def small_language_model(words):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["  ".join([" ".join(words)] * 50)])], names=["text"])
    out = list(toxicity._count_trigrams([batch]))[0]
    counts = np.zeros(toxicity.SYMBOLS**3)
    counts[out.column(0).to_numpy()] = out.column(1).to_numpy()
    return toxicity.language_model(counts)


def test_signs_at_the_end_and_long_spans_are_restored():
    words = ["idiot", "ass", "damn", "scum", "moron", "and", "the", "quiet", "text", "of", "people"]
    restorer = toxicity.Restorer(small_language_model(words))
    pairs = {
        "idio7": "idiot", "idi0+": "idiot", "a55": "ass", "a$$": "ass", "you a55, idio7.": "you ass, idiot.",
        "i" + "d" * 70 + "iot": "idiot", "m" * 200 + "o" * 200 + "ron": "moron", "-".join("moron" * 30): "moron" * 30,
        "quiet text!": "quiet text!", "the text of people.": "the text of people.",
    }
    assert {k: restorer.restore(k) for k in pairs} == pairs
    assert all(toxicity.SUSPECT.fullmatch(w) and len(toxicity.suspects(w)) for w in ("dam*", "idio7", "idi0+", "a55", "as$"))
    long = "".join(random.Random(1).choice("0123456789abcdef") for _ in range(9000))
    assert len(restorer.restore(long)) > 4000 and restorer.restore("z" * 60) in ("z", "zz", "zzz")


def test_viterbi_equals_search_of_all_paths():
    model = small_language_model(["idiot", "ass", "damn", "zoo", "bee", "too"])
    rng = random.Random(12)

    def paths(steps, k=0):
        if k == len(steps):
            yield 0.0, ()
            return
        _, drop, edges = steps[k]
        for cost, rest in paths(steps, k + 1):
            if drop > -math.inf:
                yield cost + drop, rest
            for symbol, c in edges:
                yield cost + c, ((symbol, steps[k][0]), *rest)

    def score(path):
        a = b = toxicity.BORDER
        total = 0.0
        for symbol, _ in path:
            total, a, b = total + model[a, b, symbol], b, symbol
        return total + model[a, b, toxicity.BORDER]

    for _ in range(150):
        span = "".join(rng.choice("ado0155s$1i..-") for _ in range(rng.randrange(1, 7)))
        steps = toxicity.lattice(span)
        best = max(cost + score(path) for cost, path in paths(steps))
        found = {
            "".join(chr(97 + x) if x < 26 else " " if x == toxicity.BORDER else c for x, c in path)
            for cost, path in paths(steps) if cost + score(path) > best - 1e-9
        }
        assert toxicity.viterbi(span, model) in found


def test_lines_without_suspect_places_have_no_match():
    rng = random.Random(8)
    for _ in range(3000):
        line = "".join(rng.choice("ab 1.-_'éЖ$!aaa ") for _ in range(rng.randrange(25)))
        if not len(toxicity.suspects(line)):
            assert not toxicity.SUSPECT.search(line), repr(line)


def test_toxicity_on_held_out_labels(spark, docs_of, rows_of):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randrange(2, 8))) for _ in range(500)]
    bad = ["idiot", "moron", "worthless", "pathetic"]
    disguise = {"idiot": "1d10t", "moron": "m0r0n", "worthless": "w o r t h l e s s", "pathetic": "p@thetic"}
    rows, labels = [], []
    for k in range(700):
        words, toxic = [rng.choice(vocabulary) for _ in range(60)], k % 6 == 0
        for _ in range(3 if toxic else 0):
            w = rng.choice(bad)
            words.insert(rng.randrange(len(words)), disguise[w] if k % 18 == 0 else w)
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = rows_of(toxicity.score_documents(docs_of([*rows, (1000, None)]), frame))
    held = [(r["predicted"], labels[r["doc_id"]][2], r["doc_id"]) for r in out[:-1] if r["held_out"]]
    assert all(p == t for p, t, _ in held)
    assert any(k % 18 == 0 for _, _, k in held)  # disguised words only
    assert out[-1]["predicted"] == 0


# -- neighbours -----------------------------------------------------------


def plain_nearest(rows, every, k):
    valid = {}
    for i, v in rows:
        ok = i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            valid[i] = min(valid.get(i, v), v)
    out = []
    for q, a in valid.items():
        if q % every == 0:
            scores = []
            for i, b in valid.items():
                if i != q:
                    total = 0.0
                    for x, y in zip(a, b):  # noqa: B905
                        total += x * y
                    scores.append((-total, i))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("case", ["plain", "copies", "few", "empty", "large", "mixed"])
def test_neighbours_against_brute_force(spark, case):
    rng = np.random.default_rng(3)
    count = {"plain": 300, "copies": 300, "few": 7, "empty": 0, "large": 200, "mixed": 200}[case]
    rows = [(k, rng.standard_normal(12).astype(np.float32).astype(float).tolist()) for k in range(count)]
    if case == "large":  # products beyond the range of single precision, up to the end of double precision
        rows = [(k, [x * (1e20, 1e150)[k // 5 % 2] for x in v]) for k, v in rows] + [(305, [1e157] * 12)]
    if case == "mixed":
        rows = [(k, [x * (1.0, 1e25, 1e-25)[k % 3] for x in v]) for k, v in rows]
    if case == "copies":
        rows = [(k, rows[0][1] if k % 3 else v) for k, v in rows]
        rows += [(500, [1.0] * 5), (501, None), (502, [0.0] * 12), (503, [None] + [1.0] * 11), (504, [float("nan")] * 12),
                 (505, [float("inf")] * 12), (None, [1.0] * 12), (20, [9.0] * 12), (506, []), rows[40], (510, [1e30] * 12)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    got = sorted(tuple(r) for r in ann.nearest(frame, query_every=10, k=5).select("query_id", "rank", "vec_id", "score").collect())
    assert got == plain_nearest(rows, 10, 5)


def test_chunks_and_blocks_give_the_same_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(k, rng.standard_normal(8).tolist()) for k in range(500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = plain_nearest(rows, 10, 5)
    monkeypatch.setattr(ann, "ROWS", 60)
    monkeypatch.setattr(ann, "BLOCK", 7)
    for limit in ("10MB", "-1"):  # blocks sent to all tasks; chunks x blocks dealt over tasks
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            got = ann.nearest(frame, query_every=10, k=5).select("query_id", "rank", "vec_id", "score")
            assert sorted(map(tuple, got.collect())) == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_error_bounds_hold_for_nearly_all_pairs():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((400, 32)), rng.standard_normal((50, 32))
    bits = 256
    turned = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ ann.rotation(32, bits, 5)
    codes = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(400)), pa.array([r.tobytes() for r in np.packbits(turned > 0, axis=1)]),
         pa.array(np.linalg.norm(x, axis=1)), pa.array(np.abs(turned).sum(axis=1) / np.sqrt(bits))],
        names=["entry", "code", "length", "c"],
    )
    inside = total = 0
    for entries, low, high in ann._bounds([codes], q, 32, bits, 5, 3.5):
        exact = x[entries] @ (q / np.linalg.norm(q, axis=1, keepdims=True)).T  # bounds are for queries of unit length
        inside += ((low <= exact) & (exact <= high)).sum()
        total += exact.size
    assert inside / total > 0.999


# -- pipeline -------------------------------------------------------------


def test_pipeline_stages(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, left, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
            path = scratch_dir(spark, "test-stage")
            out.write.parquet(path)
            out = spark.read.parquet(path)
            assert 0 < out.count() <= left.count()
            empty = stage(spark, docs.limit(0), SF)
            assert empty.count() == 0 and empty.columns == columns
        left = out
    assert left.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    assert left.where("n_tokens <> size(ids)").count() == 0


def test_all_eleven_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
