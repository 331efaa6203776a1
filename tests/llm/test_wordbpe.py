"""Word-end BPE against the tokenizers library and against plain ranked merges."""

import json
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from candela.llm import wordbpe
from candela.llm.queries import WORD_FILE, op11_word_bpe
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(WORD_FILE))


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path(WORD_FILE), "rb") as f:
        return wordbpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def spelling():
    with open(public_tokenizers.path(WORD_FILE), "rb") as f:
        return wordbpe.Spelling(f.read())


def library_ids(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def texts():
    rng = random.Random(8)
    anything = lambda n: "".join(
        chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), rng.randrange(0x4E00, 0x11000), 0x1F600 + rng.randrange(60)]))
        for _ in range(n)
    ).encode("utf-8", "ignore").decode()
    out = [
        "", " ", "\t\n", "plain words, and more.", "It's WE'LL 'S don't", "a" * 3000, "!" * 500, "1234567890", "ab" * 400,
        "ODYSSEUS ΟΔΥΣΣΕΥΣ Σ", "İstanbul İ", "é ẞ ﬁ Å", "x\x00y\x1cz\x85w v",
        "<|endoftext|>", "a<|startoftext|>b<|endoftext|><|endoftext|>c", "<|endoftext", "<|ENDOFTEXT|>", "a </w> b</w>", "<| endoftext|>",
        "cafés naïve 中文 \U0001f600\U0001f468‍\U0001f469", "word " * 3000, "\U00010d50Ᲊ \U00016ea0x́",
    ]
    out += [anything(60) for _ in range(200)]
    return out + ["".join(rng.choice("abcdenrst") for _ in range(rng.randrange(1, 400))) for _ in range(200)]


def test_ids_and_text_equal_the_library(vocabulary, spelling, library):
    rows = texts()
    for text, ids, expected in zip(rows, vocabulary.encode_texts(rows), library_ids(library, rows), strict=True):
        assert ids.tolist() == expected, text
        assert spelling.decode(ids).decode() == library.decode(expected, skip_special_tokens=False)
        assert spelling.decimal(ids).decode() == " ".join(map(str, expected))


def test_every_code_point(vocabulary, library):
    signs = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(signs), 1 << 17):
        rows = [f"a{s}b {s}" for s in signs[at : at + (1 << 17)]]
        got = vocabulary.encode_texts(rows)
        assert all(a.tolist() == b for a, b in zip(got, library_ids(library, rows), strict=True))


def by_rank(word, rank):
    """Ranked merges one by one."""
    parts = list(word)
    while True:
        best = min((rank.get((a, b), len(rank)), k) for k, (a, b) in enumerate(zip(parts, parts[1:] + [None], strict=True)))
        if best[0] == len(rank):
            return parts
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_random_merges_with_tokens_that_no_text_reaches():
    """Small made-up vocabularies, whose merges need backtracking and leave tokens unused."""
    rng = random.Random(2)
    signs = wordbpe.byte_signs()
    for _ in range(60):
        names, merges = ["a", "b", "c"], []
        while len(merges) < 12:
            pair = (rng.choice(names), rng.choice(names))
            if pair[0] + pair[1] not in names:
                merges.append(pair)
                names.append(pair[0] + pair[1])
        tokens = [*signs, *[s + "</w>" for s in signs], *[a + b for a, b in merges]]
        made = wordbpe.Merges({t: k for k, t in enumerate(tokens)}, merges, "</w>")
        rank = {m: k for k, m in enumerate(merges)}
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 25)))
            got = [made.text[t] for t in made.backtrack(made.longest_matches(word), 0, len(word))]
            assert got == by_rank(word, rank)


def test_long_words_take_linear_work(vocabulary, library):
    calls = []
    plain = vocabulary.merges.pairs

    class Counted(dict):
        def get(self, key):
            calls[-1] += 1 / n
            return plain.get(key)

    for n in (20_000, 80_000):
        word = "".join(random.Random(n).choice("aehinorst") for _ in range(n))
        calls.append(0)
        vocabulary.merges.pairs = Counted()
        try:
            ids = vocabulary.encode_words([word])[0]
        finally:
            vocabulary.merges.pairs = plain
        assert ids == library.encode(word, add_special_tokens=False).ids
    assert calls[1] < 1.5 * calls[0] < 30


def test_cut_texts_and_small_memos(vocabulary, library, monkeypatch):
    monkeypatch.setattr(wordbpe, "SEGMENT", 50)
    monkeypatch.setattr(wordbpe, "MEMO_WORDS", 20)
    monkeypatch.setattr(wordbpe, "SYMBOLS", 30)
    monkeypatch.setattr(wordbpe, "MATCHES", 7)
    monkeypatch.setattr(wordbpe, "MEMO_PAIRS", 5)
    rows = [" ".join("Word%d<|endoftext|>\n\n  é" % i for i in range(200)), "", "x " * 300]
    assert [x.tolist() for x in vocabulary.encode_texts(rows)] == library_ids(library, rows)
    vocabulary._forget()


def test_unknown_ids_are_left_out(spelling, library):
    ids = [320, 60_000, 49407, 5]
    assert spelling.decode(np.array(ids)).decode() == library.decode(ids, skip_special_tokens=False)


def test_other_kinds_of_files_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        with pytest.raises(ValueError):
            wordbpe.Vocabulary(f.read())
    with open(public_tokenizers.path(WORD_FILE)) as f:
        file = json.load(f)
    file["added_tokens"][0]["lstrip"] = True
    with pytest.raises(ValueError):
        wordbpe.Vocabulary(json.dumps(file).encode())


def test_columns(spark, docs_of, rows_of, library):
    tokenizer = wordbpe.Tokenizer(spark, public_tokenizers.path(WORD_FILE))
    rows = [t.replace("\x00", "") for t in texts()[:60]] + [None, "y" * 300_000, "long text " * 200_000]
    out = rows_of(wordbpe.encode_decode(docs_of([*enumerate(rows), (0, rows[3])], clashing=True), tokenizer))
    assert len(out) == len(rows) + 1
    for r in out[2:]:
        ids = library.encode(rows[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False) and r["decimal"] == " ".join(map(str, ids))
    assert wordbpe.encode_decode(docs_of([]), tokenizer).count() == 0


def test_query_on_the_whole_table(spark, library):
    import hashlib

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op11_word_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
