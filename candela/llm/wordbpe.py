"""Word-end BPE encoding by backtracking over longest matches, and decoding by an offset table (operator 11).

For tokenizer files with byte-level symbols, an end-of-word suffix and
ranked merges. Each word is a string over the symbols "byte" and "last byte
of a word", so the merges need no case of their own for the word's end.

Encoding a word: an Aho-Corasick automaton of all tokens runs over it once
and leaves, for every position, the longest token that starts there. The
encoder then goes left to right and takes the longest token that is
compatible with the token before it; where none is, it tries the next
shorter prefix, and where no prefix is left it closes the position and goes
back by one token. A pair (a, b) is compatible if merging the text of a and
b by rank gives just a and b; this is read off the merges that made a and b
(no merge of lower rank crosses their seam) and kept in a table of pairs. A
sequence whose adjacent pairs are all compatible is the result of the ranked
merges, and there is one such sequence, so the result is exact. A position
is closed at most once, which keeps the work linear in the word's length.

Text rules (tested against the library on every code point): marks of added
tokens are cut out of the raw text first; each part between them is brought
to NFC and lower-cased code point by code point, and cut into contractions,
letter runs, single numbers and runs of other signs. Code points that this
Python's Unicode tables do not know yet may have other classes in the
tokenizer's own tables; parts that hold one take their words from the
file's own normaliser and splitter. Merging is always done here.

Decoding gathers the tokens' texts from one byte table by (offset, length),
joined by one blank, as the library does for a file without a decoder; ids
outside the vocabulary are left out, as there.

Defined results: a NULL or empty text has no ids and decodes to an empty
text; texts of any length are encoded whole (cut for memory only before a
blank, which no word crosses); ties can not occur, since ranks are unique;
repeated rows give equal rows, an empty table no rows; other columns,
whatever their names, are untouched.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column
from tokenizers import Tokenizer as LibraryTokenizer

from candela.llm.common import SEGMENT, empty_if_null, text_segments, text_slices

#: How a lower-cased text is cut into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Distinct words that a worker keeps with their ids, pairs it keeps with their answer, before it forgets them.
MEMO_WORDS = 300_000
MEMO_PAIRS = 500_000
#: Symbols that go through the automaton at one time, and matches taken from it at one time.
SYMBOLS = 1 << 18
MATCHES = 1 << 16
#: Stands between words in the automaton's input; no token holds it.
SEAM = chr(512)


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the code points from 256 on.
    """
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Growing:
    """A flat integer array that grows by doubling."""

    def __init__(self) -> None:
        self.data, self.n = np.zeros(1024, dtype=np.int64), 0

    def extend(self, values: list[int]) -> None:
        """Add ``values`` at the end."""
        need = self.n + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(need, len(self.data)), dtype=np.int64)])
        self.data[self.n : need] = values
        self.n = need


class Merges:
    """Tokens numbered by rank: 512 symbols (byte, last byte of a word), then one token per merge."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        signs = byte_signs()
        names = [*signs, *[s + suffix for s in signs]]
        self.number = {name: k for k, name in enumerate(names)}
        if len(self.number) < 512:
            raise ValueError("the word-end suffix does not tell last bytes from others")
        self.text = [chr(k) for k in range(512)]
        self.split = [(k, k) for k in range(512)]
        self.joined: dict[tuple[int, int], int] = {}
        for left, right in merges:
            pair = (self.number[left], self.number[right])
            joined = left.removesuffix(suffix) + right if left.endswith(suffix) else left + right
            if joined in self.number or pair in self.joined:
                raise ValueError("two merges make the same token")
            names.append(joined)
            self.joined[pair] = self.number[joined] = len(self.split)
            self.text.append(self.text[pair[0]] + self.text[pair[1]])
            self.split.append(pair)
        self.id_of = [vocab[name] for name in names]
        self.length = [len(t) for t in self.text]
        #: Known answers of :meth:`compatible`, by ``left * len(split) + right``.
        self.pairs: dict[int, bool] = {}
        # A token takes part only if merging its own text gives it.
        made = [True] * len(self.split)
        for token in range(512, len(self.split)):
            left, right = self.split[token]
            made[token] = made[left] and made[right] and self.crosses_no_merge(left, right, token)
        at = {text: token for token, text in enumerate(self.text) if made[token]}
        self.shorter = [self._prefix(text, at) for text in self.text]
        # Single symbols match everywhere: they are filled in without the automaton.
        self.automaton = ahocorasick.Automaton()
        self.lengths = np.array(self.length, dtype=np.int32)
        for text, token in at.items():
            if token >= 512:
                self.automaton.add_word(text, token)
        self.automaton.make_automaton()

    @staticmethod
    def _prefix(text: str, at: dict[str, int]) -> int:
        """The longest token that is a proper prefix of ``text``, else -1."""
        return next((at[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in at), -1)

    def crosses_no_merge(self, left: int, right: int, below: int) -> bool:
        """No merge of a rank under ``below`` joins symbols over the seam of ``left`` and ``right``.

        The tokens beside the seam are taken apart from the last merge back.
        While a token of rank r stands beside the seam, only a merge before
        r, or at r if it would come first (the left one), beats it.
        """
        limit = below
        while True:
            joined = self.joined.get((left, right))
            if joined is not None and joined < limit:
                return False
            if left < 512 and right < 512:
                return True
            if left > right:
                limit, left = left, self.split[left][1]
            else:
                limit, right = right + 1, self.split[right][0]

    def compatible(self, left: int, right: int) -> bool:
        """Merging the texts of both tokens, side by side, gives just both tokens (the answer is kept)."""
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        fits = self.pairs[left * len(self.split) + right] = self.crosses_no_merge(left, right, len(self.split) + 1)
        return fits

    def longest_matches(self, symbols: str) -> array:
        """For every position the longest token that starts there (-1 at a seam)."""
        out = np.frombuffer(symbols.encode("utf-32-le"), dtype=np.int32).copy()
        out[out == ord(SEAM)] = -1
        if len(self.automaton):
            found = chain.from_iterable(self.automaton.iter(symbols))
            while len(part := np.fromiter(islice(found, 2 * MATCHES), np.int32)):
                end, token = part[::2], part[1::2]
                out[end - self.lengths[token] + 1] = token  # ends ascend, so the longest of a start comes last
        return array("i", out.tobytes())

    def backtrack(self, longest: array, start: int, end: int) -> list[int]:
        """Tokens of the word at ``start:end`` of the text that ``longest`` was made from."""
        length, shorter, pairs, tokens_in_all = self.length, self.shorter, self.pairs, len(self.split)
        token = longest[start]
        if length[token] == end - start:
            return [token]
        tokens: list[int] = []
        is_open = bytearray(b"\1") * (end - start + 1)
        at = start
        while True:
            last = tokens[-1] if tokens else -1
            while token >= 0:
                if is_open[at + length[token] - start]:
                    if last < 0:
                        break
                    fits = pairs.get(last * tokens_in_all + token)
                    if self.compatible(last, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at += length[token]
                if at == end:
                    return tokens
                token = longest[at]
            else:  # nothing fits behind ``last`` here
                is_open[at - start] = 0
                token = tokens.pop()
                at -= length[token]


class Vocabulary:
    """A tokenizer file with the tables of the encoder and the decoder."""

    def __init__(self, data: bytes):
        file = json.loads(data)
        model = file["model"]
        self._refuse_others(file, model)
        suffix = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, suffix)
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        marks = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(%s)" % "|".join(map(re.escape, marks))) if marks else None
        self.words = regex.compile(WORDS)
        self.known_signs: set[str] = set()
        self._data, self._library = data, None
        self._forget()

    @staticmethod
    def _refuse_others(file: dict, model: dict) -> None:
        """Fail on a file of another kind rather than encode it by the wrong rules."""
        steps = [n["type"] for n in (file["normalizer"] or {}).get("normalizers", [])]
        cuts = (file["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        fits = (
            model["type"] == "BPE" and model.get("end_of_word_suffix") and not model.get("dropout")
            and not model.get("continuing_subword_prefix") and not model.get("ignore_merges")
            and steps == ["NFC", "Replace", "Lowercase"] and cuts[0].get("pattern") == {"Regex": WORDS}
            and file["decoder"] is None and file["post_processor"] is None
            and not any(t[k] for t in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not fits:
            raise ValueError("not a word-end BPE file of the supported kind")

    def _forget(self) -> None:
        self._memo = {mark: k for k, mark in enumerate(self.added)}
        self._ids, self._lens = Growing(), Growing()
        self._ids.extend(list(self.added.values()))
        self._lens.extend([1] * len(self.added))

    # -- encoding ---------------------------------------------------------

    def split_words(self, text: str) -> list[str]:
        """The words of a text, added tokens' marks among them."""
        if self.marks is None or "<" not in text and not any(m in text for m in self.added):
            return self._plain_words(text)
        out = []
        for k, part in enumerate(self.marks.split(text)):
            if k % 2:
                out.append(part)
            elif part:
                out += self._plain_words(part)
        return out

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii():
            return self.words.findall(text.lower())
        new = set(text) - self.known_signs
        if any(unicodedata.category(sign) == "Cn" for sign in new):
            return self._words_of_new_signs(text)
        self.known_signs |= new
        # lower() looks at one code point but for the final sigma, which the tokenizer does not know
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _words_of_new_signs(self, text: str) -> list[str]:
        """The words of a text with code points that this Python's Unicode tables do not assign."""
        if self._library is None:
            byte_of = {s: b for b, s in enumerate(byte_signs())}
            self._library = LibraryTokenizer.from_str(self._data.decode()), byte_of
        library, byte_of = self._library
        signs = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
        return [bytes(map(byte_of.__getitem__, s)).decode() for s, _ in signs]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        out: list[list[int]] = []
        part: list[str] = []
        held = 0
        for word in words:
            symbols = word.encode().decode("latin-1")
            part.append(symbols[:-1] + chr(256 + ord(symbols[-1])))
            held += len(symbols) + 1
            if held >= SYMBOLS:
                out += self._encode_part(part)
                part, held = [], 0
        return out + self._encode_part(part)

    def _encode_part(self, part: list[str]) -> list[list[int]]:
        longest, backtrack, id_of = self.merges.longest_matches(SEAM.join(part)), self.merges.backtrack, self.merges.id_of
        out, at = [], 0
        for symbols in part:
            out.append([id_of[token] for token in backtrack(longest, at, at + len(symbols))])
            at += len(symbols) + 1
        return out

    def _encode_chunk(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of ``words`` and the number of ids of each."""
        if len(self._memo) > MEMO_WORDS:
            self._forget()
        memo = self._memo
        new = [w for w in dict.fromkeys(words) if w not in memo]
        if new:
            ids = self.encode_words(new)
            memo.update(zip(new, range(len(memo), len(memo) + len(new)), strict=True))
            self._ids.extend(list(chain.from_iterable(ids)))
            self._lens.extend(list(map(len, ids)))
        known = self._lens.data[: self._lens.n]
        code = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        return gather(self._ids.data, (np.cumsum(known) - known)[code], known[code]), known[code]

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Words are held for about SEGMENT characters at a time."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        words: list[str] = []
        spans: list[tuple[int, int]] = []
        held = 0

        def flush() -> None:
            nonlocal words, spans, held
            ids, lens = self._encode_chunk(words)
            end = np.concatenate([[0], np.cumsum(lens)])
            at = 0
            for k, n in spans:
                parts[k].append(ids[end[at] : end[at + n]])
                at += n
            words, spans, held = [], [], 0

        for k, text in enumerate(texts):
            for segment in text_segments(text):
                found = self.split_words(segment)
                words += found
                spans.append((k, len(found)))
                held += len(segment)
                if held >= SEGMENT:
                    flush()
        flush()
        none = np.zeros(0, dtype=np.int64)
        return [none if not p else p[0] if len(p) == 1 else np.concatenate(p) for p in parts]


class Spelling:
    """The tables of the decoder: every id's text and its decimal form, by offset and length."""

    def __init__(self, data: bytes):
        file = json.loads(data)
        names = {i: name.encode() for name, i in file["model"]["vocab"].items()}
        names.update((t["id"], t["content"].encode()) for t in file["added_tokens"])
        self.token_at, self.token_len, self.token_bytes = offset_table(names)
        self.decimal_at, self.decimal_len, self.decimal_bytes = offset_table({i: b"%d" % i for i in names})

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens of ``ids`` joined by blanks; ids outside the vocabulary are left out."""
        ids = ids.astype(np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.token_len))]
        return joined(self.token_at, self.token_len, self.token_bytes, ids[self.token_len[ids] > 0])

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids (of the vocabulary) in decimal, joined by blanks."""
        return joined(self.decimal_at, self.decimal_len, self.decimal_bytes, ids.astype(np.int64))


def offset_table(names: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offset and length of every id's bytes, each with a blank behind it, in one byte table."""
    length = np.zeros(max(names, default=-1) + 1, dtype=np.int64)
    for i, name in names.items():
        length[i] = len(name) + 1
    table = b"".join(names[i] + b" " for i in sorted(names))
    return np.cumsum(length) - length, length, np.frombuffer(table, dtype=np.uint8)


def gather(table: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The entries ``at : at + length`` of ``table``, one run after the other."""
    shift = np.repeat(at - (np.cumsum(length) - length), length)
    return table[shift + np.arange(len(shift))]


def joined(at: np.ndarray, length: np.ndarray, table: np.ndarray, ids: np.ndarray) -> bytes:
    return gather(table, at[ids], length[ids])[:-1].tobytes() if len(ids) else b""


_LOADED: dict[type, tuple[int, Vocabulary | Spelling]] = {}


def _loaded(kind: type, data: bytes) -> Vocabulary | Spelling:
    """The worker's tables of one kind, built once per process and file."""
    key = hash(data)
    if kind not in _LOADED or _LOADED[kind][0] != key:
        _LOADED[kind] = (key, kind(data))
    return _LOADED[kind][1]


class Tokenizer:
    """Encoder and decoder columns for one tokenizer file.

    ``path`` is read on the driver and sent to the executors as a broadcast
    variable (a vocabulary is a fixed input of a few MB, not data).
    """

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            self._data = spark.sparkContext.broadcast(f.read())

    def encode(self, text: str | Column) -> Column:
        """Ids of a text column as little-endian unsigned 32-bit integers (binary)."""
        data = self._data

        @F.arrow_udf("binary")
        def encode_packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary = _loaded(Vocabulary, data.value)
            for batch in (part for whole in batches for part in text_slices(whole)):
                ids = vocabulary.encode_texts(batch.to_pylist())
                yield pa.array([x.astype("<u4").tobytes() for x in ids], type=pa.binary())

        return encode_packed(empty_if_null(text))

    def spell(self, packed: str | Column) -> Column:
        """Struct of ``decoded`` (the tokens) and ``decimal`` (the numbers) of packed ids, each joined by blanks (NULL: empty)."""
        data = self._data

        @F.arrow_udf("struct<decoded:string,decimal:string>")
        def spell_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            spelling = _loaded(Spelling, data.value)
            for batch in (part for whole in batches for part in text_slices(whole)):
                ids = [np.frombuffer(x or b"", dtype="<u4") for x in batch.to_pylist()]
                texts = [pa.array([f(x) for x in ids], pa.binary()).cast(pa.string()) for f in (spelling.decode, spelling.decimal)]
                yield pa.StructArray.from_arrays(texts, names=["decoded", "decimal"])

        return spell_ids(F.col(packed) if isinstance(packed, str) else packed)


def encode_decode(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id, packed ids, their decimal form and their text, one row per row of ``docs``."""
    encoded = docs.select("doc_id", tokenizer.encode("text").alias("ids"))
    spelled = encoded.select("doc_id", "ids", tokenizer.spell("ids").alias("spelled"))
    return spelled.select("doc_id", "ids", F.col("spelled.decimal").alias("decimal"), F.col("spelled.decoded").alias("decoded"))
