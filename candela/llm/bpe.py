"""Byte-level BPE encoding and decoding (operator 1).

Each text is cut by the pre-tokenising pattern; the distinct pieces of a
chunk are encoded together: a piece that is itself a vocabulary entry takes
its id, the others are bucketed by length into padded numpy matrices (one
row per piece). Every round looks up the rank of each adjacent pair in a
hash table, merges the leftmost pair of minimum rank in every row, compacts
the row by one cell and retires rows without a mergeable pair. Pieces
longer than the widest bucket (a padded matrix would cost the square of
their length) go through a queue ordered by (rank, position), which applies
the same rule. Encoded pieces are kept in a bounded per-worker memo.

Defined results: a NULL or empty text has no ids and decodes to empty
bytes; texts of any length are encoded whole (cut for memory only at places
where no piece crosses); ids outside the vocabulary raise an error when
decoded; other columns of the frame, whatever their names, are untouched.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from candela.llm.common import SEGMENT, empty_if_null, text_segments, text_slices

#: Bucket widths of the padded matrices, in bytes.
WIDTHS = (4, 8, 16, 32, 64, 128, 256)
#: Rows of one matrix.
MATRIX_ROWS = 20_000
#: Pieces kept in the memo before it is emptied.
MEMO_PIECES = 300_000
NO_PAIR = np.int32(2**31 - 1)
_EMPTY = np.int64(-1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a .tiktoken file: one ``base64(token) rank`` per line."""
    pairs = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Vocabulary:
    """Rank file with the lookup tables of the encoder and the decoder."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        size = max(ranks.values(), default=-1) + 1
        by_id = [b""] * size
        for token, i in ranks.items():
            by_id[i] = token
        self.token_len = np.array([len(t) for t in by_id], dtype=np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_len)[:-1]]).astype(np.int64)
        self.token_bytes = np.frombuffer(b"".join(by_id) or b"\0", dtype=np.uint8)
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self._build_pairs()
        self._reset_memo()

    def _build_pairs(self) -> None:
        """Open-addressed hash table: (left id, right id) -> id of the joined token."""
        ranks = self.ranks
        keys, vals = [], []
        for token, joined in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    keys.append(left << 31 | right)
                    vals.append(joined)
        bits = max(10, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, _EMPTY, dtype=np.int64)
        self._vals = np.full(1 << bits, NO_PAIR, dtype=np.int32)
        key, val = np.array(keys, dtype=np.int64), np.array(vals, dtype=np.int32)
        slot = self._slot(key)
        while len(key):  # the first of each free slot settles, the others probe on
            free = self._keys[slot] == _EMPTY
            first = np.zeros(len(key), dtype=bool)
            first[np.unique(np.where(free, slot, -1), return_index=True)[1]] = True
            settle = free & first
            self._keys[slot[settle]] = key[settle]
            self._vals[slot[settle]] = val[settle]
            key, val, slot = key[~settle], val[~settle], (slot[~settle] + 1) & self._mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MULT) >> self._shift).astype(np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the token that ``left`` and ``right`` join to, else NO_PAIR (also beside padding)."""
        out = np.full(left.shape, NO_PAIR, dtype=np.int32)
        todo = np.nonzero((left >= 0) & (right >= 0))
        key = (left[todo].astype(np.int64) << 31) | right[todo]
        slot = self._slot(key)
        found = np.full(len(key), NO_PAIR, dtype=np.int32)
        at = np.arange(len(key))
        while len(at):
            here = self._keys[slot]
            hit = here == key
            found[at[hit]] = self._vals[slot[hit]]
            on = ~hit & (here != _EMPTY)
            at, key, slot = at[on], key[on], (slot[on] + 1) & self._mask
        out[todo] = found
        return out

    # -- encoding ---------------------------------------------------------

    def merge_rows(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length, merged together round by round."""
        lens = np.array([len(p) for p in pieces], dtype=np.int64)
        width = int(lens.max())
        ids = np.full((len(pieces), width), -1, dtype=np.int32)
        ids[np.arange(width) < lens[:, None]] = self.byte_id[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        rank = self.pair_rank(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(pieces))
        out: list[np.ndarray | None] = [None] * len(pieces)
        while len(row):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), dtype=np.int64)
            best = rank[np.arange(len(row)), at] if rank.shape[1] else np.full(len(row), NO_PAIR)
            done = best == NO_PAIR
            if done.any():
                for k in np.nonzero(done)[0]:
                    out[row[k]] = ids[k, : lens[k]].copy()
                on = ~done
                ids, rank, row, lens, at, best = ids[on], rank[on], row[on], lens[on], at[on], best[on]
                if not len(row):
                    break
            n = np.arange(len(row))
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
            ids[n, at] = best
            cols = cols[:-1]
            rank = np.take_along_axis(rank, cols + (cols > at[:, None]), axis=1)
            lens -= 1
            if rank.shape[1]:  # only the two pairs beside the new token change
                before, after = at > 0, at < rank.shape[1]
                rank[n[before], at[before] - 1] = self.pair_rank(ids[n[before], at[before] - 1], best[before])
                rank[n[after], at[after]] = self.pair_rank(best[after], ids[n[after], at[after] + 1])
        return out  # type: ignore[return-value]

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one very long piece, by a queue of (rank, position)."""
        ids = self.byte_id[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        by_id = self.by_id()
        ranks = self.ranks

        def rank(i: int) -> int | None:
            j = nxt[i]
            return ranks.get(by_id[ids[i]] + by_id[ids[j]]) if j < n else None

        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue  # merged away or outdated
            j = nxt[i]
            ids[i], ids[j], nxt[i] = r, -1, nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            for k in (prev[i], i):
                if k >= 0 and (new := rank(k)) is not None:
                    heapq.heappush(heap, (new, k))
        return np.array([x for x in ids if x >= 0], dtype=np.int32)

    def by_id(self) -> list[bytes]:
        if not hasattr(self, "_by_id"):
            self._by_id = [b""] * len(self.token_len)
            for token, i in self.ranks.items():
                self._by_id[i] = token
        return self._by_id

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pieces)
        todo = []
        for k, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[k] = np.array([whole], dtype=np.int32)
            else:
                todo.append(k)
        todo.sort(key=lambda k: len(pieces[k]))
        low = 0
        for width in WIDTHS:
            high = low
            while high < len(todo) and len(pieces[todo[high]]) <= width:
                high += 1
            for at in range(low, high, MATRIX_ROWS):
                part = todo[at : min(at + MATRIX_ROWS, high)]
                for k, ids in zip(part, self.merge_rows([pieces[k] for k in part]), strict=True):
                    out[k] = ids
            low = high
        for k in todo[low:]:
            out[k] = self.merge_long(pieces[k])
        return out  # type: ignore[return-value]

    def _reset_memo(self) -> None:
        self._memo: dict[str, int] = {}
        self._memo_ids = np.zeros(0, dtype=np.int32)
        self._memo_len = np.zeros(0, dtype=np.int64)

    def encode_chunk(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of ``pieces`` and the number of ids of each."""
        memo = self._memo
        if len(memo) > MEMO_PIECES:
            self._reset_memo()
            memo = self._memo
        new = [p for p in dict.fromkeys(pieces) if p not in memo]
        if new:
            ids = self.encode_pieces([p.encode() for p in new])
            memo.update(zip(new, range(len(memo), len(memo) + len(new)), strict=True))
            self._memo_ids = np.concatenate([self._memo_ids, *ids])
            self._memo_len = np.concatenate([self._memo_len, np.array([len(x) for x in ids], dtype=np.int64)])
            self._memo_at = np.cumsum(self._memo_len) - self._memo_len
        code = np.fromiter(map(memo.__getitem__, pieces), np.int64, len(pieces))
        lens = self._memo_len[code]
        shift = np.repeat(self._memo_at[code] - (np.cumsum(lens) - lens), lens)
        return self._memo_ids[shift + np.arange(len(shift))], lens

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Pieces are held for about SEGMENT characters at a time."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        pieces: list[str] = []
        spans: list[tuple[int, int]] = []  # (text, its number of pieces) of the chunk
        held = 0

        def flush() -> None:
            nonlocal pieces, spans, held
            if pieces:
                ids, lens = self.encode_chunk(pieces)
                piece_end = np.concatenate([[0], np.cumsum(lens)])
                at = 0
                for k, n in spans:
                    parts[k].append(ids[piece_end[at] : piece_end[at + n]])
                    at += n
            pieces, spans, held = [], [], 0

        for k, text in enumerate(texts):
            for segment in text_segments(text):
                found = self.pattern.findall(segment)
                pieces += found
                spans.append((k, len(found)))
                held += len(segment)
                if held >= SEGMENT:
                    flush()
        flush()
        none = np.zeros(0, dtype=np.int32)
        return [none if not p else p[0] if len(p) == 1 else np.concatenate(p) for p in parts]

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids`` (any integer array)."""
        if not len(ids):
            return b""
        ids = ids.astype(np.int64)
        if ids.min() < 0 or ids.max() >= len(self.token_len) or not self.token_len[ids].all():
            raise ValueError("an id is not in the vocabulary")
        lens = self.token_len[ids]
        shift = np.repeat(self.token_at[ids] - (np.cumsum(lens) - lens), lens)
        return self.token_bytes[shift + np.arange(len(shift))].tobytes()


_LOADED: dict[tuple[int, str], Vocabulary] = {}


def _vocabulary(data: bytes, pattern: str) -> Vocabulary:
    """The worker's tables, built once per process and rank file."""
    key = (hash(data), pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(parse_ranks(data), pattern)
    return _LOADED[key]


class Tokenizer:
    """Encoder and decoder columns for one rank file.

    ``path`` is read on the driver and sent to the executors as a broadcast
    variable (a rank file is a fixed input of a few MB, not data).
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            self._data = spark.sparkContext.broadcast(f.read())
        self.pattern = pattern

    def token_lengths(self) -> np.ndarray:
        """Bytes of each id's token (0 for ids that are free)."""
        ranks = parse_ranks(self._data.value)
        out = np.zeros(max(ranks.values(), default=-1) + 1, dtype=np.int64)
        for token, i in ranks.items():
            out[i] = len(token)
        return out

    def encode(self, text: str | Column, width: int = 4) -> Column:
        """Ids of a text column, packed as little-endian unsigned integers of ``width`` bytes (binary)."""
        data, pattern, dtype = self._data, self.pattern, f"<u{width}"

        @F.arrow_udf("binary")
        def encode_packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary = _vocabulary(data.value, pattern)
            for batch in (part for whole in batches for part in text_slices(whole)):
                ids = vocabulary.encode_texts(batch.to_pylist())
                yield pa.array([x.astype(dtype).tobytes() for x in ids], type=pa.binary())

        return encode_packed(empty_if_null(text))

    def encode_array(self, text: str | Column) -> Column:
        """Ids of a text column as ``array<int>``."""
        data, pattern = self._data, self.pattern

        @F.arrow_udf("array<int>")
        def encode_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary = _vocabulary(data.value, pattern)
            for batch in (part for whole in batches for part in text_slices(whole)):
                ids = vocabulary.encode_texts(batch.to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, dtype=np.int32), *ids])
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=pa.int32()))

        return encode_ids(empty_if_null(text))

    def decode(self, packed: str | Column) -> Column:
        """Bytes of a column of packed ids (NULL: empty)."""
        data, pattern = self._data, self.pattern

        @F.arrow_udf("binary")
        def decode_packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary = _vocabulary(data.value, pattern)
            for batch in (part for whole in batches for part in text_slices(whole)):
                yield pa.array(
                    [vocabulary.decode(np.frombuffer(x or b"", dtype="<u4")) for x in batch.to_pylist()],
                    type=pa.binary(),
                )

        return decode_packed(F.col(packed) if isinstance(packed, str) else packed)


def encode_decode(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id, packed ids and the bytes they decode to, one row per row of ``docs``."""
    encoded = docs.select("doc_id", tokenizer.encode("text").alias("ids"))
    return encoded.select("doc_id", "ids", tokenizer.decode("ids").alias("decoded"))
