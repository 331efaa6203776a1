"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 3).

A benchmark item leaks into a document where some passage of the document
is within ``floor(max_edits * n)`` word edits of the item's ``n`` words.

* CGK embedding: a random walk reads a word sequence; at step ``j`` it
  emits the word under its pointer and moves on by a random bit that depends
  on ``j`` and the word. Edit distance between two sequences becomes Hamming
  distance between their emitted sequences.
* Bit-sampling LSH: a repetition keeps the emitted words of a few sampled
  steps as a key. Every item-sized window of every document (a window starts
  at every word) is embedded by the same walks; equal keys make a
  candidate. Walks are added per class of item lengths until they find the
  target share of the items themselves, edited up to the limit, for every
  kind of edits (insertions only, deletions only, ...), and half as many again.
* Pieces: classes that MOST_REPETITIONS do not bring there, or with items too
  short for an edit, are searched without loss. An item cut into k + 1 pieces
  keeps one of them unchanged in every passage within k edits, so passages
  around equal pieces are the candidates.
* Verification: word edit distance of the item to the best passage around
  the candidate, exactly, by dynamic programming over whole batches.

A count filter goes before the walks and loses nothing: by the q-gram lemma
a passage within ``k`` edits of an item of ``n`` words holds at least
``n - 1 - 2k`` of the item's word pairs (and ``n - k`` of its words) among
its at most ``n + k`` words, so windows with fewer benchmark pairs are not
walked.

Items are a query set taken in blocks of at most about ``block_items``
items (by a hash of item_id); each block is one map-only pass, so documents
are never shuffled and the driver holds one block at a time.

Defined results: NULL and word-free texts have no leak; NULL and word-free
items match nothing; items too short for an edit match only as they are,
and always do; repeated documents and items give one row each; texts of any
length are searched whole; empty tables of documents or items give no leak
(and drop nothing); only doc_id and text, item_id and text are read, and
dropping keeps all other columns, whatever their names; words are runs of
letters and digits in lower case.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.common import empty_if_null, text_segments, text_slices, unused_name

_WORD = re.compile(r"[^\W_]+")
HITS = "array<struct<item_id:bigint,start_word:bigint,end_word:bigint,edits:int,item_words:int>>"
#: Ratio between the longest and the shortest item of a length class.
CLASS_RATIO = 1.3
#: Window starts walked at a time.
WALK_ROWS = 1 << 16
#: A class that needs more repetitions is searched by pieces.
MOST_REPETITIONS = 400
#: Kinds of edits that the walks of a class must find, and trial passages of each.
EDIT_KINDS = ("mixed", "insert", "delete", "substitute")
TRIALS = 400
#: Bits of the table of item word pairs (its false positives only cost time).
PAIR_BITS = 22
SETS_PER_WALK = 8


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Repetition:
    """One sample set of a walk: the words emitted at ``steps`` make the key."""

    steps: np.ndarray
    keys: np.ndarray  # sorted
    items: np.ndarray  # item index of each key


@dataclass
class Pieces:
    """Pieces of ``length`` words: of an item's pieces every passage within its limit holds one unchanged."""

    length: int
    keys: np.ndarray  # sorted
    items: np.ndarray  # item index of each key
    offsets: np.ndarray  # where in the item the piece starts


@dataclass
class LengthClass:
    shortest: int
    longest: int
    walks: list[tuple[np.ndarray, list[Repetition]]]  # multipliers of the steps' random bits, sample sets
    pieces: list[Pieces]  # instead of walks
    sizes: list[int]  # distinct item lengths


_FOREIGN = np.uint64(0x6A09E667F3BCC909)  # hash of every word that no item has
_MIX = np.uint64(0x9E3779B97F4A7C15)


def walk_keys(
    words: np.ndarray, starts: np.ndarray, multipliers: np.ndarray, sets: list[np.ndarray], ends: np.ndarray | None = None
) -> list[np.ndarray]:
    """Keys of the CGK walks from ``starts`` over hashed ``words``, one array per sample set of steps.

    At step j the pointer moves on by the top bit of (word hash x multiplier j).
    ``ends``: beyond it a walk reads foreign words (for sequences of their own).
    """
    at = starts.copy()
    last = len(words) - 1
    keys = [np.zeros(len(starts), dtype=np.uint64) for _ in sets]
    sampled: dict[int, list[int]] = {}
    for k, steps in enumerate(sets):
        for j in steps:
            sampled.setdefault(int(j), []).append(k)
    for j in range(max(sampled) + 1):
        here = words[np.minimum(at, last)]
        if ends is not None:
            here = np.where(at < ends, here, _FOREIGN)
        for k in sampled.get(j, ()):
            keys[k] = (keys[k] ^ here) * _MIX
            keys[k] ^= keys[k] >> np.uint64(29)
        at += ((here * multipliers[j]) >> np.uint64(63)).astype(np.int64)
    return keys


def piece_keys(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Keys of the ``length`` hashed words from each of ``starts``."""
    keys = np.zeros(len(starts), dtype=np.uint64)
    for j in range(length):
        keys = (keys ^ words[starts + j]) * _MIX
        keys ^= keys >> np.uint64(29)
    return keys


def equal_keys(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (position in the sorted ``table``, position in ``keys``) of equal keys."""
    low = np.searchsorted(table, keys)
    hit = np.nonzero(table[np.minimum(low, len(table) - 1)] == keys)[0]
    low = low[hit]
    counts = np.searchsorted(table, keys[hit], side="right") - low
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(low, counts) + within, np.repeat(hit, counts)


def passage_edits(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least word edits of ``item`` to any passage of each row of ``regions``, and the passage's end.

    Rows are padded with -1. Semi-global: a passage starts and ends anywhere.
    """
    n, width = regions.shape
    cost = np.zeros((n, width + 1), dtype=np.int32)
    slope = np.arange(width + 1, dtype=np.int32)
    for k, word in enumerate(item):
        new = np.empty_like(cost)
        new[:, 0] = k + 1
        new[:, 1:] = np.minimum(cost[:, :-1] + (regions != word), cost[:, 1:] + 1)
        cost = np.minimum.accumulate(new - slope, axis=1) + slope
    end = cost.argmin(axis=1)
    return cost[np.arange(n), end], end


class Index:
    """Walks, sample sets and key tables of one block of items."""

    def __init__(self, items: list[tuple[int, str]], max_edits: float, samples: int, target: float, seed: int):
        self.ids = [i for i, _ in items]
        words = [words_of(t) for _, t in items]
        self.vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.items = [np.array([self.vocabulary[w] for w in ws], dtype=np.int32) for ws in words]
        self.limits = [math.floor(max_edits * len(x)) for x in self.items]
        self.max_edits = max_edits
        random = np.random.default_rng(seed)
        self.hashed = random.integers(1, 1 << 63, size=len(self.vocabulary) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.hashed[0] = _FOREIGN
        self.pairs = np.zeros(1 << PAIR_BITS, dtype=bool)
        for x in self.items:
            self.pairs[self._pair(self.hashed[x[:-1]], self.hashed[x[1:]])] = True
        order = sorted((k for k, x in enumerate(self.items) if len(x)), key=lambda k: len(self.items[k]))
        self.classes: list[LengthClass] = []
        while order:
            shortest = len(self.items[order[0]])
            members = [k for k in order if len(self.items[k]) <= max(shortest, int(shortest * CLASS_RATIO))]
            order = order[len(members) :]
            self.classes.append(self._class(members, samples, target, random))

    def _class(self, members: list[int], samples: int, target: float, random: np.random.Generator) -> LengthClass:
        sizes = [len(self.items[k]) for k in members]
        walks = self._walks(members, samples, target, random) if all(self.limits[k] for k in members) else []
        return LengthClass(min(sizes), max(sizes), walks, [] if walks else self._pieces(members), sorted(set(sizes)))

    def _walks(
        self, members: list[int], samples: int, target: float, random: np.random.Generator
    ) -> list[tuple[np.ndarray, list[Repetition]]]:
        """Walks that reach the target on trial passages of every kind of edits; none if MOST_REPETITIONS do not."""
        sizes = [len(self.items[k]) for k in members]
        n_steps = max(1, 2 * min(sizes) - 1)
        samples = min(samples, n_steps)
        flat = np.concatenate([self.hashed[self.items[k]] for k in members])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        # Items with as many edits as the limit allows, one behind the other: a walk reads on in benchmark words.
        trials = random.integers(len(members), size=len(EDIT_KINDS) * TRIALS)
        edited = [
            self.hashed[self._edit(self.items[members[t]], self.limits[members[t]], EDIT_KINDS[at // TRIALS], random)]
            for at, t in enumerate(trials)
        ]
        passages = np.concatenate(edited)
        begins = np.cumsum([0, *map(len, edited[:-1])])
        missed = np.ones(len(trials), dtype=bool)
        walks: list[tuple[np.ndarray, list[Repetition]]] = []
        needed = None
        while needed is None or len(walks) < needed:
            if (len(walks) + 1) * SETS_PER_WALK > MOST_REPETITIONS:
                return []
            sets = [np.sort(random.choice(n_steps, size=samples, replace=False)) for _ in range(SETS_PER_WALK)]
            multipliers = random.integers(0, 1 << 63, size=n_steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            keys = walk_keys(flat, starts, multipliers, sets, ends)
            table = []
            for steps, key in zip(sets, keys, strict=True):
                by_key = np.argsort(key, kind="stable")
                table.append(Repetition(steps, key[by_key], np.array(members)[by_key]))
            walks.append((multipliers, table))
            if needed is None:
                for own, other in zip(keys, walk_keys(passages, begins, multipliers, sets), strict=True):
                    missed &= own[trials] != other
                if missed.reshape(len(EDIT_KINDS), TRIALS).mean(axis=1).max() <= 1 - target:
                    needed = math.ceil(1.5 * len(walks))  # the trials are a sample, and these walks were picked on them
        return walks

    def _pieces(self, members: list[int]) -> list[Pieces]:
        """The members cut into one piece more than their limits, by length of the pieces."""
        cut: dict[int, list[tuple[int, int]]] = {}
        for k in members:
            n = len(self.items[k])
            parts = min(self.limits[k] + 1, n)
            bounds = [p * n // parts for p in range(parts + 1)]
            for low, high in zip(bounds, bounds[1:], strict=False):
                cut.setdefault(high - low, []).append((k, low))
        out = []
        for length, places in sorted(cut.items()):
            items, offsets = np.array(places).T
            words = np.concatenate([self.hashed[self.items[k][low : low + length]] for k, low in places])
            keys = piece_keys(words, np.arange(len(places)) * length, length)
            by_key = np.argsort(keys, kind="stable")
            out.append(Pieces(length, keys[by_key], items[by_key], offsets[by_key]))
        return out

    @staticmethod
    def _edit(item: np.ndarray, edits: int, kind: str, random: np.random.Generator) -> np.ndarray:
        """``item`` with random edits of ``kind`` (or of any): substitutions and insertions of foreign words (code 0), deletions."""
        out = item.tolist()
        for _ in range(edits):
            one = EDIT_KINDS[int(random.integers(1, len(EDIT_KINDS)))] if kind == "mixed" else kind
            at = int(random.integers(len(out)))
            if one == "insert":
                out.insert(at, 0)
            elif one == "delete" and len(out) > 1:
                del out[at]
            else:
                out[at] = 0
        return np.array(out, dtype=np.int32)

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return ((left * _MIX ^ right) * _MIX >> np.uint64(64 - PAIR_BITS)).astype(np.int64)

    # -- search -------------------------------------------------------------

    def search(self, texts: list[str]) -> list[list[dict]]:
        """Verified hits of each text, one per item: the passage with the fewest edits (the first of equals)."""
        get = self.vocabulary.get
        hits: list[list[dict]] = [[] for _ in texts]
        if not self.classes:
            return hits
        least = min(max(n - 1 - 2 * math.floor(self.max_edits * n), 0) for c in self.classes for n in c.sizes)
        picked, lists = [], []  # documents with enough pairs for some item
        for k, text in enumerate(texts):
            parts = []
            for segment in text_segments(text):
                words = words_of(segment)
                parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
            codes = parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, dtype=np.int32), *parts])
            if len(codes) and (least == 0 or np.count_nonzero(self._known_pairs(codes)) >= least):
                picked.append(k)
                lists.append(codes)
        if not picked:
            return hits
        codes = np.concatenate(lists)
        ends = np.cumsum([len(x) for x in lists])
        n_codes = len(codes)
        known = np.concatenate([[0], np.cumsum(codes > 0, dtype=np.int32)])
        pairs = np.concatenate([[0], np.cumsum(self._known_pairs(codes), dtype=np.int32), [0]])
        pairs[n_codes:] = pairs[n_codes - 1]
        words = self.hashed[codes]
        every = np.arange(n_codes)
        found = []
        for c in self.classes:
            # windows [s, s + n + k): pairs that start before the last word, and known words, for some n of the class
            limits = [(n, math.floor(self.max_edits * n)) for n in c.sizes]
            widest, fewest = max(n + k for n, k in limits), min(max(n - 1 - 2 * k, 0) for n, k in limits)
            at = np.nonzero(pairs[np.minimum(every + widest, n_codes)] - pairs[:n_codes] >= fewest)[0]
            may = np.zeros(len(at), dtype=bool)
            for n, k in limits:
                high = np.minimum(at + n + k, n_codes)
                may |= (pairs[high - 1] - pairs[at] >= n - 1 - 2 * k) & (known[high] - known[at] >= n - k)
            starts = at[may]
            if c.pieces:
                found.append(self._around_pieces(words, starts, widest, c, ends))
                continue
            for low in range(0, len(starts), WALK_ROWS):
                found.append(self._candidates(words, starts[low : low + WALK_ROWS], c))
        candidates = np.unique(np.concatenate([np.zeros((0, 2), dtype=np.int64), *found]), axis=0)
        own: list[list[dict]] = [[] for _ in picked]
        self._verify(codes, ends, candidates, own)
        for k, found_here in zip(picked, own, strict=True):
            hits[k] = found_here
        return hits

    def _known_pairs(self, codes: np.ndarray) -> np.ndarray:
        """Whether each adjacent pair of words may be a pair of some item."""
        both = (codes[:-1] > 0) & (codes[1:] > 0)
        at = np.nonzero(both)[0]
        both[at] = self.pairs[self._pair(self.hashed[codes[at]], self.hashed[codes[at + 1]])]
        return both

    @staticmethod
    def _candidates(words: np.ndarray, starts: np.ndarray, c: LengthClass) -> np.ndarray:
        """(item, window start) pairs with an equal key in some repetition."""
        out = []
        for multipliers, table in c.walks:
            keys = walk_keys(words, starts, multipliers, [r.steps for r in table])
            for r, key in zip(table, keys, strict=True):
                entry, hit = equal_keys(r.keys, key)
                out.append(np.stack([r.items[entry], starts[hit]], axis=1))
        return np.concatenate([np.zeros((0, 2), dtype=np.int64), *out])

    @staticmethod
    def _around_pieces(words: np.ndarray, starts: np.ndarray, widest: int, c: LengthClass, ends: np.ndarray) -> np.ndarray:
        """(item, place of its first word) pairs where a piece of the item lies in a window of ``widest`` words."""
        inside = np.zeros(len(words) + 1, dtype=np.int32)
        np.add.at(inside, starts, 1)
        np.add.at(inside, np.minimum(starts + widest, len(words)), -1)
        places = np.nonzero(np.cumsum(inside[:-1]))[0]
        begins = np.concatenate([[0], ends[:-1]])
        out = []
        for piece in c.pieces:
            at = places[places <= len(words) - piece.length]
            entry, hit = equal_keys(piece.keys, piece_keys(words, at, piece.length))
            begin = begins[np.searchsorted(ends, at[hit], side="right")]
            out.append(np.stack([piece.items[entry], np.maximum(at[hit] - piece.offsets[entry], begin)], axis=1))
        return np.concatenate([np.zeros((0, 2), dtype=np.int64), *out])

    def _verify(self, codes: np.ndarray, ends: np.ndarray, pairs: np.ndarray, hits: list[list[dict]]) -> None:
        document = np.searchsorted(ends, pairs[:, 1], side="right")
        begins = np.concatenate([[0], ends[:-1]])
        for item in np.unique(pairs[:, 0]):
            words, limit = self.items[item], self.limits[item]
            rows = pairs[:, 0] == item
            doc, start = document[rows], pairs[rows, 1]
            low = np.maximum(start - limit, begins[doc])
            width = len(words) + 3 * limit
            best: dict[int, tuple[int, int]] = {}
            for part in range(0, len(doc), 2048):
                d, a = doc[part : part + 2048], low[part : part + 2048]
                at = a[:, None] + np.arange(width)
                region = np.where(at < ends[d][:, None], codes[np.minimum(at, len(codes) - 1)], -1)
                edits, end = passage_edits(words, region)
                for k in np.nonzero(edits <= limit)[0]:
                    value = (int(edits[k]), int(a[k] + end[k] - begins[d[k]]))
                    best[int(d[k])] = min(value, best.get(int(d[k]), value))
            for d, (edits, end) in best.items():
                hits[d].append(
                    {"item_id": self.ids[item], "start_word": max(0, end - len(words)), "end_word": end,
                     "edits": edits, "item_words": len(words)}
                )
        for h in hits:
            h.sort(key=lambda x: (x["item_id"], x["start_word"]))


_LOADED: dict[str, Index] = {}


def _index(name: str, broadcast, options: tuple) -> Index:
    """The worker's index of the block called ``name``, built once per process."""
    if name not in _LOADED:
        if len(_LOADED) > 1:
            _LOADED.clear()
        _LOADED[name] = Index(broadcast.value, *options)
    return _LOADED[name]


def item_blocks(benchmark: DataFrame, block_items: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_items``, one block on the driver at a time."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    blocks = max(1, math.ceil(items.count() / block_items))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        yield sorted((r["item_id"], r["text"]) for r in rows.collect() if r["item_id"] is not None)


_KIND = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int32()), ("item_words", pa.int32()),
]))


def _leaks(items, options: tuple):
    """Function ``text column -> array of hits`` for one broadcast block of items."""
    name = uuid.uuid4().hex

    @F.arrow_udf(HITS)
    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = _index(name, items, options)
        for batch in (part for whole in batches for part in text_slices(whole)):
            yield pa.array(index.search(batch.to_pylist()), type=_KIND)

    return lambda text: leaks(empty_if_null(text))


def leak_columns(
    spark: SparkSession, benchmark: DataFrame, max_edits: float = 0.2, samples: int = 4, target: float = 0.99,
    block_items: int = 5_000, seed: int = 11,
):
    """For each block of items a function ``text column -> array of hits``."""
    for block in item_blocks(benchmark, block_items):
        yield _leaks(spark.sparkContext.broadcast(block), (max_edits, samples, target, seed))


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, start_word, end_word, edits, item_words): the best passage of each leaked item."""
    found = None
    for leaks in leak_columns(docs.sparkSession, benchmark, **options):
        part = docs.select("doc_id", F.explode(leaks("text")).alias("hit")).select("doc_id", "hit.*")
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents in which some item leaks."""
    columns = docs.columns
    for leaks in leak_columns(docs.sparkSession, benchmark, **options):
        name = unused_name(docs, "_leaks")
        docs = docs.withColumn(name, leaks("text")).where(F.size(name) == 0).select(columns)
    return docs
