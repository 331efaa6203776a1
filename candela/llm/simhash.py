"""SimHash near-duplicates through a byte-position inverted index (operator 7).

A document's 64-bit fingerprint holds, per bit, the majority over the XXH64
values of its word shingles. Two fingerprints that differ in at most ``k``
bits share at least ``8 - k`` of their eight positional bytes (k <= 4), the
guaranteed minimum of the count filter.

Candidates. Posting lists of single positional bytes have a 256th of all
fingerprints each, so tallying over them would cost the square of the
corpus. The index therefore posts *groups of positional bytes*: a family of
byte-position sets such that every possible set of ``8 - k`` shared
positions contains one of them. Its entries are (positions, bytes) ->
fingerprint; each posting list is short. Within a list, the shared
positional bytes of each pair are tallied, pairs below the minimum are
dropped, and the rest are verified by their differing bits. ``key_bytes``
says how many bytes a group has: three make 23 entries a fingerprint and
about 23 / 2^24 of all pairs to tally; four (for corpora of more than some
10^9 distinct fingerprints) make 70 entries and 70 / 2^32 of the pairs.

Skew. Equal fingerprints are one entry. A long posting list is cut by hash
into chunks of at most ``CHUNK`` fingerprints on average, and each pair of
chunks is a group of its own, so no task holds a whole hot list. A group
returns no pairs: only the edges of a spanning forest of its links, at most
one per fingerprint. Components of these forests over all groups equal the
components of all links.

Components come from alternating neighbour-minimum and pointer-jumping
rounds over the forest edges, each written to the shared folder; nothing is
collected to the driver but a count per round.

Defined results: NULL or word-free text has fingerprint zero and is linked
like any other; texts of any length are read whole; repeated rows keep one
output row each; a NULL doc_id gets the smallest non-NULL id of its component
(NULL if there is none); an empty table gives no rows; only doc_id and text
are read, and dropping keeps all other columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from candela.llm.common import byte_segments, empty_if_null, stored, text_slices, unused_name

BYTES = 8
#: Fingerprints of one chunk of a posting list.
CHUNK = 1024
_SEED = 42  # of the shingle hash, as in Spark's xxhash64
_HASHES = 1 << 16  # hashes unpacked to bits at a time


def fingerprint_of(text: bytes, shingle_words: int) -> int:
    """Majority bits of the XXH64 values of the word shingles of one UTF-8 text."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    carry: list[bytes] = []
    hashes: list[int] = []
    digest = xxhash.xxh64_intdigest

    def count() -> None:
        nonlocal ones, total, hashes
        bits = np.unpackbits(np.array(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
        hashes = []

    for segment in byte_segments(text):
        words = carry + segment.lower().split()
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()
        starts = [0, *ends[:-1]]
        hashes += [
            digest(joined[a : b - 1], _SEED) for a, b in zip(starts, ends[shingle_words - 1 :], strict=False)
        ]
        carry = words[-(shingle_words - 1) :] if shingle_words > 1 else []
        if len(hashes) >= _HASHES:
            count()
    if not total and not hashes and carry:  # fewer words than a shingle: the whole sequence
        hashes = [digest(b" ".join(carry), _SEED)]
    if hashes:
        count()
    if not total:
        return 0
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def fingerprint(text: str | Column, shingle_words: int) -> Column:
    """Fingerprint column (BIGINT holding the 64 bits)."""

    @F.arrow_udf("bigint")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in (part for whole in batches for part in text_slices(whole)):
            prints = [fingerprint_of(t, shingle_words) for t in batch.cast(pa.binary()).to_pylist()]
            yield pa.array(np.array(prints, dtype=np.uint64).view(np.int64))

    return simhash(empty_if_null(text))


def position_sets(max_bits: int, key_bytes: int | None = None) -> list[tuple[int, ...]]:
    """Sets of ``key_bytes`` byte positions: every choice of ``8 - max_bits`` of the 8 positions contains one.

    Found greedily. By default the sets have one position less than the
    guaranteed number: three positions (2^24 lists per set) for four
    differing bits.
    """
    shared = BYTES - max_bits
    if shared < 1:
        raise ValueError("max_bits must be under 8: no shared byte is guaranteed")
    size = max(1, shared - 1) if key_bytes is None else key_bytes
    if key_bytes is not None and not 1 <= size <= min(shared, 6):
        raise ValueError(f"key_bytes must be from 1 to {min(shared, 6)}: so many bytes are shared for certain and fit a key")
    left = set(combinations(range(BYTES), shared))
    chosen = []
    while left:
        best = max(combinations(range(BYTES), size), key=lambda s: sum(set(s) <= set(x) for x in left))
        chosen.append(best)
        left = {x for x in left if not set(best) <= set(x)}
    return chosen


def _near(rows: np.ndarray, cols: np.ndarray, max_bits: int) -> np.ndarray:
    """Boolean matrix of links: tally the shared positional bytes, keep pairs at the minimum, verify them."""
    out = np.zeros((len(rows), len(cols)), dtype=bool)
    step = max(1, (1 << 20) // max(1, len(cols)))
    for at in range(0, len(rows), step):
        differ = rows[at : at + step, None] ^ cols[None, :]
        shared = (differ.view(np.uint8).reshape(*differ.shape, BYTES) == 0).sum(axis=2, dtype=np.uint8)
        i, j = np.nonzero(shared >= BYTES - max_bits)
        near = np.bitwise_count(differ[i, j]) <= max_bits
        out[at + i[near], j[near]] = True
    return out


def _forest(rows: np.ndarray, cols: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(least member, member) edges of each component of the links between ``rows`` and ``cols``."""
    link = _near(rows, cols, max_bits)
    new_row, new_col = np.ones(len(rows), dtype=bool), np.ones(len(cols), dtype=bool)
    edges = []
    for start in range(len(rows)):
        if not new_row[start]:
            continue
        new_row[start] = False
        at, members = np.array([start]), [rows[start : start + 1]]
        while len(at):  # from rows to the columns that they reach, and back
            hit = np.nonzero(link[at].any(axis=0) & new_col)[0]
            new_col[hit] = False
            members.append(cols[hit])
            at = np.nonzero(link[:, hit].any(axis=1) & new_row)[0]
            new_row[at] = False
            members.append(rows[at])
        found = np.unique(np.concatenate(members)).tolist()
        edges += [(found[0], x) for x in found[1:]]
    return edges


def _links(max_bits: int):
    """Task over sorted index entries: the forest edges of each group (key, low, high)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the last group so far, which the next batch may go on with
        for batch in batches:
            table = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)], axis=1)
            if not len(table):
                continue
            if held:
                table = np.concatenate([*held, table])
            change = np.nonzero((table[1:, :3] != table[:-1, :3]).any(axis=1))[0] + 1
            cut = change[-1] if len(change) else 0
            if cut:
                yield edges(table[:cut], np.concatenate([[0], change]))
            held = [table[cut:]]
        if held and len(held[0]):
            yield edges(held[0], np.array([0, len(held[0])]))

    def edges(table: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        size = np.diff(at)
        fp, own = table[:, 4].view(np.uint64), table[:, 3]
        two = at[:-1][(size == 2) & (table[at[:-1], 1] == table[at[:-1], 2])]
        differ = fp[two] ^ fp[two + 1]
        shared = (differ[:, None].view(np.uint8) == 0).sum(axis=1)
        keep = (shared >= BYTES - max_bits) & (np.bitwise_count(differ) <= max_bits)
        pairs = [np.stack([fp[two[keep]], fp[two[keep] + 1]], axis=1)]
        for k in np.nonzero((size > 2) | ((size == 2) & (table[at[:-1], 1] != table[at[:-1], 2])))[0]:
            part, side = fp[at[k] : at[k + 1]], own[at[k] : at[k + 1]]
            low, high = table[at[k], 1], table[at[k], 2]
            found = _forest(part, part, max_bits) if low == high else _forest(part[side == low], part[side == high], max_bits)
            pairs.append(np.array(found, dtype=np.uint64).reshape(-1, 2))
        both = np.sort(np.concatenate(pairs), axis=1).view(np.int64)  # an edge has one form, however its group's rows came
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return run


def forest_edges(prints: DataFrame, max_bits: int, key_bytes: int | None = None) -> DataFrame:
    """(a, b) edges whose components are those of all links between the distinct ``fp`` of ``prints``."""
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(0xFF).cast("long"))
    entries = []
    for k, positions in enumerate(position_sets(max_bits, key_bytes)):
        key = F.lit(k << 8 * len(positions)).cast("long")
        for at, p in enumerate(positions):
            key = key.bitwiseOR(F.shiftleft(byte(p), 8 * at))
        entries.append(key)
    index = prints.select("fp", F.explode(F.array(*entries)).alias("key"))
    long_lists = stored(
        index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK)
        .select("key", F.ceil(F.col("n") / CHUNK).cast("long").alias("chunks")),
        "simhash-long-lists",
    )
    chunked = index.join(long_lists, "key", "left").select(
        "key", "fp", F.coalesce("chunks", F.lit(1)).alias("chunks"),
        F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))).alias("own"),
    )
    # A fingerprint of chunk c goes to the groups of c with every chunk d of its list.
    dealt = chunked.select(
        "key", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    ).select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "fp")
    groups = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return groups.mapInArrow(_links(max_bits), "a long, b long")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, root, label): a name of the component (one of its fingerprints) and the smallest ``id`` reachable from each node over ``edges`` (a, b).

    ``nodes`` has (fp, id). Only nodes with edges iterate; each round takes
    the minimum over the neighbours' labels and then follows labels one
    step (labels are fingerprints while iterating), until nothing changes.
    """
    # Stored before both directions are made: two evaluations of the edges could name different ends first.
    edges = stored(edges.select("a", "b").distinct(), "simhash-forest")
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "simhash-edges"
    )
    labels = stored(both.groupBy(F.col("a").alias("fp")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "simhash-labels")
    while True:
        near = both.join(labels.withColumnRenamed("fp", "b"), "b").groupBy(F.col("a").alias("fp")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "fp").select("fp", F.least("label", "near").alias("new"), F.col("label").alias("old"))
        target = labels.select(F.col("fp").alias("new"), F.col("label").alias("jump"))
        jumped = stored(
            hooked.join(target, "new").select("fp", F.least("new", "jump").alias("label"), "old"), "simhash-labels"
        )
        labels = jumped.select("fp", "label")
        if jumped.where("label <> old").isEmpty():
            break
    member = nodes.join(labels, "fp", "left").select("fp", "id", F.coalesce("label", "fp").alias("root"))
    smallest = stored(member.groupBy("root").agg(F.min("id").alias("label")), "simhash-smallest")
    return member.join(smallest, "root").select("fp", "root", "label")


def _classified(
    docs: DataFrame, shingle_words: int, max_bits: int, text: str, *more: Column, key_bytes: int | None = None
) -> DataFrame:
    """doc_id, fp, root, component_id and the columns ``more``: one row per row of ``docs``."""
    prints = stored(docs.select("doc_id", fingerprint(text, shingle_words).alias("fp"), *more), "simhash-prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-distinct")
    classes = components(distinct, forest_edges(distinct.select("fp"), max_bits, key_bytes))
    return prints.join(classes.withColumnRenamed("label", "component_id"), "fp")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, text: str = "text", key_bytes: int | None = None
) -> DataFrame:
    """doc_id, fp (BIGINT), component_id: one row per row of ``docs``."""
    return _classified(docs, shingle_words, max_bits, text, key_bytes=key_bytes).select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    """Sixteen lowercase hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, key_bytes: int | None = None) -> DataFrame:
    """``docs`` with one document of each component: the row of its smallest doc_id.

    Rows go by doc_id and text, so a doc_id on several texts stays in each
    component whose smallest it is. Rows of one component that share its
    smallest doc_id are cut to one (the least by text); rows without a
    doc_id are left as they are.
    """
    key, root = unused_name(docs, "_key"), unused_name(docs, "_root")
    found = _classified(docs, shingle_words, max_bits, "text", F.xxhash64("text").alias(key), key_bytes=key_bytes)
    out = found.where("doc_id <> component_id").select("doc_id", key).distinct()
    keyed = docs.withColumn(key, F.xxhash64("text"))
    kept = keyed.join(stored(out, "simhash-dropped"), ["doc_id", key], "left_anti")
    first = found.where("doc_id = component_id").select("doc_id", key, F.col("root").alias(root))
    repeated = stored(first.groupBy(root).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(root), "simhash-repeated")
    if repeated.isEmpty():
        return kept.select(docs.columns)
    several = stored(first.join(repeated, root, "left_semi").distinct(), "simhash-several")
    once = kept.join(several.select("doc_id", key), ["doc_id", key], "left_anti")
    rest = kept.join(several, ["doc_id", key])
    ordered = [c for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind and "variant" not in kind]
    others = F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    least = rest.groupBy("doc_id", root).agg(F.min_by(others, F.struct("text", *ordered)).alias("row"))
    columns = [F.col("doc_id") if c == "doc_id" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return once.select(docs.columns).unionByName(least.select(columns))
