"""Nearest neighbours by inner product over randomly rotated one-bit codes (operator 10).

Index. A vector is scaled to unit length, padded with zeros to ``bits``
dimensions, turned by a random rotation and reduced to its signs: ``bits / 8``
packed bytes and two scalars, its length and the correction ``c`` (the inner
product of the turned vector with its own sign code). Every valid vector is
indexed; equal vectors share one entry.

Search. For a query ``q`` turned by the same rotation, ``<code, q> / c`` times
the vector's length estimates the inner product without bias, and its error
is within ``epsilon * |q| * length * sqrt((1 - c^2) / c^2 / (bits - 1))`` but
for a small probability. Each query's threshold is the k-th largest lower
bound over the whole index; the entries whose upper bound reaches it are
reranked by the exact inner product on the original vectors. As threshold and
upper bound each keep ``epsilon`` deviations, a true neighbour is lost only
where its estimate errs by about twice as many.

The queries are a table of blocks of at most ``BLOCK`` vectors, the codes one
of chunks of at most ``ROWS`` entries. Each of the two passes is one job in
which every chunk meets every block (the query set against all rows, in
blocks): the planner sends the blocks to all tasks while they are small, and
deals out (chunks x blocks) over tasks beyond that. The first pass returns
the k best lower bounds of each query and task, the second the entries over
the threshold. Nothing goes through the driver, and no vector is shuffled but
for the rerank.

Bounds are computed for queries of unit length and in DOUBLE (only the product
of signs and turned query is a float32 one), with lengths scaled by a power of
two, so that any finite vectors can be compared.

Defined results: vectors that are NULL, zero or hold a NULL or non-finite
component take no part, neither do rows without an id; of several vectors
with one id the least (as arrays) takes part; vectors shorter than the
longest are read as padded with zeros; with fewer candidates than ``k`` all
are returned; ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import stored

#: Queries of a block and code entries of a chunk: what is compared at one time.
BLOCK, ROWS = 1024, 2048
#: Lengths are stored times this power of two: those of finite vectors stay finite.
LENGTH_SCALE = 2.0**-16
#: Salts of the first level that gathers the ids of equal vectors.
SALTS = 256


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): finite, non-zero vectors as arrays of DOUBLE, one per id."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = table.where(F.col(id_col).isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


@lru_cache(maxsize=4)
def rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """The first ``dim`` rows of a random orthogonal matrix of order ``bits``: orthonormal rows."""
    gauss = np.random.default_rng(seed).standard_normal((bits, dim))
    return np.linalg.qr(gauss)[0].T


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array column, padded with zeros to ``dim``."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim))
    out[np.arange(dim) < size[:, None]] = flat
    return out


def encode(entries: DataFrame, dim: int, bits: int, seed: int) -> DataFrame:
    """(entry, code, length, c) of each vector of ``entries`` (entry, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim, bits, seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), dim)
            largest = np.abs(x).max(axis=1, keepdims=True)  # scaled first: squares neither overflow nor vanish
            scaled = x / largest
            norm = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
            turned = (scaled / norm) @ turn
            code = np.packbits(turned > 0, axis=1)
            c = np.abs(turned).sum(axis=1) / math.sqrt(bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("entry"), pa.array([row.tobytes() for row in code], type=pa.binary()),
                 pa.array((norm * (largest * LENGTH_SCALE))[:, 0]), pa.array(c)],
                names=["entry", "code", "length", "c"],
            )

    return entries.select("entry", "v").mapInArrow(run, "entry long, code binary, length double, c double")


def _bounds(batches: Iterator[pa.RecordBatch], queries: np.ndarray, dim: int, bits: int, seed: int, epsilon: float):
    """(entries, lower, upper) per slice of codes: bounds [entry, query] of the products with the query scaled to unit length."""
    unit = queries / np.abs(queries).max(axis=1, keepdims=True)
    unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    turned = (unit @ rotation(dim, bits, seed)).astype(np.float32)
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            packed = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
            signs = np.unpackbits(packed, axis=1, count=bits).astype(np.float32) * 2 - 1
            length, c = batch.column("length").to_numpy(), batch.column("c").to_numpy()
            scale = (length / c / math.sqrt(bits))[:, None]
            error = (length * np.sqrt(np.maximum(1 - c * c, 0) / (c * c) / (bits - 1)) * epsilon + length * 1e-5)[:, None]
            estimate = (signs @ turned.T) * scale
            yield batch.column("entry").to_numpy(), estimate - error, estimate + error


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def in_blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(``name``, payload): the rows packed by at most ``size``, where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                yield pa.RecordBatch.from_arrays([pa.array([_packed(whole.slice(at, size))], pa.binary())], names=["payload"])

    return rows.mapInArrow(run, "payload binary").select(F.monotonically_increasing_id().alias(name), F.col("payload").alias(f"{name}_rows"))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch, pa.RecordBatch, int]]:
    """(codes, queries, batch, row) of every chunk of codes that meets a block of queries."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield _unpacked(batch.column("chunk_rows")[k].as_py()), _unpacked(batch.column("block_rows")[k].as_py()), batch, k


def _best_lower(k: int, **index):
    """Task: per query the ``k`` largest lower bounds over the task's codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by block
        for codes, block, batch, row in _met(batches):
            name, queries = batch.column("block")[row].as_py(), block.column("entry").to_numpy()
            for _, lower, _ in _bounds(iter([codes]), _matrix(block.column("v"), index["dim"]), **index):
                held = np.concatenate([best[name][1], lower]) if name in best else lower
                best[name] = queries, np.partition(held, len(held) - k, axis=0)[-k:] if len(held) > k else held
        for queries, held in best.values():
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(queries, len(held))), pa.array(held.ravel())], names=["query", "lower"])

    return run


def _over(**index):
    """Task: (query, entry) pairs whose upper bound reaches the query's threshold (column ``low``, in the block's order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, block, batch, row in _met(batches):
            queries, low = block.column("entry").to_numpy(), np.array(batch.column("low")[row].as_py())
            low = np.where(np.isfinite(low), low, -math.inf)
            for entries, _, upper in _bounds(iter([codes]), _matrix(block.column("v"), index["dim"]), **index):
                e, q = np.nonzero(~(upper < low[None, :]))
                yield pa.RecordBatch.from_arrays([pa.array(queries[q]), pa.array(entries[e])], names=["query", "entry"])

    return run


def inner_product(a: str, b: str) -> F.Column:
    """Sum of products in DOUBLE from the first component on; the shorter vector counts as padded with zeros."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0.0)) * F.coalesce(y, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def with_thresholds(blocks: DataFrame, kth: DataFrame) -> DataFrame:
    """``blocks`` with ``low``: the threshold of each of its queries, in order (none: minus infinity)."""

    @F.arrow_udf("array<long>")
    def names(payloads: pa.Array) -> pa.Array:
        return pa.array([_unpacked(p).column("entry").to_pylist() for p in payloads.to_pylist()], pa.list_(pa.int64()))

    places = blocks.select("block", F.posexplode(names("block_rows")).alias("at", "query"))
    low = places.join(kth, "query", "left").select("block", "at", F.coalesce("kth", F.lit(-math.inf)).alias("x"))
    low = low.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda e: e["x"]).alias("low"))  # at most BLOCK each
    return blocks.join(low, "block")


def nearest(
    table: DataFrame, query_every: int = 20, k: int = 20, bits_per_dim: int = 12, epsilon: float = 1.9, seed: int = 5
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each row whose id is divisible by ``query_every``."""
    spark = table.sparkSession
    vectors = stored(valid_vectors(table), "ann-vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = vectors.agg(F.max(F.size("v"))).head()[0]
    if dim is None:
        return empty
    bits = max(64, math.ceil(bits_per_dim * dim / 64) * 64)
    # Equal vectors share an entry, named by their least id; more than the k + 1 least ids are never an answer.
    least = lambda ids: F.slice(F.array_sort(ids), 1, k + 1)
    entries = stored(
        vectors.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("salt"))
        .agg(least(F.collect_list("vec_id")).alias("ids"))
        .groupBy("v").agg(least(F.flatten(F.collect_list("ids"))).alias("ids"))
        .select(F.element_at("ids", 1).alias("entry"), "v", "ids"),
        "ann-entries",
    )
    index = dict(dim=dim, bits=bits, seed=seed, epsilon=epsilon)
    codes = stored(encode(entries, dim, bits, seed), "ann-codes")

    # Queries with equal vectors are searched once: query_id -> the entry of its vector.
    ids = vectors.where(F.col("vec_id") % query_every == 0)
    asked = stored(ids.join(entries.select("v", "entry"), "v").select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")), "ann-asked")
    searched = stored(entries.join(asked.select(F.col("query").alias("entry")).distinct(), "entry", "left_semi").select("entry", "v"), "ann-queries")
    chunks = stored(in_blocks(codes, ROWS, "chunk"), "ann-chunks")
    blocks = stored(in_blocks(searched, BLOCK, "block"), "ann-blocks")
    lows = chunks.crossJoin(blocks).select("chunk_rows", "block", "block_rows").mapInArrow(_best_lower(k + 1, **index), "query long, lower double")
    by_query = Window.partitionBy("query").orderBy(F.desc("lower"))
    kth = lows.withColumn("at", F.row_number().over(by_query)).where(F.col("at") == k + 1).select("query", F.col("lower").alias("kth"))
    asked_blocks = stored(with_thresholds(blocks, kth), "ann-asked-blocks")
    met = chunks.crossJoin(asked_blocks).select("chunk_rows", "block", "block_rows", "low")
    pairs = met.mapInArrow(_over(**index), "query long, entry long")
    asking = searched.select(F.col("entry").alias("query"), F.col("v").alias("q"))
    found = pairs.join(entries, "entry").join(asking, "query").select("query", "ids", inner_product("q", "v").alias("score"))

    # k + 1 entries hold k other rows at least, whichever row asks.
    top = Window.partitionBy("query").orderBy(F.desc("score"), F.element_at("ids", 1))
    kept = stored(
        found.withColumn("at", F.row_number().over(top)).where(F.col("at") <= k + 1).select("query", "ids", "score"), "ann-kept"
    )
    answers = asked.join(kept, "query").select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
