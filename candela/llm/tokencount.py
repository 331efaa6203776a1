"""Token counts by a separator scan over flat token files (operator 6).

Writing. Documents are encoded and written as flat files of little-endian
unsigned 16-bit ids (32-bit where the ids need it), each document followed
by the end-of-document id; there is no index beside them. Spark's text
writer does it: a row's bytes are written as they are and the line
separator is the end-of-document id. A file holds at most
``documents_per_file`` documents, and so few of them that it stays under
``FILE_BYTES`` if all were as long as the longest: files are the units of the
scan, and a task holds one at a time.

Counting. A file is searched in blocks of ``block_tokens`` tokens: each
block is one numpy comparison, independent of its neighbours, and yields the
positions of its separators. A prefix scan over a file's blocks (a window
over one narrow row per block) carries the number of separators and the last
separator's position into the next block, which stitches the documents that
cross block borders and numbers them.

The ledger of written documents (shard, file, position -> doc_id, bytes) is a
second, cheap evaluation of the same splits of the same input, without
encoding. The scan therefore sums the bytes that each counted document's
tokens stand for, and every document must have the bytes that the ledger
says: if the rows came in another order the second time, the query fails
rather than swap documents. ``store_input`` writes ids and texts first, for
inputs whose order is not fixed (a shuffle); a table's files have one order.

Defined results: NULL and empty texts have no tokens and are counted as 0;
tokens after a file's last separator are a document of their own; repeated
rows are counted each; an empty table gives an empty result; texts of any
length that a row can hold are counted whole, a very long one in a file of
its own; only doc_id and text are read, other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.llm.bpe import Tokenizer
from candela.llm.common import stored

#: Rows that monotonically_increasing_id numbers within a partition.
_ROW_BITS = 33
#: Bytes of a token file, unless one document needs more.
FILE_BYTES = 256 << 20


def id_width(largest: int) -> int:
    """Bytes of an id: 2 where all ids fit, else 4."""
    return 2 if largest < 1 << 16 else 4


def write_tokens(docs: DataFrame, tokenizer: Tokenizer, end_id: int, path: str, documents_per_file: int = 5_000) -> DataFrame:
    """Write the flat files of ``docs`` under ``path``; returns (doc_id, shard, file, position, n_bytes)."""
    width = id_width(end_id)
    longest = docs.agg(F.max(F.octet_length("text"))).first()[0] or 0  # a text has at most as many tokens as bytes
    documents_per_file = max(1, min(documents_per_file, FILE_BYTES // (width * (longest + 1))))
    separator = end_id.to_bytes(width, "little").decode("latin-1")
    (
        docs.select(tokenizer.encode("text", width).cast("string").alias("value"))
        .write.option("lineSep", separator).option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", documents_per_file).text(path)
    )
    row = F.monotonically_increasing_id()
    number = row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return stored(
        docs.select(
            "doc_id", F.shiftright(row, _ROW_BITS).cast("int").alias("shard"),
            F.floor(number / documents_per_file).cast("int").alias("file"), (number % documents_per_file).alias("position"),
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        ),
        "token-ledger",
    )


def scan_blocks(tokens: np.ndarray, end_id: int, block_tokens: int) -> Iterator[tuple[int, np.ndarray]]:
    """(block, positions of its separators in the file) for every block."""
    for block, at in enumerate(range(0, len(tokens), block_tokens)):
        yield block, np.nonzero(tokens[at : at + block_tokens] == end_id)[0] + at


def bytes_between(tokens: np.ndarray, cuts: np.ndarray, token_bytes: np.ndarray) -> np.ndarray:
    """Bytes that the tokens of a block stand for up to each of ``cuts`` (places in the block), and up to its end."""
    so_far = np.concatenate([[0], np.cumsum(token_bytes[tokens])])
    return so_far[np.concatenate([cuts, [len(tokens)]])]


def find_separators(
    spark: SparkSession, path: str, end_id: int, token_bytes: np.ndarray, block_tokens: int = 1 << 20
) -> DataFrame:
    """(shard, file, block, tokens, separators, bytes): one row per block.

    ``tokens`` is the file's length so far; ``bytes`` counts the block's bytes
    up to each separator and up to its end (``token_bytes``: bytes of an id).
    """
    dtype = f"<u{id_width(end_id)}"
    sizes = np.zeros(max(end_id + 1, len(token_bytes)), dtype=np.int64)
    sizes[: len(token_bytes)] = token_bytes
    sizes[end_id] = 0
    sent = spark.sparkContext.broadcast(sizes)  # one number per id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                content = batch.column("content")[k].as_buffer()
                tokens = np.frombuffer(content, dtype=dtype)
                name = [batch.column("shard")[k].as_py(), batch.column("file")[k].as_py()]
                blocks = list(scan_blocks(tokens, end_id, block_tokens))
                part = lambda b: tokens[b * block_tokens : (b + 1) * block_tokens]
                sums = [bytes_between(part(b), p - b * block_tokens, sent.value) for b, p in blocks]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name[0]] * len(blocks), type=pa.int32()), pa.array([name[1]] * len(blocks), type=pa.int32()),
                        pa.array([b for b, _ in blocks], type=pa.int32()),
                        pa.array([min(len(tokens), (b + 1) * block_tokens) for b, _ in blocks], type=pa.int64()),
                        pa.array([p for _, p in blocks], type=pa.list_(pa.int64())), pa.array(sums, type=pa.list_(pa.int64())),
                    ],
                    names=["shard", "file", "block", "tokens", "separators", "bytes"],
                )

    name = r"part-(\d+)-.*-c(\d+)[^/]*$"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(
        F.regexp_extract("path", name, 1).cast("int").alias("shard"), F.regexp_extract("path", name, 2).cast("int").alias("file"),
        "content",
    )
    return files.mapInArrow(run, "shard int, file int, block int, tokens long, separators array<long>, bytes array<long>")


def document_counts(blocks: DataFrame) -> DataFrame:
    """(shard, file, position, start_token, n_tokens, n_bytes) of every document, stitched over the blocks."""
    blocks = stored(blocks, "token-blocks")
    before = Window.partitionBy("shard", "file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("shard", "file")
    heads = blocks.select(
        "shard", "file", "block", "tokens", F.size("separators").cast("long").alias("n"), F.try_element_at("separators", F.lit(-1)).alias("last"),
        F.element_at("bytes", -1).alias("size"),
        F.when(F.size("separators") > 0, F.element_at("bytes", -2)).alias("closed"),  # the block's bytes up to its last separator
    )
    scanned = heads.select(
        "shard", "file", "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("numbered"),
        F.coalesce(F.last("last", ignorenulls=True).over(before) + 1, F.lit(0)).alias("carried"),
        (F.col("block") == F.max("block").over(whole)).alias("final"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("size_before"), "closed",
    )
    # the file's bytes up to the last separator before the block, where the document that is open there begins
    closed_at = F.last(F.col("size_before") + F.col("closed"), ignorenulls=True).over(before)
    scanned = scanned.withColumn("open_from", F.coalesce(closed_at, F.lit(0))).drop("closed")
    joined = blocks.join(scanned, ["shard", "file", "block"])
    # the tokens after the last separator of a file end at the file's end
    open_end = F.col("final") & (F.coalesce(F.try_element_at("separators", F.lit(-1)) + 1, F.col("carried")) < F.col("tokens"))
    ends = F.when(open_end, F.concat("separators", F.array("tokens"))).otherwise(F.col("separators"))
    starts = F.concat(F.array("carried"), F.transform("ends", lambda p: p + 1))
    # bytes of the file up to each end of a document; the first one of the block began at ``open_from``
    up_to = F.transform("bytes", lambda b: b + F.col("size_before"))
    spans = joined.withColumns({"ends": ends, "starts": starts, "up_to": F.concat(F.array("open_from"), up_to)})
    return spans.select(
        "shard", "file", "numbered", "starts", "up_to", F.posexplode("ends").alias("k", "end")
    ).select(
        "shard", "file", (F.col("numbered") + F.col("k")).alias("position"),
        F.element_at("starts", F.col("k") + 1).alias("start_token"),
        (F.col("end") - F.element_at("starts", F.col("k") + 1)).alias("n_tokens"),
        (F.element_at("up_to", F.col("k") + 2) - F.element_at("up_to", F.col("k") + 1)).alias("n_bytes"),
    )


def count_documents(
    docs: DataFrame, tokenizer: Tokenizer, end_id: int, path: str, store_input: bool = False, **options
) -> DataFrame:
    """doc_id, n_tokens, shard, file, position, start_token: written to flat files and counted from them."""
    docs = docs.select("doc_id", "text")
    if store_input:
        docs = stored(docs, "token-input")
    ledger = write_tokens(docs, tokenizer, end_id, path, **options)
    if ledger.isEmpty():
        return ledger.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), "shard", "file", "position", F.lit(0).cast("long").alias("start_token"))
    found = find_separators(docs.sparkSession, path, end_id, tokenizer.token_lengths())
    counts = document_counts(found).withColumnRenamed("n_bytes", "counted_bytes")
    both = stored(ledger.join(counts, ["shard", "file", "position"], "full"), "token-counts")
    if not both.where(~F.col("n_bytes").eqNullSafe(F.col("counted_bytes"))).isEmpty():
        raise RuntimeError("the token files do not hold the documents of the ledger: the input's order changed between two reads (store_input)")
    return both.select("doc_id", "n_tokens", "shard", "file", "position", "start_token")
