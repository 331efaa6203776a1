"""Source divergence audit by a frequent-pattern tree of term rows (operator 13).

Terms are runs of ASCII letters and non-ASCII code points, A-Z lower-cased.
Each lang keeps the terms that enough of its documents hold. Every group
(lang, source) gives each kept term a smoothed share p of its occurrences,
in whole numbers. The audit reports how far the shares of any two sources of
a lang lie apart (``pair``: sum of |p - q| over all kept terms), and which
terms a source holds more of than its lang (``term``: p - q, the largest).

Most terms occur in few sources, so the pair sums are built from the shares
of absent terms plus corrections. With p0 the share of an absent term:

* all kept terms at first count as absent from both sources: V * |p0 - q0|;
* a term that one source holds adds |p - q0| - |p0 - q0|, which depends only
  on (source, count): once per distinct count of a source, times its terms;
* a term that both hold adds |p - q| - |p - q0| - |p0 - q| + |p0 - q0|.

The last sum goes over a tree. A term's row is its nonzero counts in source
order; equal rows become one with a multiplicity, and rows with a common
beginning share that path from the root, so that a node's multiplicity is
the number of terms below it. Each pair of a node and one of its ancestors
gives one correction, times the node's multiplicity, however many terms run
through both. The rows are dealt to tasks by ranges of their first items (and
of a hash, where one beginning holds most rows) and sorted there, so a task
walks its part of the tree depth first and holds one path of it at a time;
a path that several tasks share is counted in parts. ``TASK_ROWS`` sets the
number of ranges, so that the sample behind their bounds stays small.

Arithmetic is exact: shares are computed in decimals, all sums in 64-bit
integers (a sum over all terms is at most a few times ``scale`` plus V).

Scale: texts are read once and counted per task before the shuffle, so a
lang, source or term that holds a third of all rows arrives as one row per
task. After that only (lang, source, term) counts move. Tables of groups
have one row per source; the planner joins them by their stored size. The
pair part has as many rows as the contract asks for, one per ordered pair of
sources of a lang.

Defined results: NULL text, lang and source count as empty text; an empty
text still makes its group occur; repeated rows are documents of their own;
ties of a value rank by the item's UTF-8 bytes; a lang without kept terms
has value 0 for its pairs; an empty table gives no rows; texts of any length
are counted whole; only the three named columns are read, so others may have
any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import byte_segments, stored

#: Bytes of terms stay (A-Z as a-z), all others become blanks.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: Distinct (lang, source, term) that a task counts before it hands them on.
HELD_TERMS = 400_000
#: Term rows of one task, and items of a row that its range goes by.
TASK_ROWS, RANGE_ITEMS = 20_000, 4
#: Cells of pair sums that a task holds before it hands them on.
HELD_PAIRS = 4_000_000


# -- counting ---------------------------------------------------------------


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task's rows, and one row without a term for each of its groups."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = [None, *n.keys()]
            yield pa.record_batch(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *(docs.get(t, 0) for t in n)], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        columns = [batch.column(k) for k in range(3)]
        for lang, source, text in zip(*columns, strict=True):
            key = (lang.as_py() or "", source.as_py() or "")
            n, docs = counts.setdefault(key, (Counter(), Counter()))
            size = len(n)
            mine: set[bytes] = set()
            for part in byte_segments((text.as_py() or "").encode().translate(_FOLD)):
                terms = part.split()
                n.update(terms)
                mine.update(terms)
            docs.update(mine)
            held += len(n) - size
            if held >= HELD_TERMS:
                yield from handed_on()
                counts, held = {}, 0
    yield from handed_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` of every (lang, source, term); a NULL term for every group."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = texts.mapInArrow(count_batches, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# -- shares -----------------------------------------------------------------


def share(count: Column, total: Column, terms: Column, smooth: int, scale: int) -> Column:
    """1 + floor(scale * (count + smooth) / (total + smooth * terms)); NULL if the lang has no kept term."""
    wide = lambda c: c.cast("decimal(19,0)")
    part = F.lit(scale).cast("decimal(18,0)") * wide(count + smooth)
    whole = wide(total + terms * smooth)
    return F.when(terms > 0, F.call_function("div", part, whole) + 1)


# -- the tree ---------------------------------------------------------------


class PairSums:
    """Sums over pairs of sources of one lang, kept as one row of numbers per source."""

    def __init__(self, lang: str):
        self.lang, self.code, self.sums, self.cells = lang, {}, {}, 0

    def code_of(self, source: str) -> int:
        return self.code.setdefault(source, len(self.code))

    def add(self, source: int, others: np.ndarray, values: np.ndarray) -> None:
        row = self.sums.get(source)
        if row is None or len(row) < len(self.code):
            wider = np.zeros(2 * len(self.code), dtype=np.int64)
            if row is not None:
                wider[: len(row)] = row
            self.cells += len(wider) - (0 if row is None else len(row))
            row = self.sums[source] = wider
        row[others] += values

    def handed_on(self) -> Iterator[pa.RecordBatch]:
        names = list(self.code)
        for source, row in self.sums.items():
            others = np.nonzero(row)[0]
            if len(others):
                yield pa.record_batch(
                    [
                        pa.array([self.lang] * len(others), pa.string()),
                        pa.array([names[source]] * len(others), pa.string()),
                        pa.array([names[k] for k in others], pa.string()),
                        pa.array(row[others]),
                    ],
                    names=["lang", "source", "item", "value"],
                )
        self.sums, self.cells = {}, 0


class Path:
    """The nodes from the root to the walk's place: source, share, absent share and multiplicity of each."""

    def __init__(self) -> None:
        self.depth, self.keys, self.times = 0, [], []
        self.source, self.p, self.p0 = (np.zeros(64, dtype=np.int64) for _ in range(3))

    def push(self, key: tuple, source: int, p: int, p0: int) -> None:
        if self.depth == len(self.p):
            self.source, self.p, self.p0 = (np.concatenate([x, np.zeros_like(x)]) for x in (self.source, self.p, self.p0))
        self.source[self.depth], self.p[self.depth], self.p0[self.depth] = source, p, p0
        self.keys.append(key)
        self.times.append(0)
        self.depth += 1

    def pop(self, sums: PairSums) -> None:
        """Leave the deepest node: one correction for each of its ancestors."""
        self.depth -= 1
        d, times = self.depth, self.times.pop()
        self.keys.pop()
        if not d:
            return
        self.times[-1] += times
        p, p0, q, q0 = self.p[d], self.p0[d], self.p[:d], self.p0[:d]
        both = np.abs(p - q) - np.abs(p - q0) - np.abs(p0 - q) + np.abs(p0 - q0)
        sums.add(int(self.source[d]), self.source[:d], both * times)


def walk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pair corrections of a task's rows (lang, path, times), which come sorted by (lang, path)."""
    sums: PairSums | None = None
    path = Path()
    for batch in batches:
        langs, times = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        ends = batch.column(1).offsets.to_numpy().tolist()
        items = batch.column(1).values
        source, n, p, p0 = (items.field(k).to_pylist() for k in range(4))
        for row, lang in enumerate(langs):
            if sums is None or sums.lang != lang or sums.cells >= HELD_PAIRS:
                while path.depth:
                    path.pop(sums)
                if sums is not None:
                    yield from sums.handed_on()
                sums = PairSums(lang)
            at, end = ends[row], ends[row + 1]
            common = 0
            while common < path.depth and at + common < end and path.keys[common] == (source[at + common], n[at + common]):
                common += 1
            while path.depth > common:
                path.pop(sums)
            for k in range(at + common, end):
                path.push((source[k], n[k]), sums.code_of(source[k]), p[k], p0[k])
            path.times[-1] += times[row]
    if sums is not None:
        while path.depth:
            path.pop(sums)
        yield from sums.handed_on()


def tree_corrections(rows: DataFrame) -> DataFrame:
    """(lang, source, item, value) of terms that both sources hold, from ``rows`` (lang, path, times)."""
    tasks = max(1, math.ceil(rows.count() / TASK_ROWS))
    ranged = rows.repartitionByRange(tasks, "lang", F.slice("path", 1, RANGE_ITEMS), F.xxhash64("path"))
    ordered = ranged.sortWithinPartitions("lang", "path")
    walked = ordered.select("lang", "path", "times").mapInArrow(walk_rows, "lang string, source string, item string, value long")
    return walked.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


# -- the audit ----------------------------------------------------------------


def audit(docs: DataFrame, *, min_docs: int = 30, smooth: int = 5, scale: int = 10**9, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank of the parts ``pair`` and ``term``."""
    counts = stored(term_counts(docs), "divergence-counts")
    named = counts.where(F.col("term").isNotNull())
    kept = named.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("held")
    )
    kept = stored(kept.where(F.col("docs") >= min_docs).drop("docs"), "divergence-kept")
    entries = kept.select("lang", "term", "total", F.inline("held"))

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("source_total"))
    groups = counts.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.fillna(0, ["terms", "lang_total", "source_total"])
    absent = share(F.lit(0), F.col("source_total"), F.col("terms"), smooth, scale)
    groups = stored(groups.withColumn("p0", absent), "divergence-groups")

    shares = entries.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "p0",
        share(F.col("n"), F.col("source_total"), F.col("terms"), smooth, scale).alias("p"),
        share(F.col("total"), F.col("lang_total"), F.col("terms"), smooth, scale).alias("q"),
    )
    return pair_part(shares, groups).unionByName(term_part(shares, top)).select(
        "lang", "source", "part", "item", "value", "rank"
    )


def ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def term_part(shares: DataFrame, top: int) -> DataFrame:
    """The ``top`` terms of each group by its share over the lang's (every task keeps at most ``top`` before the shuffle)."""
    over = shares.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return ranked(over, "term").where(F.col("rank") <= top)


def pair_part(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of the lang with the distance of its shares."""
    paths = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "n", "p", "p0"))).alias("path"))
    rows = stored(paths.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times")), "divergence-rows")
    both = tree_corrections(rows)

    levels = rows.select("lang", "times", F.inline("path")).groupBy("lang", "source", "p", "p0").agg(F.sum("times").alias("times"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), "terms")
    one = levels.join(others, "lang").where(F.col("source") != F.col("item"))
    correction = F.col("times") * (F.abs(F.col("p") - F.col("q0")) - F.abs(F.col("p0") - F.col("q0")))
    one = one.groupBy("lang", "source", "item").agg(F.sum(correction).alias("value"))

    base = groups.select("lang", "source", "p0").join(others, "lang").where(F.col("source") != F.col("item"))
    base = base.select("lang", "source", "item", F.coalesce(F.col("terms") * F.abs(F.col("p0") - F.col("q0")), F.lit(0)).alias("value"))

    halves = one.unionByName(both)
    turned = halves.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    sums = base.unionByName(halves).unionByName(turned).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return ranked(sums, "pair")
