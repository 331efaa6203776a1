"""Quality classifier: a sparse ensemble of rules over text statistics (operator 8).

1. ``statistics``: surface statistics of each whole text (one Arrow pass).
2. Rule candidates: every path from the root of a random forest of shallow
   trees (Spark ML), read as a conjunction of threshold tests.
3. Weights: logistic regression with an L1 penalty (Spark ML) over the
   rules' 0/1 values; most weights are zero.
4. ``RuleModel.score``: the remaining rules compiled into one Spark column
   expression over the statistics.

The model is fitted on the documents of at most about ``train_rows`` labels,
chosen by a hash of doc_id; all documents are scored.

Defined results: NULL text has the statistics of the empty text; texts of any
length have those of the whole text (they are read in pieces, with the open
line and the last word carried on); labels without a document, documents
without a label and NULL labels take no part in the fit; repeated rows count
as often as they occur and get equal scores; with labels of one class only
(or none) the score is the share of class 1 (0.5); an empty table gives no
rows; only doc_id and text are read, and filtering keeps all other columns,
whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_, eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from candela.llm.common import byte_segments, crc_mod, empty_if_null, stored, text_slices, unused_name

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "upper", "digits", "sentence_marks", "exclamations",
    "symbols", "bars", "blanks", "line_bytes", "beyond_ascii", "distinct_words", "top_word", "adjacent_repeats",
    "short_words", "distinct_lines", "top_line", "marked_words", "byte_entropy",
)
#: Byte classes counted per text.
_LOWER, _UPPER, _DIGIT, _MARK, _BANG, _SYMBOL, _BAR, _BLANK, _LINE, _HIGH = range(10)
_CLASS = np.full(256, _SYMBOL, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[list(b".,;:?'\"()-")] = _MARK
_CLASS[ord("!")] = _BANG
_CLASS[ord("|")] = _BAR
_CLASS[list(b" \t\r\x0b\x0c")] = _BLANK
_CLASS[ord("\n")] = _LINE
_CLASS[128:] = _HIGH


def statistics_of(text: bytes) -> list[float]:
    """The STATISTICS of one UTF-8 text."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    by_byte = np.zeros(256, dtype=np.int64)
    words: Counter[bytes] = Counter()
    lines: Counter[int] = Counter()
    n_words = word_bytes = longest = repeats = short = marked = 0
    last = b""  # the word before the segment
    line: list[bytes] = []  # the line that the segments so far left open
    for segment in byte_segments(text):
        by_byte += np.bincount(np.frombuffer(segment, dtype=np.uint8), minlength=256)
        found = segment.split()
        if found:
            words.update(found)
            sizes = list(map(len, found))
            n_words += len(found)
            word_bytes += sum(sizes)
            longest = max(longest, max(sizes))
            short += sum(x <= 3 for x in sizes)
            repeats += sum(map(eq, found, found[1:])) + (found[0] == last)
            last = found[-1]
            marked += sum(not w[-1:].isalnum() and w[-1] < 128 for w in found)
        first, *others = segment.split(b"\n")
        line.append(first)
        if others:
            lines[hash(b"".join(line))] += 1
            lines.update(map(hash, others[:-1]))
            line = [others[-1]]
    lines[hash(b"".join(line))] += 1
    count = np.bincount(_CLASS, weights=by_byte, minlength=10)
    share = count / n
    letters = max(1.0, count[_LOWER] + count[_UPPER])
    p = by_byte[by_byte > 0] / n
    n_lines = sum(lines.values())
    per_word = max(1, n_words)
    return [
        float(np.log1p(n)), float(np.log1p(n_words)), word_bytes / per_word, float(np.log1p(longest)),
        count[_UPPER] / letters, share[_DIGIT], share[_MARK], share[_BANG], share[_SYMBOL], share[_BAR], share[_BLANK],
        float(np.log1p(n / n_lines)), share[_HIGH], len(words) / per_word,
        max(words.values(), default=0) / per_word, repeats / per_word, short / per_word,
        len(lines) / n_lines, max(lines.values()) / n_lines, marked / per_word, float(-(p * np.log2(p)).sum()),
    ]


def statistics(text: str | Column) -> Column:
    """Struct column with one DOUBLE per name in STATISTICS."""

    @F.arrow_udf("struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">")
    def text_statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in (part for whole in batches for part in text_slices(whole)):
            rows = np.array([statistics_of(t) for t in batch.cast(pa.binary()).to_pylist()]).reshape(-1, len(STATISTICS))
            yield pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=list(STATISTICS))

    return text_statistics(empty_if_null(text))


Test = tuple[int, bool, float]  # (statistic, at most, threshold)


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[tuple[Test, ...], ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self, stats: str) -> Column:
        """Probability of class 1 as an expression over the struct column ``stats``."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + F.when(condition(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def condition(rule: tuple[Test, ...], stats: str) -> Column:
    """A conjunctive rule as a boolean column."""
    tests = [
        F.col(stats)[STATISTICS[k]] <= F.lit(t) if at_most else F.col(stats)[STATISTICS[k]] > F.lit(t)
        for k, at_most, t in rule
    ]
    return reduce(and_, tests)


def tree_paths(tree: str) -> list[tuple[Test, ...]]:
    """The conjunction of every node but the root, read from a tree's printed form.

    Tests of one statistic in the same direction are reduced to the
    tightest.
    """
    paths, stack = [], []
    for line in tree.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.eE]+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, (int(m[2]), m[3] == "<=", float(m[4]))))
        tightest: dict[tuple[int, bool], float] = {}
        for _, (k, at_most, t) in stack:
            old = tightest.get((k, at_most))
            tightest[k, at_most] = t if old is None else min(old, t) if at_most else max(old, t)
        paths.append(tuple(sorted((k, at_most, t) for (k, at_most), t in tightest.items())))
    return paths


def sample_by_hash(df: DataFrame, rows: int, id_col: str = "doc_id") -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if fewer): those whose hashed id is least."""
    n = df.count()
    if n <= rows:
        return df
    steps = 1 << 62
    return df.where(F.pmod(F.xxhash64(id_col), F.lit(steps)) < int(steps * rows / n))


def fit(labelled: DataFrame, trees: int = 24, depth: int = 3, penalty: float = 0.001, seed: int = 7) -> RuleModel:
    """Fit the ensemble to ``labelled``: doc_id, ``stats`` (struct) and ``label`` (0 or 1)."""
    # Rows in a fixed order in fixed partitions: forest and weights do not depend on how the join dealt them.
    ordered = labelled.repartition(6, "doc_id").sortWithinPartitions("doc_id", "label", "stats")
    train = stored(ordered, "quality-train")
    classes = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        return RuleModel((), (), {0: -20.0, 1: 20.0}.get(next(iter(classes), None), 0.0))
    flat = train.select(F.col("label").cast("double").alias("label"), "stats.*")
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(flat)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=seed, maxBins=64
    ).fit(vectors)
    rules = list(dict.fromkeys(path for tree in forest.trees for path in tree_paths(tree.toDebugString)))
    if not rules:
        share = classes[1] / sum(classes.values())
        return RuleModel((), (), float(np.log(share / (1 - share))))
    values = F.array(*[condition(r, "stats").cast("double") for r in rules])
    rows = train.select(F.col("label").cast("double").alias("label"), array_to_vector(values).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(rows)
    weights = lasso.coefficients.toArray()
    kept = [k for k in range(len(rules)) if weights[k] != 0]
    return RuleModel(
        tuple(rules[k] for k in kept), tuple(float(weights[k]) for k in kept), float(lasso.intercept)
    )


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, stats, label of about ``train_rows`` labelled documents outside the held-out fold.

    Labels are sampled before they meet the documents, so only the sample's
    texts are looked at, and they are found without moving any text.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & (crc_mod("doc_id", folds) != held_out)
    )
    known = F.broadcast(stored(sample_by_hash(known, train_rows), "quality-labels"))  # about train_rows small rows
    return docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", statistics("text").alias("stats"), "label")


def fitted(docs: DataFrame, labels: DataFrame, train_rows: int = 30_000, **options) -> RuleModel:
    """The ensemble fitted on a sample of the labelled documents."""
    return fit(training_rows(docs, labels, train_rows), **options)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = fitted(docs, labels, **options)
    stats = docs.select("doc_id", statistics("text").alias("stats"))
    scored = stats.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), model.score("stats").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    model = fitted(docs, labels, **options)
    name = unused_name(docs, "_stats")
    return docs.withColumn(name, statistics("text")).where(model.score(name) >= threshold).select(docs.columns)
