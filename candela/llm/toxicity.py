"""Toxicity scores of texts restored by noisy-channel deobfuscation (operator 9).

1. Character language model: trigram counts over the folded text of *all*
   documents (28 symbols: a-z, word border, any other character), summed by
   Spark; the driver gets at most 28^3 counts.
2. Deobfuscation: spans that may be disguised words (letters mixed with
   leetspeak digits or signs, letters spelled with separators, letters
   repeated three and more times) become character lattices. An edge of the
   lattice is a hidden letter with its channel cost, or the deletion of a
   separator or of a repeated letter. Viterbi decoding under the language
   model picks the hidden word. All other text is its own restoration.
3. Score: word and word-beginning features of the restored text with their
   log odds in labelled documents; a logistic regression (Spark ML) over a
   few sums of them gives the probability.

The classifier is fitted on at most about ``train_rows`` labelled rows,
chosen by a hash of doc_id; near copies among them count once (by a min-hash
of word 5-shingles), so that a large group of copies does not lend its
vocabulary to a class. The language model has no such bound.

Defined results: NULL text reads as empty and gets the score of a text
without any feature; labels without a document and NULL labels take no part;
with labels of one class only (or none) the score is 0 for class 0, 1 for
class 1 and 0 without labels; repeated rows get equal scores; an empty table
gives no rows; texts and spans of any length are restored whole (a span of
more than PIECE characters piece by piece); only doc_id and text are read,
other columns may have any name.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from candela.llm.common import crc_mod, empty_if_null, stored, text_slices
from candela.llm.quality import sample_by_hash

SYMBOLS = 28
BORDER, OTHER = 26, 27
#: Characters that are decoded at one time; a longer span is decoded piece by piece.
PIECE = 2000

# Signs that stand for letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = " .-_*~'​­"
# Costs of the channel, as log probabilities.
LEET_COST, MASK_COST, DROP_SEPARATOR, DROP_REPEAT, KEEP_REPEAT = -1.0, -3.3, -0.3, -0.4, -1.2

_CLASS = np.full(256, OTHER, dtype=np.uint16)
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _CLASS[ord(_c)] = _i
_CLASS[list(b" \t\n\r\x0b\x0c.,;:!?\"()")] = BORDER

_LETTER = "[a-z]"
#: Spans that may be disguised; every match is decoded on its own.
SUSPECT = re.compile(
    # letters one by one, with the same kinds of separators between them
    rf"(?<![\w]){_LETTER}(?:[ .\-_*~]{{1,2}}{_LETTER}){{2,}}(?![\w])"
    # a word with signs or digits among or before its letters
    rf"|(?<![\w@$]){_LETTER}*(?:(?:[0-9@$|+€£(]|[!*.\-_'​­](?={_LETTER}))+{_LETTER}+)+(?:[0-9$]+)?(?![\w])"
    # a word whose only signs come last
    rf"|(?<![\w@$]){_LETTER}+[0-9@$|+£*]{{1,3}}(?![\w])"
    # a letter three and more times
    rf"|(?<![\w]){_LETTER}*({_LETTER})\1\1{_LETTER}*(?![\w])"
)
#: Runs of one character: more than three of it say no more than three.
_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
#: Leading letters that do not repeat.
_SURE = re.compile(r"(?:([a-z])(?!\1))*")
# Classes of Latin-1 bytes for the search of places where SUSPECT can match.
_IS_LETTER = np.array([chr(i).isalpha() for i in range(256)])
_IS_SIGN = np.array([chr(i) in "0123456789@$|+(!*.-_'?" or 0x80 <= i < 0xC0 for i in range(256)])
_IS_LAST_SIGN = np.array([chr(i) in "0123456789@$|+£*" for i in range(256)])


def suspects(folded: str) -> np.ndarray:
    """Positions (ascending) in lines where SUSPECT may match; lines without one have no match.

    A sign before a letter or behind one, a letter three times, or three
    letters that stand alone with at most two characters between them.
    """
    byte = np.frombuffer(folded.encode("latin-1", "replace"), dtype=np.uint8)
    letter = _IS_LETTER[byte]
    found = [np.nonzero((_IS_SIGN[byte[:-1]] & letter[1:]) | (letter[:-1] & _IS_LAST_SIGN[byte[1:]]))[0]]
    same = byte[1:] == byte[:-1]
    found.append(np.nonzero(same[1:] & same[:-1] & letter[2:])[0])
    wide = np.concatenate([[False], letter, [False]])
    alone = np.nonzero(letter & ~wide[:-2] & ~wide[2:])[0]
    gap = np.diff(alone) <= 3
    found.append(alone[:-2][gap[1:] & gap[:-1]] if len(alone) > 2 else alone[:0])
    return np.sort(np.concatenate(found))


class _Folds(dict):
    """Character translation, filled as characters occur: accents off, lower case."""

    def __missing__(self, code: int) -> str:
        plain = unicodedata.normalize("NFKD", chr(code).casefold())
        out = "".join(c for c in plain if not unicodedata.combining(c)) or chr(code)
        self[code] = out
        return out


_FOLDS = _Folds()


def fold(text: str) -> str:
    """Lower case without accents (compatibility forms become plain letters)."""
    return text.lower() if text.isascii() else text.translate(_FOLDS)


# -- character language model --------------------------------------------


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**3, dtype=np.int64)
    for whole in batches:
        for batch in text_slices(whole.column(0)):
            # borders around each text; accents fold to letters, what is left beyond ASCII is one symbol
            joined = "  ".join(["", *map(fold, batch.to_pylist()), ""])
            code = _CLASS[np.frombuffer(joined.encode("ascii", "replace").replace(b"?", b"\x7f"), dtype=np.uint8)]
            total += np.bincount((code[:-2] * SYMBOLS + code[1:-1]) * SYMBOLS + code[2:], minlength=SYMBOLS**3)
    at = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["trigram", "n"])


def trigram_counts(texts: DataFrame) -> np.ndarray:
    """Counts over every text of the one column of ``texts`` (28^3 numbers on the driver)."""
    part = texts.mapInArrow(_count_trigrams, "trigram long, n long")
    counts = np.zeros(SYMBOLS**3, dtype=np.float64)
    for row in part.groupBy("trigram").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["trigram"]] = row["n"]
    return counts


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log P(c | a, b), interpolated with the lower orders."""
    n3 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
    p1 = (n1 + 1) / (n1.sum() + SYMBOLS)
    p2 = (n2 + 20 * p1) / (n2.sum(axis=1, keepdims=True) + 20)
    p3 = (n3 + 20 * p2[None, :, :]) / (n3.sum(axis=2, keepdims=True) + 20)
    return np.log(p3)


# -- lattice and Viterbi ---------------------------------------------------


def lattice(span: str) -> list[tuple[str, float, list[tuple[int, float]]]]:
    """Per observed character: the character, the cost of dropping it, and (hidden symbol, cost) edges."""
    out = []
    for k, c in enumerate(span):
        edges: list[tuple[int, float]] = []
        drop = -np.inf
        if "a" <= c <= "z":
            again = k > 0 and span[k - 1] == c
            edges.append((ord(c) - 97, KEEP_REPEAT if again else 0.0))
            if again:
                drop = DROP_REPEAT
        elif c in LEET:
            edges += [(ord(x) - 97, LEET_COST) for x in LEET[c]]
            if k > 0 and span[k - 1] == c:
                drop = DROP_REPEAT
        elif c.isalpha():
            edges.append((OTHER, 0.0))
        if c in SEPARATORS:
            drop = DROP_SEPARATOR
            if c == "*":
                edges += [(x, MASK_COST) for x in range(26)]
        if not edges and drop == -np.inf:
            edges.append((BORDER, 0.0))
        out.append((c, drop, edges))
    return out


def viterbi(span: str, model: np.ndarray) -> str:
    """The hidden word of the span: the best path of its lattice between two word borders.

    Leading letters without a repeat have one edge each, so the path through
    them is certain and the search begins behind them.
    """
    steps = lattice(span)
    sure = 0
    while sure < len(steps) and "a" <= span[sure] <= "z" and steps[sure][1] == -np.inf:
        sure += 1
    known = [BORDER, BORDER, *(ord(c) - 97 for c in span[:sure])]
    best = np.full((SYMBOLS, SYMBOLS), -np.inf)  # by the last two hidden symbols
    best[known[-2], known[-1]] = 0.0
    back = []
    for _, drop, edges in steps[sure:]:
        new = best + drop if drop > -np.inf else np.full_like(best, -np.inf)
        came = np.full((SYMBOLS, SYMBOLS), -1, dtype=np.int8)  # the symbol before the last two; -1: dropped
        if edges:
            symbols, costs = np.array([e[0] for e in edges]), np.array([e[1] for e in edges])
            through = best[:, :, None] + model[:, :, symbols] + costs  # (a, b, symbol) -> (b, symbol)
            a = through.argmax(axis=0)
            value = np.take_along_axis(through, a[None], axis=0)[0]
            better = value > new[:, symbols]
            new[:, symbols] = np.where(better, value, new[:, symbols])
            came[:, symbols] = np.where(better, a, -1)
        back.append(came)
        best = new
    final = best + model[:, :, BORDER]
    a, b = np.unravel_index(int(final.argmax()), final.shape)
    if final[a, b] == -np.inf:
        return span
    hidden = []
    for k in range(len(steps) - 1, sure - 1, -1):
        before = back[k - sure][a, b]
        if before >= 0:
            hidden.append((int(b), steps[k][0]))
            a, b = int(before), a
    return span[:sure] + "".join(chr(97 + s) if s < 26 else " " if s == BORDER else c for s, c in reversed(hidden))


class Restorer:
    """Restores texts; decoded spans are kept in a bounded memo."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.memo: dict[str, str] = {}

    def _decode(self, m: re.Match) -> str:
        span = _RUN.sub(r"\1\1\1", m.group())
        # The model looks two letters back: of the letters that can only be themselves, the last two tell the rest.
        sure = max(0, _SURE.match(span).end() - 2)
        rest = span[sure:]
        known = self.memo.get(rest)
        if known is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            parts = [rest[at : at + PIECE] for at in range(0, len(rest), PIECE)]
            known = "".join(viterbi(part, self.model) for part in parts)
            self.memo[rest] = known
        return span[:sure] + known

    def restore(self, text: str) -> str:
        folded = fold(text)
        parts, done = [], 0
        for at in suspects(folded).tolist():
            if at >= done:  # the whole line of the first suspect place not yet seen
                start = folded.rfind("\n", done, at) + 1 or done
                end = folded.find("\n", at)
                end = len(folded) if end < 0 else end
                parts += [folded[done:start], SUSPECT.sub(self._decode, folded[start:end])]
                done = end
        return "".join([*parts, folded[done:]]) if parts else folded


# -- features --------------------------------------------------------------

#: ASCII letters and everything beyond ASCII make words.
_WORD_BYTES = bytes(c if chr(c).isalpha() or c >= 0x80 else 0x20 for c in range(256))
PREFIXES = (4, 5, 6, 8)


def words_of(restored: str) -> list[bytes]:
    return restored.encode().translate(_WORD_BYTES).split()


def features_of(restored: str) -> set[bytes]:
    """Distinct words (with a blank after them) and word beginnings of a restored text."""
    words = set(words_of(restored))
    out = {w + b" " for w in words}
    for n in PREFIXES:
        out |= {w[:n] for w in words if len(w) >= n}
    return out


def near_copy_key(restored: str) -> int:
    """Least hash of the word 5-shingles: near copies mostly share it."""
    words = restored.split()
    digest = xxhash.xxh64_intdigest
    return min((digest(" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))), default=0) >> 1


@dataclass(frozen=True)
class ToxicityModel:
    language: np.ndarray
    odds: dict[str, float]
    weights: tuple[float, ...]
    intercept: float

    def evidence(self):
        """Function of a restored text: strongest log odds, log of their sum, share of the words that carry any."""
        odds = {name.encode("latin-1"): x for name, x in self.odds.items()}
        begin = {name.rstrip()[: PREFIXES[0]] for name in odds}

        def sums(restored: str) -> list[float]:
            words = words_of(restored)
            best = {}
            hits = 0
            for w in [w for w in words if w[: PREFIXES[0]] in begin]:
                x = best.get(w)
                if x is None:
                    x = best[w] = max(odds.get(w + b" ", 0.0), *(odds.get(w[:n], 0.0) for n in PREFIXES))
                hits += x > 0
            return [max(best.values(), default=0.0), float(np.log1p(sum(best.values()))), hits / max(1, len(words))]

        return sums


def _restored(model: np.ndarray):
    restorer = Restorer(model)
    return lambda batch: [restorer.restore(t) for t in batch.to_pylist()]


def restore(text: str | Column, model: np.ndarray) -> Column:
    """Restored text column."""

    @F.arrow_udf("string")
    def deobfuscate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restored = _restored(model)
        for batch in (part for whole in batches for part in text_slices(whole)):
            yield pa.array(restored(batch), type=pa.string())

    return deobfuscate(empty_if_null(text))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(restored, label) rows -> (feature, documents of class 1, of class 0), summed per slice."""
    for whole in batches:
        labels = whole.column("label").to_pylist()
        at = 0
        for part in text_slices(whole.column("restored")):
            seen = (Counter(), Counter())
            for text in part.to_pylist():
                seen[labels[at]].update(features_of(text))
                at += 1
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.decode("latin-1") for x in names], type=pa.string())] + [pa.array([seen[k][x] for x in names], type=pa.int64()) for k in (1, 0)],
                names=["feature", "n1", "n0"],
            )


def fit(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, train_rows: int = 20_000, least: int = 3,
    odds: float = 2.5, most_features: int = 20_000,
) -> ToxicityModel:
    """Language model over all ``docs``; classifier from the labels outside the held-out fold.

    ``least``: documents of class 1 that a feature needs; ``odds``: its
    least log odds; beside, its counts must be unlikely by chance given the
    number of features tested. ``most_features`` bounds what the driver
    gets (the strongest, a model parameter).
    """
    language = language_model(trigram_counts(docs.select(empty_if_null("text").alias("text"))))
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & (crc_mod("doc_id", folds) != held_out)
    )
    known = stored(sample_by_hash(known, train_rows), "toxicity-labels")
    train = stored(
        docs.select("doc_id", "text").join(known, "doc_id").select("label", restore("text", language).alias("restored")),
        "toxicity-train",
    )

    @F.arrow_udf("bigint")
    def copy_key(text: pa.Array) -> pa.Array:
        return pa.array([near_copy_key(t) for t in text.to_pylist()], type=pa.int64())

    single = stored(
        train.withColumn("key", copy_key("restored")).groupBy("key", "label").agg(F.min("restored").alias("restored"))
        .select("label", "restored"),
        "toxicity-single",
    )
    sizes = {r["label"]: r["n"] for r in single.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return ToxicityModel(language, {}, (0.0, 0.0, 0.0), 20.0 if 1 in sizes else -20.0)
    counted = single.mapInArrow(_count_features, "feature string, n1 long, n0 long").groupBy("feature").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0")
    )
    candidates = stored(counted.where(F.col("n1") >= least), "toxicity-features")
    rate = sizes[1] / (sizes[0] + sizes[1])
    tested = max(1, candidates.count())
    ratio = F.log((F.col("n1") + 0.5) / (sizes[1] + 1)) - F.log((F.col("n0") + 0.5) / (sizes[0] + 1))
    # Chernoff bound: that chance alone gives a feature this share of class 1, against the number of features tested.
    p = F.col("n1") / (F.col("n1") + F.col("n0"))
    divergence = p * F.log(p / rate) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - rate))).otherwise(0.0)
    strong = (
        candidates.where((p > rate) & ((F.col("n1") + F.col("n0")) * divergence >= float(np.log(tested))))
        .select("feature", ratio.alias("odds")).where(F.col("odds") >= odds)
        .orderBy(F.desc("odds"), "feature").limit(most_features)
    )
    table = {r["feature"]: r["odds"] for r in strong.collect()}
    model = ToxicityModel(language, table, (0.0, 0.0, 0.0), 0.0)

    @F.arrow_udf("array<double>")
    def evidence(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sums = model.evidence()
        for batch in batches:
            yield pa.array([sums(t) for t in batch.to_pylist()], type=pa.list_(pa.float64()))

    rows = stored(single.select(F.col("label").cast("double").alias("label"), evidence("restored").alias("x")).coalesce(4), "toxicity-rows")
    fitted = LogisticRegression(regParam=0.0005, maxIter=60).fit(rows.select("label", array_to_vector("x").alias("features")))
    return ToxicityModel(language, table, tuple(float(w) for w in fitted.coefficients.toArray()), float(fitted.intercept))


def score(text: str | Column, model: ToxicityModel) -> Column:
    """Probability of toxicity of a text column, after restoring it."""

    @F.arrow_udf("double")
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restored = _restored(model.language)
        weights, sums = np.array(model.weights), model.evidence()
        for batch in (part for whole in batches for part in text_slices(whole)):
            x = np.array([sums(t) for t in restored(batch)]).reshape(-1, len(weights))
            yield pa.array(1 / (1 + np.exp(-(x @ weights + model.intercept))))

    return toxicity(empty_if_null(text))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = fit(docs, labels, **options)
    scored = docs.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
