"""Secret scans over an incremental blob ledger (operator 4).

Every historical version of a file is content-addressed: its blob id is the
SHA-256 of its text. The ledger is a Parquet table with one row per scan of
a blob: ``blob_id``, ``rules`` (the ``name@version`` of the rules that this
scan applied) and ``spans`` (what they found; empty for a clean blob). A
run finds the blobs and, per blob, the rule versions that the ledger has
not seen, scans only those pairs, appends them, and joins the ledger's
findings back to all paths that hold the blob. A new version of one rule
scans every blob again, but for that rule alone.

Rules run over whole texts in Arrow batches; a rule with trigger words runs
only where one of them occurs (in lower case), which changes no result.

Skew: equal versions collapse in a partial aggregate before the shuffle, so
a blob with a third of all paths is one row per input split; the join back
is a plain sort-merge join that Spark splits on a hot blob, or a broadcast
where the findings are small. The texts themselves move once: equal
blobs have to meet to be scanned once, and fetching the texts of the
survivors of a narrow shuffle would move the same texts by a join.

Defined results: NULL text is the empty blob; repeated rows each get the
blob's findings; positions are code points, ends exclusive; other columns of
the versions frame are kept, but for ``blob_id`` and ``spans``, which the
results replace; texts of any length are scanned whole; an empty table scans
nothing and gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.common import empty_if_null, stored, text_slices, unused_name
from candela.session import scratch_dir
from candela.sinks.tables import table_exists

SPANS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob_id string, rules array<string>, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """One kind of secret: matches of ``pattern`` that ``accept`` keeps, leftmost and non-overlapping.

    ``triggers``: lower-case ASCII words of which one occurs in every
    lower-cased text with a match (empty: no such words).
    """

    kind: str
    pattern: re.Pattern
    accept: Callable[[re.Match], bool] = lambda m: True
    triggers: tuple[bytes, ...] = ()
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base kinds.
BASE_RULES = (
    Rule(
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
        ),
        lambda m: len(m[2]) >= 8,
        (b"passw", b"secret", b"token", b"apikey", b"api_key"),
    ),
    Rule("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16, (b"akia",)),
    Rule("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)

# Token formats that their issuers publish.
MORE_RULES = (
    Rule("github", re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{60,})"), triggers=(b"gh", b"github_pat_")),
    Rule("gitlab", re.compile(r"\bglpat-[A-Za-z0-9_-]{20,}"), triggers=(b"glpat-",)),
    Rule("slack", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}"), triggers=(b"xox",)),
    Rule("stripe", re.compile(r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{20,}"), triggers=(b"k_live_", b"k_test_")),
    Rule("google", re.compile(r"\bAIza[A-Za-z0-9_-]{35}"), triggers=(b"aiza",)),
    Rule("jwt", re.compile(r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"), triggers=(b"eyj",)),
    Rule("npm", re.compile(r"\bnpm_[A-Za-z0-9]{36}"), triggers=(b"npm_",)),
    Rule("sendgrid", re.compile(r"\bSG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{32,}"), triggers=(b"sg.",)),
    Rule("url_login", re.compile(r"\b[a-z][a-z0-9+.-]{1,15}://[^\s/:@]++:[^\s/:@]{3,}+@[A-Za-z0-9.-]+"), triggers=(b"://",), version=2),
    Rule(
        "private_key",
        # To the END line, whatever stands between; without one, as far as header lines and base64 go (line ends may be escaped).
        re.compile(
            r"-----BEGIN (?:[A-Z]{2,10} ){0,2}PRIVATE KEY(?: BLOCK)?-----"
            r"(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END (?:[A-Z]{2,10} ){0,2}PRIVATE KEY(?: BLOCK)?-----"
            r"|(?:(?<=[n\n])[A-Z][A-Za-z0-9-]{1,30}:[^\r\n\\]*|\\+[nr]|[A-Za-z0-9+/=\s])*+)"
        ),
        triggers=(b"private key",), version=2,
    ),
)
RULES = BASE_RULES + MORE_RULES

#: ``[0-9a-f]+`` of 32 and more, found faster: a run of hex digits is maximal on both sides.
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_HEX_STEP = re.compile(rb"[0-9a-f]{16}")


def spans_of(text: str, rules: tuple[Rule, ...]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every accepted match, by start and then in the order of ``rules``."""
    found = []
    raw = text.encode()
    lower = raw.lower()
    for order, rule in enumerate(rules):
        if rule.triggers and not any(t in lower for t in rule.triggers):
            continue
        pattern = rule.pattern
        if rule.kind == "hex":
            if not _HEX_STEP.search(raw):
                continue
            pattern = _LONG_HEX
        found += [(m.start(), order, m.end(), rule.kind) for m in pattern.finditer(text) if rule.accept(m)]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def _scan(rules: tuple[Rule, ...]):
    """Task: blobs with the rule names that they still need -> ledger rows."""
    by_name = {r.name: r for r in rules}
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, part in _parts(whole):
                ids, needed = whole.column("blob_id").slice(at, len(part)), whole.column("rules").slice(at, len(part))
                spans = []
                for text, names in zip(part.to_pylist(), needed.to_pylist(), strict=True):
                    wanted = tuple(by_name[n] for n in by_name if n in names)
                    spans.append([{"kind": k, "start": a, "end": b} for k, a, b in spans_of(text, wanted)])
                yield pa.RecordBatch.from_arrays(
                    [ids, needed, pa.array(spans, type=pa.list_(kind))], names=["blob_id", "rules", "spans"]
                )

    def _parts(whole: pa.RecordBatch) -> Iterator[tuple[int, pa.Array]]:
        at = 0
        for part in text_slices(whole.column("text")):
            yield at, part
            at += len(part)

    return run


def update_ledger(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan the unseen (blob, rule version) pairs of ``versions`` (blob_id, text) into the ledger; returns the ledger."""
    spark = versions.sparkSession
    names = F.array(*[F.lit(r.name) for r in rules])
    blobs = versions.groupBy("blob_id").agg(F.first("text").alias("text"))
    if table_exists(spark, ledger):
        seen = (
            spark.read.schema(LEDGER).parquet(ledger)
            .groupBy("blob_id").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))
        )
        done = seen.where(F.size(F.array_except(names, "seen")) == 0).select("blob_id")
        # Finished blobs leave before the texts are shuffled; the join is planned by the ledger's size.
        blobs = versions.join(done, "blob_id", "left_anti").groupBy("blob_id").agg(F.first("text").alias("text"))
        blobs = blobs.join(seen, "blob_id", "left").select(
            "blob_id", "text", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules")
        )
    else:
        blobs = blobs.select("blob_id", "text", names.alias("rules"))
    blobs.mapInArrow(_scan(rules), LEDGER).write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob_id, spans): per blob with a finding, the spans of the given rule versions by start, then rule order."""
    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    current = F.array(*[F.lit(r.name) for r in rules])
    # A scan row holds the spans of the rules that it names; only kinds named in their current version count.
    kinds = F.transform(F.array_intersect("rules", current), lambda n: F.substring_index(n, "@", 1))
    kept = ledger.where(F.size("spans") > 0).select(
        "blob_id", F.filter("spans", lambda s: F.array_contains(kinds, s["kind"])).alias("spans")
    )
    keyed = F.array_sort(
        F.transform(
            F.array_distinct(F.flatten(F.collect_list("spans"))),
            lambda s: F.struct(s["start"].alias("start"), F.element_at(order, s["kind"]).alias("at"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    plain = F.transform(
        keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    return kept.where(F.size("spans") > 0).groupBy("blob_id").agg(plain.alias("spans"))


def scan_versions(
    versions: DataFrame, ledger: str | None = None, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``versions`` (one row per path and historical version) without its text, plus ``blob_id`` and ``spans``.

    ``ledger``: folder of the ledger, kept between runs (a fresh one under
    the shared checkpoint folder if not given).
    """
    spark = versions.sparkSession
    ledger = ledger or scratch_dir(spark, "secret-ledger")
    blob = F.sha2(empty_if_null(text), 256)
    rows = update_ledger(versions.select(blob.alias("blob_id"), empty_if_null(text).alias("text")), ledger, rules)
    kept = [c for c in versions.columns if c != text and c.lower() not in ("blob_id", "spans")]
    paths = versions.select(*kept, blob.alias("blob_id"))
    joined = paths.join(findings(rows, rules), "blob_id", "left")
    return joined.select(*kept, "blob_id", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def span_text(spans: str | F.Column) -> F.Column:
    """``kind:start:end`` of each span, comma-joined."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


#: Bits of the filter that keeps clean texts out of a join (8 MB, whatever the number of findings).
FILTER_BITS = 1 << 26


def may_hold(found: DataFrame, id_col: str):
    """Function of an id column: False for ids that ``found`` does not have, True for all that it has and a few others.

    A bit set of fixed size, gathered by an aggregate of at most
    FILTER_BITS / 64 words and broadcast; more findings only raise the share
    of rows that are joined in vain.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    one = F.lit(1).cast("long")
    words = found.select(place(id_col).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", one, F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    ).toArrow()
    table = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    sent = found.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def in_filter(at: pa.Array) -> pa.Array:
        x = at.to_numpy()
        return pa.array(((sent.value[x >> 6] >> (x & 63)) & 1).astype(bool))

    return lambda c: in_filter(place(c))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "<secret>") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mark`` (overlapping spans by one mark).

    Scanned through a ledger of its own; ``n_chars`` follows the new text
    where the column exists. Documents without findings pass unchanged.
    """
    spark: SparkSession = docs.sparkSession
    blob = F.sha2(empty_if_null("text"), 256)
    ledger = update_ledger(docs.select(blob.alias("blob_id"), empty_if_null("text").alias("text")), scratch_dir(spark, "secret-ledger"), rules)
    id_, spans = unused_name(docs, "_blob"), unused_name(docs, "_spans")
    found = stored(findings(ledger, rules).select(F.col("blob_id").alias(id_), F.col("spans").alias(spans)), "secret-findings")
    # Only rows whose blob may have a finding are joined: the texts of all others stay where they are.
    marked = docs.withColumn(id_, blob)
    may = may_hold(found, id_)
    passed = marked.where(~may(id_)).select(docs.columns)
    joined = marked.where(may(id_)).join(found, id_, "left")
    # Fold over the spans by start: (text so far, position after the last secret).
    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: F.Column, s: F.Column) -> F.Column:
        gap = F.substr("text", acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.concat(acc["out"], gap, F.when(fresh, F.lit(mark)).otherwise(F.lit(""))).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    cleaned = F.aggregate(spans, empty, step, lambda acc: F.concat(acc["out"], F.substr("text", acc["at"] + 1)))
    clean, new_text = F.col(spans).isNull(), unused_name(docs, "_clean")
    out = joined.withColumn(new_text, F.when(clean, F.col("text")).otherwise(cleaned))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col(new_text).alias("text"))
        elif c == "n_chars":
            columns.append(F.when(clean, F.col(c)).otherwise(F.length(new_text).cast(docs.schema[c].dataType)).alias(c))
        else:
            columns.append(F.col(c))
    return passed.unionByName(out.select(columns))
