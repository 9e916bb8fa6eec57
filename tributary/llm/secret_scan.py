"""Secret scans by sliding-window Shannon entropy. DataFrame functions only, no shuffle.

Three fixed rules report what is plainly a secret. The entropy rule looks at
candidate strings (long runs of key characters with a digit and a letter). A
window slides over each; the counts of its characters are kept up to date as
one enters and one leaves, and with them the sum of c * log2(c), so a step
costs the same whatever the window and the candidate. Windows at or above the threshold of the
candidate's character class are merged into spans. What a fixed rule has reported, or an
allow-listed word covers, is cut out of them; what is left and at least a window long is reported. Only
candidates that are harmless as a whole (a path, a UUID) are left out as such.

Lists are built in chunks, so that the cost of a text follows its length.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the contract.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGNED_LEAST = 6

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
#: Character classes in order of preference, each with the entropy in bits that a window must reach.
CLASSES = ((r"^[0-9a-fA-F-]+$", 3.0), (r"^[A-Z0-9]+$", 3.5), (r"^[a-z0-9]+$", 3.5), (r"^.*$", 3.8))
#: Candidates that as a whole are known not to be secrets: UUIDs, documented example keys, paths of several plain words.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"EXAMPLE(KEY)?$",
    r"^[-_/]*(?:(?:[a-z]{1,20}|[A-Z]{1,20}|(?:[A-Z]?[a-z]{2,20}){1,4})[0-9]{0,4}|[0-9]{1,4})"
    r"(?:[-_/]+(?:(?:[a-z]{1,20}|[A-Z]{1,20}|(?:[A-Z]?[a-z]{2,20}){1,4})[0-9]{0,4}|[0-9]{1,4})){2,}[-_/]*$",
)
#: Parts of candidates that aren't secrets; they end a secret beside them.
ALLOWED_PART = r"(?i:example|placeholder|changeme|dummy|sample|x{4,}|0123456789abcdef|abcdefghijklmnop|(?:deadbeef){2,})"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"

SPANS = "array<struct<start:long,kind:int,end:long,text:string>>"


CHUNK = 256


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), 0)


def _fold(items: Column, state: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Spans that ``step(state, item)``, a struct of the next state and an array of spans, gives for the items in turn.

    An array that grows by one is copied each time, so spans are gathered in chunks, and those put together."""
    none = F.array().cast(SPANS)

    def part(before: Column, some: Column) -> Column:
        return F.aggregate(some, F.struct(before.alias("state"), none.alias("spans")), lambda acc, x: _bound(
            step(acc["state"], x), lambda r: F.struct(
                r["state"].alias("state"),
                F.when(F.size(r["spans"]) > 0, F.concat(acc["spans"], r["spans"])).otherwise(acc["spans"]).alias("spans"))))

    def whole(all_items: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / CHUNK).cast("int"))
        zero = F.struct(state.alias("state"), F.array().cast(f"array<{SPANS}>").alias("groups"))
        return F.aggregate(
            chunks, zero, lambda acc, k: _bound(
                part(acc["state"], F.slice(all_items, k * CHUNK + 1, F.lit(CHUNK))),
                lambda r: F.struct(r["state"].alias("state"), F.concat(acc["groups"], F.array(r["spans"])).alias("groups"))),
            lambda acc: F.flatten(acc["groups"]))

    return _bound(items, lambda x: F.when(F.size(x) > 0, whole(x)).otherwise(none))


def _span(start: Column, kind: int, end: Column, text: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(kind).alias("kind"), end.cast("long").alias("end"), text.alias("text"))


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """All matches, leftmost first, with code point offsets: lengths of the gaps and of the matches add up."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = F.zip_with(found, gaps, lambda m, g: F.struct(F.length(g).alias("gap"), m.alias("text")))

    def step(at: Column, m: Column) -> Column:
        begin = at + m["gap"]
        end = begin + F.length(m["text"])
        return F.struct(end.alias("state"), F.array(_span(begin, kind, end, m["text"])).alias("spans"))

    # there is one gap more than matches
    spans = _fold(F.filter(both, lambda b: b["text"].isNotNull()), F.lit(0).cast("long"), step)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPANS))


def _assigned(text: Column) -> Column:
    """Matches of ASSIGN whose value is long enough; shorter ones are dropped without a retry."""
    spans = _matches(text, ASSIGN, 0)
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_enough = F.filter(F.zip_with(spans, values, lambda s, v: F.struct(s.alias("s"), v.alias("v"))),
                           lambda x: F.length(x["v"]) >= ASSIGNED_LEAST)
    return F.when(F.size(spans) > 0, F.transform(long_enough, lambda x: x["s"])).otherwise(spans)


#: Counts of a window are packed, so many of five bits in a long; a window may have 31 characters.
PACKED = 12


def entropy_spans(candidate: Column, threshold: Column, window: int = WINDOW) -> Column:
    """Merged windows of ``candidate`` whose entropy reaches ``threshold``: array of (start, end) in it."""
    if not 1 <= window < 32:
        raise ValueError("a window has 1 to 31 characters")
    terms = F.array(*[F.lit(c * math.log2(c) if c > 1 else 0.0) for c in range(window + 2)])
    pair = "array<struct<start:int,end:int>>"

    def place(ch: Column) -> Column:
        code = F.instr(F.lit(ALPHABET), ch) - 1
        return F.struct(F.floor(code / PACKED).cast("int").alias("slot"), (code % PACKED * 5).alias("shift"))

    def count(counts: Column, at: Column) -> Column:
        return F.call_function("shiftright", F.get(counts, at["slot"]), at["shift"]).bitwiseAND(F.lit(31)).cast("int")

    def one(at: Column, k: Column) -> Column:
        return F.when(at["slot"] == k, F.call_function("shiftleft", F.lit(1).cast("long"), at["shift"])).otherwise(F.lit(0))

    zero = F.struct(F.array_repeat(F.lit(0).cast("long"), -(-len(ALPHABET) // PACKED)).alias("counts"), F.lit(0.0).alias("total"),
                    F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast(pair).alias("spans"))

    def step(codes: Column, bits: Column) -> Callable[[Column, Column], Column]:
        def run(acc: Column, i: Column) -> Column:
            enters, leaves = F.get(codes, i - 1), F.get(codes, i - 1 - window)
            full = i > window
            moved = ~full | (enters != leaves)
            up = count(acc["counts"], enters)
            total = acc["total"] + F.get(terms, up + 1) - F.get(terms, up)
            down = count(acc["counts"], leaves)
            total = F.when(~moved, acc["total"]).when(full, total + F.get(terms, down - 1) - F.get(terms, down)).otherwise(total)
            counts = F.when(~moved, acc["counts"]).otherwise(F.transform(
                acc["counts"], lambda c, k: c + one(enters, k) - F.when(full, one(leaves, k)).otherwise(F.lit(0))))
            return _bound(F.struct(counts.alias("counts"), total.alias("total")), lambda now: slid(acc, now, i))

        def slid(acc: Column, now: Column, i: Column) -> Column:
            high = (i >= window) & (F.lit(math.log2(window)) - now["total"] / window >= bits - 1e-9)
            begin = i - window
            joins = (acc["end"] >= 0) & (begin <= acc["end"])
            closed = F.struct(acc["start"].alias("start"), acc["end"].alias("end"))
            return F.struct(
                now["counts"].alias("counts"), now["total"].alias("total"),
                F.when(high & ~joins, begin).otherwise(acc["start"]).alias("start"),
                F.when(high, i).otherwise(acc["end"]).alias("end"),
                F.when(high & ~joins & (acc["end"] >= 0), F.concat(acc["spans"], F.array(closed)))
                .otherwise(acc["spans"]).alias("spans"))
        return run

    def finish(acc: Column) -> Column:
        last = F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))
        return F.when(acc["end"] >= 0, F.concat(acc["spans"], last)).otherwise(acc["spans"])

    # the characters are looked up once, and so is the threshold
    given = F.struct(F.transform(F.split(candidate, ""), place).alias("codes"), threshold.alias("bits"))
    return _bound(given, lambda g: F.aggregate(F.sequence(F.lit(1), F.length(candidate)), zero, step(g["codes"], g["bits"]), finish))


def _uncovered(spans: Column, covers: Column, least: int) -> Column:
    """The parts of ``spans`` (disjoint) outside of all ``covers``, of ``least`` characters or more: a sweep over the ends of
    both, with the number of each that are open."""
    def ends(of: Column, cover: int) -> Column:
        def end(at: Column, by: int) -> Column:
            return F.struct(at.alias("at"), F.lit(by * cover).alias("covers"), F.lit(by * (1 - cover)).alias("spans"))
        return F.flatten(F.transform(of, lambda x: F.array(end(x["start"], 1), end(x["end"], -1))))

    start = F.struct(F.lit(0).alias("covers"), F.lit(0).alias("spans"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, e: Column) -> Column:
        part = (state["spans"] > 0) & (state["covers"] == 0) & (e["at"] - state["at"] >= least)
        return F.struct(
            F.struct((state["covers"] + e["covers"]).alias("covers"), (state["spans"] + e["spans"]).alias("spans"),
                     e["at"].alias("at")).alias("state"),
            F.when(part, F.array(_span(state["at"], 3, e["at"], F.lit("")))).otherwise(F.array().cast(SPANS)).alias("spans"))

    return _fold(F.array_sort(F.concat(ends(spans, 0), ends(covers, 1))), start, step)


def _entropy(text: Column, known: Column) -> Column:
    harmless = lambda c: reduce(lambda a, b: a | b, [c.rlike(p) for p in ALLOWED])
    keyish = F.filter(_matches(text, CANDIDATE, 3), lambda m: m["text"].rlike("[0-9]") & m["text"].rlike("[A-Za-z]")
                      & ~harmless(m["text"]))

    def threshold(c: Column) -> Column:
        out = F.lit(CLASSES[-1][1])
        for pattern, bits in reversed(CLASSES[:-1]):
            out = F.when(c.rlike(pattern), F.lit(bits)).otherwise(out)
        return out

    spans = F.flatten(F.transform(keyish, lambda m: F.transform(
        entropy_spans(m["text"], threshold(m["text"])),
        lambda s: _span(m["start"] + s["start"], 3, m["start"] + s["end"], F.lit("")))))
    none = F.array().cast(SPANS)
    cut = _bound(spans, lambda s: F.when(F.size(s) > 0, _uncovered(
        s, F.concat(known, _matches(text, ALLOWED_PART, 3)), WINDOW)).otherwise(none))
    return F.when(text.rlike(CANDIDATE), cut).otherwise(none)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets in each text of ``docs`` (doc_id, text; other columns are ignored).

    Returns doc_id, the counts of the fixed rules (n_assign, n_access, n_hex), base_sha256 over their
    spans, spans (theirs and the entropy rule's, as kind:start:end in code points) and n_entropy. A
    null text is empty: no span, an empty string, the SHA-256 of nothing. Spans of different kinds may
    overlap; of an entropy span only what lies outside those of the fixed rules and the allow-listed words is left,
    where that is a window or more. Repeated rows are scanned each. A text may be of any length, and one candidate."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    rows = rows.select("doc_id", "text", _assigned(text).alias("assign"), _matches(text, ACCESS, 1).alias("access"),
                       _matches(text, HEX, 2).alias("hex"))
    rows = rows.withColumn("base", F.concat("assign", "access", "hex"))
    rows = rows.withColumn("entropy", _entropy(text, F.col("base")))
    n = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    return rows.select("doc_id", n("assign"), n("access"), n("hex"),
                       F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                       _joined(F.concat("base", "entropy")).alias("spans"), n("entropy"))
