"""Secret scan with character Markov models (operator 6); DataFrame functions only.

Base rules find assignments, access keys and long hex runs.  Beside them, every
long identifier is scored by the log-likelihood ratio of two first-order
character models: one of random strings (learned from the values that the base
rules label), one of ordinary identifiers (all others).  Identifiers above the
threshold that touch no base span are spans of kind ``markov``.

The models are fitted on two bounded samples of at most ``SAMPLE_ROWS``
documents, those with the smallest id hash: random strings come from documents
with base spans, looked for in all rows, ordinary identifiers from all documents, their
base spans cut out.  A text of n spans takes work in proportion to n ** 1.5 at most.
Scanning covers every whole text.  The fitted table has 128 x 128 numbers at any input size.

Defined results: a null or empty text has no spans; offsets are code points,
ends exclusive; a text's spans are sorted by start, then kind; repeated rows
are scanned alike; without any labelled value only the base rules hold; an
empty table gives an empty table; further columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webstats.llm.common import whole_text

SAMPLE_ROWS = 4_000
THRESHOLD = 0.5             # mean log-likelihood ratio per character step
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = "[A-Za-z0-9+/_=-]{6,}"
REDACTED = "[REDACTED]"
CUT = "\n"                  # stands for base spans where ordinary identifiers are learned

# fixed values: the base rules, in the order in which equal starts are listed
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"        # AKIA[A-Z0-9]+ of 20 or more characters
HEX = "[0-9a-f]{24,}"               # [0-9a-f]+ of 24 or more characters
KINDS = ["assign", "access", "hex", "markov"]


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(values: Column) -> Column:
    """An array cut into about as many blocks as a block has elements."""
    width = F.greatest(F.ceil(F.sqrt(F.size(values))), F.lit(1)).cast("int")
    last = F.greatest(F.floor((F.size(values) - 1) / width), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * width + 1, width))


def _running(values: Column, op) -> Column:
    """``op`` folded over every prefix of an array of integers.

    An array that grows by an element is copied whole: folding in blocks, and then over the blocks, keeps the copies short.
    """
    def fold(block: Column) -> Column:
        return F.aggregate(block, F.array().cast("array<int>"), lambda acc, v: F.concat(
            acc, F.array(F.coalesce(op(F.get(acc, F.size(acc) - 1), v), v))))

    def joined(inner: Column) -> Column:
        ends = F.transform(inner, lambda b: F.get(b, F.size(b) - 1))
        return _once(fold(ends), lambda r: F.flatten(F.transform(inner, lambda b, i: F.transform(
            b, lambda v: F.coalesce(op(F.get(r, i - 1), v), v)))))

    return _once(values, lambda x: _once(F.transform(_blocks(x), fold), joined))


def _spans(text: Column, pattern: str, kind: str, keep_group: int = 0, least: int = 0) -> Column:
    """Array of (start, order, kind, end, value) of the leftmost non-overlapping matches.

    Splitting at the pattern gives the stretches between the matches, so
    offsets are running sums of lengths.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(keep_group)) if keep_group else whole
    between = F.slice(F.split(text, pattern, -1), 1, F.size(whole))
    parts = F.arrays_zip(between.alias("b"), whole.alias("m"), value.alias("v"))
    span = "struct<start:int,ord:int,kind:string,end:int,value:string>"
    empty = F.array().cast(f"array<{span}>")

    def placed(parts: Column) -> Column:
        ends = _running(F.transform(parts, lambda x: F.length(x["b"]) + F.length(x["m"])), lambda a, b: a + b)
        return _once(ends, lambda e: F.transform(parts, lambda x, i: F.struct(
            (F.get(e, i) - F.length(x["m"])).alias("start"), F.lit(KINDS.index(kind)).alias("ord"), F.lit(kind).alias("kind"),
            F.get(e, i).alias("end"), x["v"].alias("value")).cast(span)))

    found = _once(parts, placed)
    if least:
        found = F.filter(found, lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), found).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the base rules, sorted by start, then kind."""
    return F.array_sort(F.concat(_spans(text, ASSIGN, "assign", 2, 6), _spans(text, ACCESS, "access"), _spans(text, HEX, "hex")))


def fit_models(df: DataFrame, text: str = "text", key: str = "doc_id", rows: int = SAMPLE_ROWS) -> list[float] | None:
    """Log-likelihood ratio of every character pair (128 x 128 numbers), or None if nothing is labelled."""
    hashed = df.select(F.xxhash64(F.col(key)).alias("h"), whole_text(text).alias("t"))

    def smallest(labelled: bool, values) -> DataFrame | None:
        """``values(text, spans)`` of the documents with the smallest hashes (then texts), of those with base spans or of all."""
        wanted = F.size(base_spans(F.col("t"))) > 0 if labelled else F.lit(True)
        bound = hashed.where(wanted).select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
        return None if bound is None else hashed.where(F.col("h") <= bound).where(wanted).orderBy("h", "t").limit(rows).select(
            F.explode(_once(base_spans(F.col("t")), lambda s: values(F.col("t"), s))).alias("w"))

    secret = smallest(True, lambda t, s: s["value"])
    if secret is None:
        return None
    secret = secret.select("w", F.lit(1).alias("random"))
    plain = smallest(False, lambda t, s: F.regexp_extract_all(redact(t, s, CUT), F.lit(IDENTIFIER), F.lit(0)))
    plain = plain.select("w", F.lit(0).alias("random"))
    pairs = secret.union(plain).where(F.length("w") >= 2).select("random", F.explode(_once(F.split("w", ""), lambda c: F.transform(
        F.sequence(F.lit(1), F.size(c) - 1), lambda i: F.concat(F.get(c, i - 1), F.get(c, i))))).alias("p"))
    counts = pairs.groupBy("random", "p").count().collect()         # at most 2 x 128 x 128 rows
    seen = [{}, {}]
    for r in counts:
        seen[r["random"]][r["p"]] = r["count"]
    if not seen[1]:
        return None
    letters = [chr(c) for c in range(128) if chr(c).isalnum() or chr(c) in "+/_=.-"]
    table = [0.0] * (128 * 128)
    for a in letters:
        total = [sum(s.get(a + b, 0) for b in letters) for s in seen]
        for b in letters:
            p = [(s.get(a + b, 0) + 0.5) / (n + 0.5 * len(letters)) for s, n in zip(seen, total)]
            table[ord(a) * 128 + ord(b)] = math.log(p[1] / p[0])
    return table


def ratio(value: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per character step of an ASCII string."""
    cells = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")

    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c))
    total = _once(codes, lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda acc, i: acc + F.get(
        cells, F.get(c, i - 1) * 128 + F.get(c, i))))
    return total / (F.length(value) - 1)


def _apart(spans: Column, base: Column) -> Column:
    """Those of ``spans`` that touch none of ``base`` (sorted by start).

    A span touches one if the farthest end of all that start before its end lies behind its start; which start before
    it is looked up by halving.
    """
    def free(b: Column, reach: Column, s: Column) -> Column:
        halvings = F.sequence(F.lit(1), F.ceil(F.log2(F.size(b) + 1)).cast("int"))

        def halve(acc: Column, _: Column) -> Column:
            mid = F.shiftright(acc["lo"] + acc["hi"], 1)
            below = F.coalesce(F.get(b, mid)["start"] < s["end"], F.lit(False))
            return F.struct(F.when(below, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(below, acc["hi"]).otherwise(mid).alias("hi"))

        before = F.aggregate(halvings, F.struct(F.lit(0).alias("lo"), F.size(b).alias("hi")), halve, lambda acc: acc["lo"])
        return F.coalesce(F.get(reach, before - 1) <= s["start"], F.lit(True))

    kept = _once(base, lambda b: _once(_running(b["end"], F.greatest), lambda r: F.filter(spans, lambda s: free(b, r, s))))
    return F.when(F.size(base) == 0, spans).otherwise(kept)


def scan_secrets(df: DataFrame, table: list[float] | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``base`` and ``found``: arrays of spans (start, ord, kind, end, value), base rules and all."""
    t = whole_text(text)
    out = df.withColumn("base", base_spans(t))
    if table is None:
        return out.withColumn("found", F.col("base"))
    random = lambda c: (c["value"].rlike("[0-9]") & c["value"].rlike("[A-Za-z]") & (ratio(c["value"], table) > threshold))
    more = F.filter(_apart(_spans(t, CANDIDATE, "markov"), F.col("base")), random)
    return out.withColumn("found", F.array_sort(F.concat("base", more)))


def redact(text: Column, spans: Column, mark: str = REDACTED) -> Column:
    """The text with every span (merged where they overlap) replaced by a mark; ``spans`` are sorted by start.

    A stretch of the text is cut out for a block of spans, and the stretches between them out of it.
    """
    def cut(block: Column) -> Column:
        first = F.get(block, F.lit(0))["at"]
        stretch = F.substr(text, first + 1, F.greatest(F.get(block, F.size(block) - 1)["start"] - first, F.lit(0)))
        return _once(stretch, lambda p: F.array_join(F.transform(block, lambda x: F.when(x["start"] >= x["at"], F.concat(
            F.substr(p, x["at"] - first + 1, x["start"] - x["at"]), F.lit(mark))).otherwise("")), ""))

    def whole(reach: Column) -> Column:
        gaps = F.transform(spans, lambda s, i: F.struct(F.coalesce(F.get(reach, i - 1), F.lit(0)).alias("at"), s["start"].alias("start")))
        tail = F.substr(text, F.get(reach, F.size(reach) - 1) + 1, F.length(text))
        return F.concat(_once(gaps, lambda g: F.array_join(F.transform(_blocks(g), cut), "")), tail)

    return F.when(F.size(spans) > 0, _once(_running(spans["end"], F.greatest), whole)).otherwise(text)


def listing(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
