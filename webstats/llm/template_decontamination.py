"""Benchmark decontamination by template canonicalisation (operator 1); DataFrame functions only.

Texts become word sequences in which numbers, names (capitalised words inside a
sentence) and units (after a number) are typed placeholders, so that a question
asked again with other parameters gives the same template.  All windows of
``WINDOW`` words of documents and benchmark items are hash-joined, once with
placeholders for names and once with the folded names themselves, for copies in
other letter case; matches of one document and item that agree on the offset are
one alignment.  An alignment counts when it covers ``LEAST_WORDS`` words in a
row's worth of windows (or the whole item, if that is shorter) and the slots in
its matched windows are consistent, one to one: equal names of the item stand for equal
names in the document, different ones for different ones, and so do numbers of three or
more characters.  Shorter numbers and units can be equal by chance, and stand for
anything.  Slots that stand unchanged in ``LEAST_WORDS`` words in a row (or in the whole
item) agree whatever stands elsewhere: a literal quote counts.

The benchmark's windows are broadcast up to ``BROADCAST_ROWS`` rows, checked by
counting; a larger benchmark is joined by shuffle.

Defined results: null, empty or too short texts have no windows and are clean;
items with fewer than ``WINDOW`` words can't be found; a document with several
places of an item gives one row, that of its best consistent place (ties: the
smallest offset); repeated rows with equal ids count as one document; empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webstats.llm.common import stored, whole_text

WINDOW = 8                  # a power of two
LEAST_WORDS = 13
BROADCAST_ROWS = 1_000_000  # 32 bytes each
LONG_NUMBER = 3             # characters from which equal numbers are no chance

NUMBER, NAME, UNIT = "0", "1", "2"     # placeholders; digits, since no other digit is left
VALUE = r"[\p{L}\p{M}]+|\p{N}+(?:[.,]\p{N}+)*"
TOKEN = r"[\p{L}\p{M}]+|\p{N}"
UNITS = ["mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "sec", "min", "h", "hours", "minutes", "seconds",
         "days", "years", "miles", "feet", "inches", "pounds", "dollars", "euros", "usd", "eur", "percent", "degrees"]


def _numbered(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{N}+(?:[.,]\p{N}+)*", NUMBER)


def _named(numbered: Column) -> Column:
    return F.regexp_replace(numbered, r"(?<=[^.!?\s]\s)\p{Lu}\p{Ll}[\p{L}\p{M}]*", NAME)


def _tokens(named: Column) -> Column:
    units = F.regexp_replace(F.lower(named), rf"(?<={NUMBER}) ?(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{M}}])", f" {UNIT}")
    return F.regexp_extract_all(units, F.lit(TOKEN), F.lit(0))


def template_tokens(text: Column) -> Column:
    """The words of a text, folded, with placeholders for numbers, names and units.

    Three replacements over the whole text cost far less than a look at every
    word.  Token ``i`` stands for value ``i`` of ``slot_values``.
    """
    return _tokens(_named(_numbered(text)))


def slot_values(text: Column) -> Column:
    """What stands in the text at each template token."""
    return F.transform(F.regexp_extract_all(text, F.lit(VALUE), F.lit(0)), lambda w: F.lower(w))


def window_hashes(tokens: Column, window: int = WINDOW) -> Column:
    """Hash of every ``window`` consecutive tokens, by doubling (windows of 1, 2, 4, ... tokens)."""
    n = F.size(tokens)

    def doubled(h: Column, reach: int) -> Column:
        # zip_with names its first array twice: bound by a one-element array
        return F.flatten(F.transform(F.array(h), lambda x: F.zip_with(
            x, F.slice(x, 1 + reach, F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b))))

    out, reach = F.transform(tokens, lambda x: F.xxhash64(x)), 1
    while reach < window:
        out, reach = doubled(out, reach), reach * 2
    return F.when(n >= window, F.slice(out, 1, F.greatest(n - (window - 1), F.lit(1)))).otherwise(F.array().cast("array<bigint>"))


def _windows(df: DataFrame, key: str, text: str, pos: str, window: int) -> DataFrame:
    """Hashes of all windows with placeholders for names, and of those with the folded names where these differ."""
    numbered = df.select(F.col(key).cast("long").alias(key), _numbered(whole_text(text)).alias("t"))
    tokens = numbered.select(key, _tokens(_named(F.col("t"))).alias("tokens"), _tokens(F.col("t")).alias("plain"))
    hashes = tokens.select(key, window_hashes(F.col("tokens"), window).alias("w"), window_hashes(F.col("plain"), window).alias("v"))
    both = F.concat(F.transform("w", lambda h, i: F.struct(i.alias("pos"), h.alias("h"))),
                    F.filter(F.transform(F.arrays_zip("w", "v"), lambda x, i: F.struct(
                        i.alias("pos"), F.when(x["w"] != x["v"], x["v"]).alias("h"))), lambda x: x["h"].isNotNull()))
    # the outer form: the plain one adds a filter on the array's size, pushed below, where it would tokenise again
    return hashes.select(key, F.explode_outer(both).alias("x")).select(
        key, F.col("x.pos").alias(pos), F.col("x.h").alias("h")).where(F.col("h").isNotNull())


def _consistent(a: Column, b: Column, offset: Column, starts: Column, window: int) -> Column:
    """``(consistent, n_slots)`` of the slots in the matched windows, ``starts`` in the item, of one alignment."""
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + (window - 1)))))
    slots = F.filter(F.transform(covered, lambda i: F.struct(
        F.get(b, i)["token"].alias("kind"), F.get(b, i)["value"].alias("theirs"), F.get(a, i + offset).alias("own"))),
        lambda s: s["kind"].isin(NUMBER, NAME, UNIT))
    pairs = F.array_distinct(F.filter(slots, lambda s: (s["kind"] == NAME) | (s["kind"] == NUMBER) & (F.length(s["theirs"]) >= LONG_NUMBER)))
    values, images = (F.array_distinct(F.transform(pairs, lambda s: F.struct(s["kind"], s[side]))) for side in ("theirs", "own"))
    one_to_one = (F.size(pairs) == F.size(values)) & (F.size(pairs) == F.size(images))
    return F.struct(one_to_one.alias("consistent"), F.size(slots).alias("n_slots"))


def _literal(a: Column, b: Column, offset: Column) -> Column:
    """The most words in a row of the item that stand unchanged in the document, in one alignment."""
    same = F.transform(b, lambda x, i: F.coalesce(x["value"] == F.get(a, i + offset), F.lit(False)))

    def step(acc: Column, s: Column) -> Column:
        run = F.when(s, acc["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.greatest(acc["most"], run).alias("most"))

    return F.aggregate(same, F.struct(F.lit(0).alias("run"), F.lit(0).alias("most")), step, lambda acc: acc["most"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id",
                       text: str = "text", window: int = WINDOW, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(doc, item, offset, n_windows, coverage, n_slots)`` of every document and item that it gives away."""
    items = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text"))
    wanted = stored(_windows(items, "item_id", "text", "item_pos", window), "template-windows")
    lengths = wanted.groupBy("item_id").agg((F.max("item_pos") + 1).alias("windows"))
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    docs = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    hits = _windows(docs, "doc_id", "text", "pos", window).join(side, "h")
    aligned = (hits.groupBy("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("offset"))
               .agg(F.collect_set("item_pos").alias("starts")).withColumn("n_windows", F.size("starts"))
               .join(lengths, "item_id").where(F.col("n_windows") >= F.least(F.col("windows"), F.lit(least_words - window + 1))))
    # all places of an item in a document in one row, so that texts are joined once
    places = stored(aligned.groupBy("doc_id", "item_id", "windows").agg(
        F.collect_list(F.struct("offset", "n_windows", "starts")).alias("places")), "template-hits")

    # slots of the aligned stretches, for the documents and items found
    ids = places.select("doc_id").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    own = docs.join(ids, "doc_id").select("doc_id", slot_values(whole_text("text")).alias("a"))
    theirs = items.select("item_id", F.arrays_zip(template_tokens(whole_text("text")).alias("token"),
                                                  slot_values(whole_text("text")).alias("value")).alias("b"))
    both = own.join(places, "doc_id").join(theirs, "item_id")
    slots = F.transform("places", lambda p: F.struct(
        p["n_windows"].alias("n_windows"), (-p["offset"]).alias("back"),
        _consistent(F.col("a"), F.col("b"), p["offset"], p["starts"], window).alias("slots")))
    checked = F.transform(slots, lambda p: F.struct(p["slots"]["consistent"].alias("consistent"), *[p[c].alias(c) for c in (
        "n_windows", "back", "slots")]))
    quote = F.least(F.size("b"), F.lit(least_words))
    best = both.select("doc_id", "item_id", "windows", F.array_max(F.filter(checked, lambda p: p["consistent"] | (
        _literal(F.col("a"), F.col("b"), -p["back"]) >= quote))).alias("x"))
    return (best.where(F.col("x").isNotNull()).groupBy("doc_id", "item_id", "windows").agg(F.max("x").alias("x"))
            .select("doc_id", "item_id", (-F.col("x.back")).alias("offset"), "x.n_windows",
                    (F.col("x.n_windows") / F.col("windows")).alias("coverage"), F.col("x.slots.n_slots").alias("n_slots")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that give away an item; rows without a key are judged by their texts."""
    def hit(rows: DataFrame, by: str) -> DataFrame:
        return stored(find_contamination(rows, benchmark, by).select(F.col("doc_id").alias(by)).distinct(), "contaminated")

    clean = docs.join(hit(docs, key), key, "left_anti").select(*docs.columns)
    nameless = docs.where(F.col(key).isNull())
    if not nameless.limit(1).count():
        return clean
    nameless = nameless.withColumn("_of_text", F.xxhash64("text"))
    judged = nameless.join(hit(nameless.select("_of_text", "text"), "_of_text"), "_of_text", "left_anti").select(*docs.columns)
    return clean.where(F.col(key).isNotNull()).unionByName(judged)
