"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, units after numbers and capitalised words inside a sentence become typed slots; the rest is
lower-cased words without punctuation.  Windows of ``WINDOW`` template words of the benchmark are joined by
hash with the windows of every document.  A document holds an item if enough of the item's windows occur in one
alignment (the shift most windows share, and those up to ``NEAR`` words beside it, as after an inserted word),
and if the slots of the aligned stretch are filled consistently: one value of the item must stand for one
value of the document throughout.  So an item with other numbers or names is found, while a text that only
shares turns of phrase is not.

The benchmark's windows are counted first: up to ``BROADCAST_WINDOWS`` of them are broadcast and documents
are not shuffled at all, beyond that both sides are shuffled on the hash.  Hits are few and are written to
the shared folder.  A window of slots alone says nothing and is left out.

Defined results: NULL and empty texts hold nothing; an item of fewer words than a window is held only by a
document that is nothing else; repeated ids of documents or items are taken as one text's hits; all other
columns are ignored, whatever their names; an empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelfold.llm.common import stage, text_of

WINDOW = 5
LEAST_COVERAGE = 0.5  # of an item's windows
LEAST_RUN = 25  # or so many windows, of a long item
NEAR = 8  # words that an alignment may slip
LEAST_CONSISTENT = 0.8  # of the aligned slots
BROADCAST_WINDOWS = 1_000_000  # 16 bytes each before the map's overhead

# Marks of the slot types, from the private use area: number, unit, name; the fourth joins the parts of a number.
NUMBER, UNIT, NAME, JOINT = "\ue001", "\ue002", "\ue003", "\ue004"
UNITS = (
    "%|km|cm|mm|kg|mg|ml|lb|lbs|oz|ft|mph|miles?|met(?:er|re)s?|grams?|lit(?:er|re)s?|inch(?:es)?|feet|seconds?|minutes?|hours?|days?"
    "|weeks?|months?|years?|dollars?|cents?|euros?|pounds?|percent|degrees?"
)
# (pattern, replacement) in order; $n is a group.  No look-around, so that other regex engines can run them.
_NAMES = ("([\\p{Ll}\\p{Nd},;:)] )(\\p{Lu}[\\p{L}\\p{M}]*)", f"$1{NAME}$2")
RULES = (
    (f"[{NUMBER}-{JOINT}]", " "),
    ("(\\p{Nd})[.,](\\p{Nd})", f"$1{JOINT}$2"),
    ("(\\p{Nd})[.,](\\p{Nd})", f"$1{JOINT}$2"),  # the digit between two separators belongs to both
    _NAMES,
    _NAMES,  # a name after a name
    (f"(^|[^\\p{{L}}\\p{{Nd}}{JOINT}])(\\p{{Nd}}[\\p{{Nd}}{JOINT}]*)", f"$1 {NUMBER}$2 "),
    (f"({NUMBER}[\\p{{Nd}}{JOINT}]*) +({UNITS})([^\\p{{L}}]|$)", f"$1 {UNIT}$2 $3"),
    (f"[^\\p{{L}}\\p{{M}}\\p{{Nd}}%{NUMBER}-{JOINT}]+", " "),
)
SLOT_RULE = (f"([{NUMBER}-{NAME}])[^ ]*", "$1")


def canonical(text: Column) -> Column:
    """Lower-case words and marked slots, parted by single spaces."""
    for pattern, replacement in RULES:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(replacement))
    return F.trim(F.lower(text))


def template(canonical_text: Column) -> Column:
    """The canonical text with the slots' values taken out."""
    return F.regexp_replace(canonical_text, F.lit(SLOT_RULE[0]), F.lit(SLOT_RULE[1]))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, " "), "")


def _windows(rows: DataFrame, keys: list[str], window: int) -> DataFrame:
    """(keys, n, at, h): every window's place and hash; ``n`` windows in all."""
    rows = rows.select(*keys, F.transform(_words(template(canonical(F.col("text")))), lambda w: F.xxhash64(w)).alias("w"))
    # No filter and no second use of the words: either would compute the canonical text once more.
    rows = rows.withColumn("n", F.greatest(F.lit(1), F.size("w") - (window - 1)))
    hashes = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.xxhash64(F.slice("w", i, window)))
    return rows.select(*keys, "n", F.posexplode(hashes).alias("at", "h"))


def _items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    return benchmark.select(F.col(f"`{key}`").alias("item_id"), text_of(text).alias("text")).where("item_id IS NOT NULL")


def _informative(text: Column, window: int) -> Column:
    """Places of the windows that hold at least one plain word."""
    words = _words(template(canonical(text)))
    plain = F.transform(words, lambda w: ~w.rlike(f"^[{NUMBER}-{NAME}]"))
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - (window - 1)))
    return F.transform(F.filter(places, lambda i: F.exists(F.slice(plain, i, window), lambda p: p)), lambda i: i - 1)


def find_items(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    coverage: float = LEAST_COVERAGE,
    run: int = LEAST_RUN,
    consistent: float = LEAST_CONSISTENT,
) -> DataFrame:
    """One row per document and item it holds.

    Columns: ``key``, ``item_id``, ``n_windows`` of the item, ``n_matched`` of them, ``n_slots`` aligned and
    ``n_consistent`` of them.
    """
    docs = documents.select(F.col(f"`{key}`").alias("doc_id"), text_of(text).alias("text")).where("doc_id IS NOT NULL")
    items = _items(benchmark, item, item_text)
    useful = items.select("item_id", F.explode(_informative(F.col("text"), window)).alias("at")).distinct()
    known = _windows(items, ["item_id"], window).join(useful, ["item_id", "at"], "left_semi")
    known = stage(known.select("item_id", F.col("n").alias("n_windows"), F.col("at").alias("item_at"), "h"), "benchmark-windows")
    table = known.select("item_id", "item_at", "h")
    if table.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        table = F.broadcast(table)
    hits = stage(_windows(docs, ["doc_id"], window).select("doc_id", "at", "h").join(table, "h").drop("h"), "hits")
    size = known.groupBy("item_id").agg(F.countDistinct("item_at").alias("n_windows"))
    # The alignment that most windows share.
    shifts = hits.groupBy("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.count("*").alias("n"), F.collect_set("item_at").alias("places")
    )
    best = shifts.groupBy("doc_id", "item_id").agg(F.max(F.struct("n", -F.col("shift"), "shift", "places")).alias("b"))
    best = stage(best.select("doc_id", "item_id", "b.shift", "b.places"), "alignments")
    near = hits.join(best.drop("places"), ["doc_id", "item_id"]).where(F.abs(F.col("at") - F.col("item_at") - F.col("shift")) <= NEAR)
    found = near.select("doc_id", "item_id", "item_at").distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("n_matched"))
    found = found.join(size, "item_id").where((F.col("n_matched") >= coverage * F.col("n_windows")) | (F.col("n_matched") >= run))
    found = stage(found.join(best, ["doc_id", "item_id"]), "candidates")
    slots = _consistency(found, docs, items, window)
    out = found.join(slots, ["doc_id", "item_id"], "left").na.fill(0, ["n_slots", "n_consistent"])
    out = out.where(F.col("n_consistent") >= consistent * F.col("n_slots"))
    return out.select(F.col("doc_id").alias(key), "item_id", "n_windows", "n_matched", "n_slots", "n_consistent")


def _consistency(found: DataFrame, docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """(doc_id, item_id, n_slots, n_consistent): aligned slots, and those that agree with their value's usual filling."""
    places = items.select("item_id", F.posexplode(_words(canonical(F.col("text")))).alias("slot", "value"))
    places = places.where(F.col("value").rlike(f"^[{NUMBER}-{NAME}]"))
    asked = found.join(places, "item_id").where(
        F.exists("places", lambda p: (p <= F.col("slot")) & (F.col("slot") < p + window))
    )
    asked = stage(asked.select("doc_id", "item_id", "shift", "slot", "value"), "slots")
    held = docs.join(asked.select("doc_id").distinct(), "doc_id", "left_semi")
    held = held.select("doc_id", _words(canonical(F.col("text"))).alias("words"))
    filled = asked.join(held, "doc_id").select("doc_id", "item_id", "value", F.get("words", F.col("slot") + F.col("shift")).alias("filling"))
    each = filled.groupBy("doc_id", "item_id", "value", "filling").agg(F.count("*").alias("n"))
    each = each.groupBy("doc_id", "item_id", "value").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    return each.groupBy("doc_id", "item_id").agg(F.sum("n").alias("n_slots"), F.sum("most").alias("n_consistent"))
