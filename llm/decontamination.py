"""Documents that hold benchmark questions, also with other numbers, names or units.

In DataFrame operations only. A text becomes template tokens: numbers, names (a
capital inside a sentence) and units stand as typed placeholders, other words in
lower case without punctuation; white space counts as one space. Texts with names have a second, plain template
in which names are words like others, so that copies in other case match too;
it doesn't count along alignments whose marked slots disagree. Hashes of WINDOW tokens in a row are joined with those
of the benchmark. Along one alignment the slots must agree: whatever stands for one value
of the item is the same value throughout. A document and an item match when the windows found
along all alignments whose slots agree hold COVERAGE of the item's tokens, or when RUN tokens in
a row stand along one of them, whatever their share. A slot counts as changed when its
value stands in none of those alignments.

The benchmark side is broadcast only while it has at most BROADCAST_WINDOWS windows.
Defined results: null or empty texts and items match nothing; items of less than
WINDOW tokens are matched by their whole length only against windows of that
length, down to SHORT tokens; an item below that matches the documents whose whole text has the same tokens, as inside
longer texts its few words prove nothing; repeated rows of documents give
one row per item and distinct (doc_id, text); a null doc_id is kept as null; null item_ids are
items too. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stash, text_key

WINDOW, COVERAGE = 8, 0.5
SHORT, RUN = 5, 13
BROADCAST_WINDOWS = 500_000
NAME, NUMBER, UNIT, AFTER = "\x02", "\x03", "\x04", "\x05"
# Units of measure and money.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t oz lb lbs ml cl dl l ms s sec min h hr hrs day days week weeks month months "
    "year years second seconds minute minutes hour hours meter meters metre metres kilometer kilometers mile miles "
    "gram grams kilogram kilograms liter liters litre litres percent dollar dollars euro euros cent cents pound pounds "
    "usd eur gbp"
)
PUNCTUATION = r"[!-/:-@\[-`{-~«»“”„‘’–—…¿¡]+"


def marked(text: Column) -> Column:
    """The text with a mark before each slot value, without punctuation, in lower case."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x00-\\x20\\x7f\\p{Z}]+", " ")  # the marks too
    text = F.regexp_replace(text, r"(?<=[\p{Ll}\d,;] )(\p{Lu}\p{L}*\p{Ll})", f"{NAME}$1")
    numbers = F.regexp_replace(text, r"(?<![\p{L}\p{N}.,\x02])(\d)", f"{NUMBER}$1")
    # Inside a number, points and commas belong to it.
    numbers = F.regexp_replace(numbers, r"(?<=\d)[.,](?=\d)", AFTER)
    numbers = F.regexp_replace(numbers, rf"(?i)(\d) ?\b({'|'.join(UNITS.split())})\b", f"$1 {UNIT}$2")
    text = F.when(text.rlike("[0-9]"), numbers).otherwise(text)
    return F.lower(F.regexp_replace(text, PUNCTUATION, " "))


BLANK = "[\\x00-\\x01\\x06-\\x20\\x7f]+"


def with_tokens(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, plain, _values (tokens, slot values with their mark) and _types (tokens, slots as their mark alone).

    A text with names has a second row, with plain = 1, whose names aren't marked; its tokens have the same places.
    """
    rows = df.select(*keys, F.btrim(marked(F.col(text))).alias("_marked"))
    both = F.array("_marked", F.replace("_marked", F.lit(NAME), F.lit("")))
    templates = F.when(F.instr("_marked", NAME) > 0, both).otherwise(F.array("_marked"))
    rows = rows.select(*keys, F.posexplode(templates).alias("plain", "_marked"))
    slotted = F.greatest(*[F.instr("_marked", mark) for mark in (NAME, NUMBER, UNIT)]) > 0
    types = F.regexp_replace("_marked", f"([{NAME}-{UNIT}])[^\\x00-\\x01\\x06-\\x20\\x7f]*", "$1")
    rows = rows.withColumn("_values", F.split("_marked", BLANK))
    return rows.withColumn("_types", F.when(slotted, F.split(types, BLANK)).otherwise(F.col("_values"))).drop("_marked")


def windows(tokens: DataFrame, keys: list[str], sizes: list[int]) -> DataFrame:
    """(keys, size, pos, h): every run of `size` template tokens, for each of `sizes`."""
    rows = tokens.select(*keys, F.transform("_types", lambda t: F.xxhash64(t)).alias("_hashes"))

    def runs(size: int) -> DataFrame:
        many = F.greatest(F.size("_hashes") - (size - 1), F.lit(0))
        shifted = [F.slice("_hashes", k + 1, many).alias(f"w{k}") for k in range(size)]
        zipped = rows.select(*keys, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "_run"))
        h = F.xxhash64(*[F.col(f"_run.w{k}") for k in range(size)])
        return zipped.select(*keys, F.lit(size).alias("size"), "pos", h.alias("h"))

    return reduce(DataFrame.unionAll, [runs(size) for size in sizes])


def slots_at(values: Column, pos: Column, size: Column) -> Column:
    return F.filter(F.slice(values, pos + 1, size), lambda v: (v >= NAME) & (v < AFTER))


def longer_run(at: Column, n: int) -> Column:
    """Whether sorted distinct positions hold `n` in a row."""
    return F.exists(F.transform(at, lambda p, k: F.coalesce(F.get(at, k + (n - 1)) - p == n - 1, F.lit(False))), lambda x: x)


def item_windows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Windows of each item: of WINDOW tokens, or the whole of a shorter item."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("_item"), text_key(text).alias("item_key"))
    rows = rows.dropDuplicates(["item_id", "item_key"])
    keys = ["item_id", "item_key"]
    tokens = with_tokens(rows, keys, "_item").where(F.col("_values")[0] != "")
    tokens = tokens.withColumnRenamed("plain", "template")
    every = windows(tokens, [*keys, "template"], list(range(SHORT, WINDOW + 1))).withColumnsRenamed({"pos": "item_pos"})
    own = tokens.select(F.col("item_id").alias("_id"), F.col("item_key").alias("_key"), F.col("template").alias("_no"), "_values")
    same = F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("item_key") == F.col("_key")) & (F.col("template") == F.col("_no"))
    every = every.join(own, same).where(F.col("size") == F.least(F.size("_values"), F.lit(WINDOW)))
    slots = slots_at(F.col("_values"), F.col("item_pos"), F.col("size"))
    return every.select("item_id", "item_key", "template", "size", "item_pos", "h", slots.alias("item_slots"))


def short_texts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys and _short, the tokens without marks, of texts of one to SHORT - 1 tokens."""
    words = df.select(*keys, F.btrim(F.translate(marked(F.col(text)), NAME + NUMBER + UNIT, "")).alias("_words"))
    rows = words.where(F.col("_words") != "").select(*keys, F.split("_words", BLANK).alias("_short"))
    return rows.where(F.size("_short") < SHORT).distinct()


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """(doc_id, text_key, item_id, coverage, n_slots, n_changed) of each document and item that match."""
    items = stash(item_windows(benchmark, item_id, item_text), "items")
    slotted = F.size("item_slots") > 0
    facts = items.agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes"), F.max(slotted).alias("slotted")).first()
    totals = items.groupBy("item_id", "item_key").agg(
        F.max(F.col("item_pos") + F.col("size")).alias("n_tokens"), F.max("size").alias("size")
    )
    small = facts["n"] <= BROADCAST_WINDOWS
    side = F.broadcast if small else (lambda df: df)

    keys = ["doc_id", "text_key"]
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    rows = rows.withColumn("text_key", text_key("_text"))
    tokens = with_tokens(rows, keys, "_text")
    hits = windows(tokens, [*keys, "plain"], sorted(facts["sizes"]) or [WINDOW]).join(side(items), ["size", "h"])
    if facts["slotted"]:
        # Slot values of the documents that match, from their texts.
        hits = stash(hits, "hits")
        wanted = hits.where(slotted).select(*keys, "plain").distinct()
        same = F.col("w.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("w.text_key") == F.col("t.text_key"))
        same &= F.col("w.plain") == F.col("t.plain")
        own = tokens.alias("t").join(wanted.alias("w"), same, "left_semi").dropDuplicates([*keys, "plain"])
        own = own.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("plain").alias("_plain"), "_values")
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")) & slotted
        same &= F.col("plain") == F.col("_plain")
        slots = slots_at(F.col("_values"), F.col("pos"), F.col("size"))
        hits = hits.join(own, same, "left").withColumn("slots", slots).drop("_id", "_key", "_plain", "_values")
    else:
        hits = hits.withColumn("slots", F.lit(None).cast("array<string>"))

    pair = F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    along = [*keys, "item_id", "item_key", (F.col("pos") - F.col("item_pos")).alias("shift")]
    # One group holds at most the windows of one item.
    found = hits.groupBy(*along).agg(*[
        column
        for k, mine in enumerate((F.col("template") == 0, F.col("template") == 1))
        for column in (
            F.array_sort(F.collect_set(F.when(mine, F.col("item_pos")))).alias(f"at{k}"),
            F.array_distinct(F.flatten(F.collect_list(F.when(slotted & mine, pair)))).alias(f"slots{k}"),
        )
    ])
    values = F.array_distinct(F.transform("slots", lambda p: p["a"]))
    agree = F.size("slots") == F.size(values)
    # Where the marked slots disagree, the plain template doesn't count either.
    first = F.size("slots0") == F.size(F.array_distinct(F.transform("slots0", lambda p: p["a"])))
    templates = [F.struct(F.lit(k).alias("template"), F.col(f"at{k}").alias("at"), F.col(f"slots{k}").alias("slots")) for k in (0, 1)]
    found = found.where(first).select(*along[:-1], "shift", F.inline(F.array(*templates)))
    agreed = found.where(agree & (F.size("at") > 0)).withColumns({
        "values": values,
        "kept": F.transform(F.filter("slots", lambda p: p["a"] == p["b"]), lambda p: p["a"]),
        "run": longer_run(F.col("at"), RUN - WINDOW + 1),
    })
    together = lambda name: F.array_distinct(F.flatten(F.collect_set(name)))
    united = agreed.groupBy(*along[:-1], "template").agg(
        F.array_sort(together("at")).alias("at"),
        F.size(together("values")).alias("n_slots"),
        F.size(together("kept")).alias("n_kept"),
        F.max("run").alias("run"),
    )
    joined = united.join(side(totals.withColumnRenamed("item_id", "_id")), [
        F.col("_id").eqNullSafe(F.col("item_id")), totals["item_key"] == united["item_key"]
    ])
    at, size = F.col("at"), F.col("size")
    # A window covers its tokens up to the next window found.
    covered = F.transform(at, lambda p, k: F.least(size, F.coalesce(F.get(at, k + 1) - p, size)))
    whole = F.aggregate(covered, F.lit(0), lambda s, x: s + x) / F.col("n_tokens")
    matched = joined.withColumn("_whole", whole).where((F.col("_whole") >= coverage) | F.col("run"))
    best = F.max(F.struct("_whole", "n_slots", (F.col("n_slots") - F.col("n_kept")).alias("n_changed"))).alias("best")
    leaks = matched.groupBy("doc_id", "text_key", "item_id").agg(best).select(
        "doc_id", "text_key", "item_id", F.col("best._whole").alias("coverage"),
        F.col("best.n_slots").cast("long").alias("n_slots"), F.col("best.n_changed").cast("long").alias("n_changed"),
    )
    few = short_texts(benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("_item")), ["item_id"], "_item")
    if few.isEmpty():
        return leaks
    none = F.lit(0).cast("long")
    alike = short_texts(rows, keys, "_text").join(few, "_short")
    return leaks.unionByName(alike.select(*keys, "item_id", F.lit(1.0).alias("coverage"), none.alias("n_slots"), none.alias("n_changed")))


def drop_leaking(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `documents` that match no item."""
    leaks = find_leaks(documents, benchmark).select("doc_id", "text_key").distinct()
    same = leaks["doc_id"].eqNullSafe(documents["doc_id"]) & (leaks["text_key"] == text_key("text"))
    return documents.join(leaks, same, "left_anti")
