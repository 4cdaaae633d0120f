"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Names, numbers and units become typed placeholders, so a question whose numbers or names were swapped keeps its template.
Windows of template tokens of all documents meet those of the benchmark in a hash join; for the documents that meet an item the
values behind the placeholders (slots) are compared: in a place of the document that holds a leak, each slot value of the item
maps to one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut

#: Template tokens per window. Items with fewer are matched as one window of their own length; those with fewer than LEAST say too
#: little inside another text, so for them the document must be the item.
WINDOW = 8
LEAST = 3
#: Share of an item's windows that a document must hold, or else
COVERAGE = 0.5
#: so many words beside slots in one unbroken run, whatever their share of the item.
RUN = 13
#: Share of an item's slot values that must map to one value of the document.
CONSISTENT = 0.6
#: The benchmark's window keys are broadcast up to so many rows (24 bytes each); beyond, they are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Units after a number (fixed values).
UNITS = (
    "kg|g|mg|lb|lbs|oz|km|m|cm|mm|mi|ft|in|mile|miles|meter|meters|metre|metres|inch|inches|feet|foot|yard|yards|"
    "l|ml|liter|liters|litre|litres|gallon|gallons|s|sec|second|seconds|min|minute|minutes|h|hour|hours|day|days|week|weeks|"
    "month|months|year|years|usd|eur|gbp|dollar|dollars|euro|euros|cent|cents|percent|kmh|mph|c|f|degree|degrees"
)
#: Characters that mark placeholders; a text's own become spaces.
MARKS = "{}#=~"
#: A capitalised word that begins a sentence, and one after a space. Patterns begin with what they look for, so that the many places
#: where nothing stands cost little, and look back from there.
FIRST = (r"(\p{Lu})(?<=(?:^|[.!?:\n]\s{0,20})\p{Lu})(\p{Ll}++)", "{s=$1$2}")
INSIDE = (r" (\p{Lu}\p{Ll}++)", " {n=$1}")
#: After lower-casing: a number's fraction, and a number with the unit behind it.
FRACTION = (r"(\d)(?<![\p{L}\p{N}{=]\d)(\d*+)[.,:](\d++)", "$1$2d$3")
NUMBER = (r"(\d)(?<![\p{L}\p{N}{=]\d)([0-9d]*)( ?(?:" + UNITS + r")|)(?![\p{L}\p{N}])", "{#=$1$2} {u=$3} ")
PUNCTUATION = (r"[^\p{L}\p{N}{}#=]+", " ")


def canonical(text: Column) -> Column:
    """A text lower-cased without punctuation, where {n=..}, {#=..} and {u=..} stand for names, numbers and units, and {s=..} for
    capitalised words that begin a sentence, which may be names.

    A name is a capitalised word inside a sentence; words in capitals are ordinary words.
    """
    for mark in MARKS:
        text = F.replace(text, F.lit(mark), F.lit(" "))
    for pattern, into in (FIRST, INSIDE):
        text = F.regexp_replace(text, pattern, into)
    text = F.lower(text)
    for pattern, into in (FRACTION, NUMBER):
        text = F.regexp_replace(text, pattern, into)
    for empty, into in (("{u=} ", ""), ("{u= ", "{u=")):
        text = F.replace(text, F.lit(empty), F.lit(into))
    return F.trim(F.regexp_replace(text, *PUNCTUATION))


def plain(text: Column) -> Column:
    """A canonical text whose words that begin a sentence are ordinary words."""
    return F.regexp_replace(text, r"\{s=([^} ]*)\}", "$1")


def named(text: Column) -> Column:
    """A canonical text whose capitalised words that begin a sentence are names."""
    return F.replace(text, F.lit("{s="), F.lit("{n="))


def template(text: Column) -> Column:
    """Hashes of a canonical text's tokens, the slot values left out. First words, if still marked, count as names."""
    bare = F.replace(F.regexp_replace(text, r"=[^} ]*\}", "}"), F.lit("{s}"), F.lit("{n}"))
    return F.transform(F.split(bare, " "), lambda t: F.xxhash64(t))


def _window(hashes: Column, at: Column, n: int, where: Column) -> Column:
    """Hash of the n tokens from place ``at`` (from 0); 0 where there are not so many.

    Not NULL: a join on a column that may be NULL filters its rows first, and the filter would work out the whole template again.
    """
    fits = where & F.get(hashes, at + (n - 1)).isNotNull()
    return F.when(fits, F.xxhash64(*(F.get(hashes, at + k) for k in range(n)), F.lit(n))).otherwise(F.lit(0).cast("long"))


def _windows(hashes: Column, n: int) -> Column:
    """Hashes of the windows of n tokens, by position (from 1). Fewer than LEAST must be the whole text."""
    where = F.size(hashes) == n if n < LEAST else F.lit(True)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(hashes)))
    return F.filter(F.transform(starts, lambda i: F.struct(_window(hashes, i - 1, n, where).alias("key"), i.alias("at"))), lambda w: w["key"] != 0)


def _slots(tokens: Column, start: Column, n: Column) -> Column:
    return F.filter(F.slice(tokens, start, n), lambda t: t.startswith("{"))


#: The level of unbroken runs.
RUNS = 4


def _occurrences() -> Column:
    """The places of an item in a document that a matched window counts for: the text as a whole, its alignment (distance of the
    window's positions), its run, and two overlapping ranges of alignments, so that near ones, as by a word put in, meet in one of them."""
    shift, width = F.col("at") - F.col("i_at"), F.greatest(F.lit(2), F.expr("n_tokens div 2").cast("int"))
    here = lambda level, place: F.struct(F.lit(level).alias("level"), F.col("d_copy"), F.col("i_copy"), place.cast("long").alias("place"))
    none = F.lit(0).cast("long")
    whole = F.struct(F.lit(0).alias("level"), none.alias("d_copy"), none.alias("i_copy"), none.alias("place"))
    in_run = F.shiftleft(shift.cast("long"), 32) + F.col("run")
    return F.array(whole, here(1, shift), here(RUNS, in_run), here(2, F.floor(shift / width)), here(3, F.floor((shift + F.expr("greatest(2, n_tokens div 2) div 2")) / width)))


def leaks(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, consistent: float = CONSISTENT, run: int = RUN) -> DataFrame:
    """Pairs of documents and benchmark items they hold: doc_id, item_id, n_windows (of the item), n_matched, n_slots, n_consistent,
    n_same (slots with the item's own value), coverage, kind ('copy' or 'reparameterised').

    An occurrence counts if it holds ``coverage`` of the item's windows, or an unbroken run with ``run`` words beside slots, and
    ``consistent`` of its slots have one value each.

    Reads doc_id and text, item_id and text; other columns are ignored. NULL and empty texts match nothing, and items of placeholders
    only neither; items of fewer than LEAST tokens match documents that are such an item. Coverage and slots are judged for each occurrence of an item in a document, and for the document as a
    whole, with the capitalised words that begin sentences as ordinary words and as names; the pair is reported, with the figures
    of the fullest that passes, if any does. Rows without doc_id or item_id take no part. Rows that share a doc_id (item_id) count as one document
    (item) holding all their windows. Empty tables give no pairs.
    """
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", canonical(F.col("text")).alias("i_text")).where("i_text <> ''")
    ways = F.array(F.struct(F.lit(0).alias("way"), plain(F.col("i_text")).alias("i_text")), F.struct(F.lit(1).alias("way"), F.col("i_text").alias("i_text")))
    items = items.select("item_id", F.inline(ways)).where((F.col("way") == 0) | F.col("i_text").contains("{s="))
    items = items.withColumns({"i_template": template(F.col("i_text")), "i_tokens": F.split("i_text", " ")}).withColumn("n", F.least(F.lit(window), F.size("i_template")))
    by_length = F.array_sort(F.collect_set("n"))
    lengths = (items.select("n").distinct().agg(by_length.alias("n")).first().n or [])  # at most ``window`` numbers
    if not lengths:
        lengths = [window]

    def sized(hashes: Column, own: bool) -> Column:
        parts = [F.when(F.col("n") == k, _windows(hashes, k)).otherwise(F.array().cast("array<struct<key:bigint,at:int>>")) if own else _windows(hashes, k) for k in lengths]
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    words_to = lambda end: F.size(F.filter(F.slice("i_tokens", F.lit(1), end), lambda t: ~t.startswith("{")))
    i_windows = items.select("item_id", "way", "n", F.xxhash64("i_tokens").alias("i_copy"), F.size("i_tokens").alias("n_tokens"), F.inline(sized(F.col("i_template"), True)), "i_tokens")
    i_windows = i_windows.withColumnsRenamed({"at": "i_at"}).withColumns({
        "i_slots": _slots(F.col("i_tokens"), F.col("i_at"), F.col("n")), "i_before": words_to(F.col("i_at") - 1), "i_through": words_to(F.col("i_at") + F.col("n") - 1),
    }).drop("i_tokens")
    n_windows = i_windows.groupBy("item_id").agg(F.countDistinct("i_at").alias("n_windows"))
    # A window of placeholders only says nothing, and would meet every table of numbers.
    i_windows = i_windows.where(F.size("i_slots") < F.col("n"))
    keys = cut(i_windows.select("key").distinct())
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    docs = documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")

    # All windows of all documents against all keys; only documents with a hit go on. Each token is hashed once for each template,
    # and the windows combine the hashes.
    templates = docs.select("doc_id", canonical(F.col("text")).alias("d_text")).select("doc_id", template(plain(F.col("d_text"))).alias("a"), template(F.col("d_text")).alias("b"))
    # Both templates in one array; a window over its middle meets nothing. Places are numbers, so that tokens are not copied for each.
    at = F.col("at")
    both = templates.select("doc_id", F.size("a").alias("n_tokens"), F.concat("a", "b").alias("both"))
    places = both.select("doc_id", "n_tokens", "both", F.explode(F.sequence(F.lit(0), 2 * F.col("n_tokens") - 1)).alias("at"))
    whole = (at == 0) | (at == F.col("n_tokens"))
    of_place = [_window(F.col("both"), at, k, F.lit(True) if k >= LEAST else whole & (F.col("n_tokens") == k)) for k in lengths]
    all_windows = places.select("doc_id", (of_place[0] if len(lengths) == 1 else F.explode(F.array(*of_place))).alias("key"))
    hit = all_windows.join(keys, "key", "left_semi").select("doc_id").distinct()

    tokens = docs.join(hit, "doc_id").select("doc_id", F.xxhash64("text").alias("d_copy"), canonical(F.col("text")).alias("d_text"))
    tokens = tokens.select("doc_id", "d_copy", F.explode(F.array(plain(F.col("d_text")), named(F.col("d_text")))).alias("d_text"))
    tokens = tokens.select("doc_id", "d_copy", F.split("d_text", " ").alias("d_tokens"), template(F.col("d_text")).alias("d_template"))
    d_windows = tokens.select("doc_id", "d_copy", "d_tokens", F.inline(sized(F.col("d_template"), False)))
    d_windows = d_windows.join(keys, "key", "left_semi").withColumn("d_slots", _slots(F.col("d_tokens"), F.col("at"), F.lit(window))).drop("d_tokens")
    met = d_windows.distinct().join(i_windows, "key")
    met = met.withColumn("d_slots", F.slice("d_slots", 1, F.greatest(F.size("i_slots"), F.lit(1))))
    # Windows of one alignment that follow each other are a run; there are no more in order than an item has windows.
    aligned = Window.partitionBy("doc_id", "d_copy", "item_id", "way", "i_copy", F.col("at") - F.col("i_at")).orderBy("i_at")
    met = met.withColumn("run", F.col("i_at") - F.dense_rank().over(aligned))
    met = met.withColumn("o", F.explode(_occurrences()))
    group = ["doc_id", "item_id", "way", "o"]
    words = F.when(F.col("o.level") == RUNS, F.max("i_through") - F.min("i_before")).otherwise(0)
    pairs = met.groupBy(*group).agg(F.countDistinct("i_at").alias("n_matched"), words.alias("n_run")).join(n_windows, "item_id")
    pairs = pairs.withColumn("coverage", F.col("n_matched") / F.col("n_windows")).where((F.col("coverage") >= coverage) | (F.col("n_run") >= run))
    slot = F.explode(F.arrays_zip(F.col("i_slots").alias("i"), F.col("d_slots").alias("d"))).alias("slot")
    slots = met.where(F.size("i_slots") > 0).select(*group, slot).select(*group, "slot.*").toDF(*group, "i", "d")
    per_value = slots.groupBy(*group, "i").agg(F.min("d").alias("least"), F.max("d").alias("most"))
    value = F.replace("i", F.lit("{s="), F.lit("{n="))
    one, same = F.col("least") == F.col("most"), (F.col("least") == value) & (F.col("most") == value)
    first = F.col("i").startswith("{s=")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    per_pair = per_value.groupBy(*group).agg(F.count(F.lit(1)).alias("n_slots"), count(one).alias("n_consistent"), count(same).alias("n_same"), count(first).alias("n_first"), count(first & one).alias("n_first_consistent"))
    out = pairs.join(per_pair, group, "left").fillna(0, ["n_slots", "n_consistent", "n_same", "n_first", "n_first_consistent"])
    # First words are judged by themselves, lest words that are no names outweigh the others.
    out = out.where(F.col("n_first_consistent") >= consistent * F.col("n_first"))
    out = out.where(F.col("n_consistent") - F.col("n_first_consistent") >= consistent * (F.col("n_slots") - F.col("n_first")))
    best = F.max(F.struct("n_matched", (F.col("way") == 0).alias("is_plain"), (F.col("n_same") == F.col("n_slots")).alias("is_copy"), "n_same", "n_consistent", "n_slots", "n_windows", "coverage")).alias("best")
    out = out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
    kind = F.when(F.col("n_same") == F.col("n_slots"), "copy").otherwise("reparameterised")
    return out.select("doc_id", "item_id", "n_windows", "n_matched", "n_slots", "n_consistent", "n_same", "coverage", kind.alias("kind"))
