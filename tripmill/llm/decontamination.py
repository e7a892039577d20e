"""Benchmark decontamination: a broadcast hash set of item windows against every window of every document.

Only built-in functions run. Each document word's window is hashed and looked up in the set of the items'
windows; a hit is verified by comparing the words. The set is bounded by the benchmark, not by the documents,
and its size is checked before it is broadcast. For a larger one only the hash of each window is shuffled, without its
words; what is found is brought together by document and verified against its words then.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import whole_text
from tripmill.scratch import new_folder, stage

# Words in a window.
WINDOW = 10
# Bytes between words, once A-Z are lower case. Fixed by the task.
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same cut in text whose letters have any case.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
# Windows, and items that have them, that may be broadcast: about 200 bytes each.
MAX_BROADCAST_WINDOWS = 500_000


def words(text: Column) -> Column:
    """The words of a text: A-Z in lower case, cut at every other ASCII character that is no letter or digit."""
    ascii_only = F.length(text) == F.octet_length(text)
    # Only A-Z change. On ASCII text that is what lower() does, and it is much faster.
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lowered, _BETWEEN_WORDS), "")


def _key(words: Column, start: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *(F.get(words, start + k) for k in range(length)))


def _item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """Each distinct window of the items: its length, words, and the items that have it."""
    parts = items.select(F.col(item_col).cast("string").alias("item"), words(whole_text(text_col)).alias("w"))
    parts = parts.filter(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(window)))
    starts = F.sequence(F.lit(0), F.size("w") - F.col("length"))
    spans = parts.select("item", "w", "length", F.explode(starts).alias("start"))
    spans = spans.select("item", "length", F.expr("slice(w, start + 1, length)").alias("window"))
    return spans.groupBy("length", "window").agg(F.collect_set("item").alias("items"))


def _hits(rows: DataFrame, windows: DataFrame, lengths: list[int], fits: bool) -> DataFrame:
    """Per row with a hit: ``at``, the windows hit as (start, length), and ``items``. One scan for all lengths."""
    # Hashes are of the length, too, so windows of different lengths do not meet.
    key = F.when(F.lit(False), F.lit(0).cast("long"))
    for length in lengths:
        key = key.when(F.col("length") == length, _key(F.col("window"), F.lit(0), length))
    known = windows.select(key.alias("key"), "length", "window", "items")
    at = rows.select("row_id", "text_key", "w", F.posexplode("w").alias("start", "word"))
    if fits and len(lengths) == 1:
        length = lengths[0]
        keyed = at.filter(F.col("start") <= F.size("w") - length)
        keyed = keyed.select("row_id", "text_key", "start", "w", _key(F.col("w"), F.col("start"), length).alias("key"))
        hits = keyed.join(F.broadcast(known), "key")
        hits = hits.filter(F.slice("w", F.col("start") + 1, F.lit(length)) == F.col("window"))
        return hits.groupBy("row_id", "text_key").agg(
            F.array_sort(F.collect_set(F.struct("start", "length"))).alias("at"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
    # The words stay behind: a row of them for each of their windows would be quadratic in the text's length.
    of_length = {
        f"key_{length}": F.when(F.col("start") <= F.size("w") - length, _key(F.col("w"), F.col("start"), length))
        for length in lengths
    }
    keyed = at.select("row_id", "text_key", "start", *(column.alias(name) for name, column in of_length.items()))
    keyed = keyed.select("row_id", "text_key", "start", F.explode(F.array(*of_length)).alias("key")).filter("key IS NOT NULL")
    hits = keyed.join(F.broadcast(known) if fits else known, "key")
    hit = F.struct("start", "length", "window", "items")
    by_row = hits.groupBy("row_id", "text_key").agg(F.collect_set(hit).alias("hits"))
    own = rows.select(F.col("row_id").alias("own_id"), F.col("text_key").alias("own_key"), "w")
    same = by_row["row_id"].eqNullSafe(own["own_id"]) & (by_row["text_key"] == own["own_key"])
    joined = by_row.join(own.dropDuplicates(["own_id", "own_key"]), same)
    right = F.filter("hits", lambda h: F.slice("w", h["start"] + 1, h["length"]) == h["window"])
    verified = joined.select("row_id", "text_key", right.alias("hits")).filter(F.size("hits") > 0)
    return verified.select(
        "row_id",
        "text_key",
        F.array_sort(F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["length"].alias("length")))).alias("at"),
        F.array_distinct(F.flatten(F.col("hits.items"))).alias("items"),
    )


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    *,
    with_text_key: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``,
    and ``spans``, the hit stretches as (first word, words).

    A document word inside any occurrence of an item's window is hit; an item of fewer words, but not none, is
    one window. NULL and empty texts have no words, and items without words hit nothing. A NULL item id counts
    as no item, but its words are hit. Rows of one id and one text share their result, rows of one id and
    different texts each have their own; a NULL id is an id. Ties do not arise: items are a set. Other columns
    are ignored. Without documents the result is empty; without items nothing is hit. ``with_text_key`` adds the
    xxhash64 of the text, which tells apart rows of one id.
    """
    spark = docs.sparkSession
    windows = stage(_item_windows(items, item_col, item_text_col, window), new_folder(spark, "windows"))
    sizes = windows.groupBy("length").agg(F.count("*").alias("n"), F.sum(F.size("items")).alias("items")).collect()
    lengths = sorted(row["length"] for row in sizes)
    fits = sum(row["n"] + row["items"] for row in sizes) <= MAX_BROADCAST_WINDOWS

    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("row_id"), F.xxhash64(text).alias("text_key"), words(text).alias("w"))
    found = _hits(rows, windows, lengths, fits) if lengths else None
    counts = rows.select("row_id", "text_key", F.size("w").alias("n_words"))
    if found is None:
        empty = "array<struct<start:int,length:int>>"
        joined = counts.withColumns({"at": F.lit(None).cast(empty), "items": F.lit(None).cast("array<string>")})
    else:
        same = counts["row_id"].eqNullSafe(found["row_id"]) & (counts["text_key"] == found["text_key"])
        joined = counts.join(found, same, "left").select(counts["*"], found["at"], found["items"])
    found_items = F.sort_array(F.coalesce("items", F.array().cast("array<string>")))
    result = joined.select(
        F.col("row_id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        _stretches(F.coalesce("at", F.array().cast("array<struct<start:int,length:int>>"))).alias("spans"),
        F.size(found_items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found_items), 256).alias("items_sha256"),
        "text_key",
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["length"])
    result = result.withColumn("n_hit", n_hit).withColumn("contaminated", F.col("n_hit") > 0)
    columns = [id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
    return result.select(*columns, *(["text_key"] if with_text_key else []))


def _stretches(at: Column) -> Column:
    """Windows sorted by start as the maximal stretches of words they cover."""

    def span(start: Column, end: Column) -> Column:
        return F.array(F.struct(start.alias("start"), (end - start).alias("length")))

    def merge(state: Column, window: Column) -> Column:
        end = window["start"] + window["length"]
        apart = window["start"] > state["end"]
        closed = F.concat(state["done"], span(state["start"], state["end"]))
        return F.struct(
            F.when(apart, window["start"]).otherwise(state["start"]).alias("start"),
            F.when(apart, end).otherwise(F.greatest(state["end"], end)).alias("end"),
            F.when(apart & (state["end"] > state["start"]), closed).otherwise(state["done"]).alias("done"),
        )

    def finish(state: Column) -> Column:
        last = F.concat(state["done"], span(state["start"], state["end"]))
        return F.when(state["end"] > state["start"], last).otherwise(state["done"])

    none = F.array().cast("array<struct<start:int,length:int>>")
    begin = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), none.alias("done"))
    return F.aggregate(at, begin, merge, finish)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    remove: str = "documents",
) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the hit words of each.

    A removed word takes the characters up to the next word with it. Rules as in :func:`find_contamination`;
    columns and rows that are not contaminated are unchanged.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    found = find_contamination(docs, items, id_col, text_col, item_col, item_text_col, window, with_text_key=True)
    found = found.filter("contaminated").select(
        F.col(id_col).alias("hit_id"), F.col("text_key").alias("hit_key"), F.col("spans").alias("hit_spans")
    )
    found = found.dropDuplicates(["hit_id", "hit_key"]).alias("found")
    docs_ = docs.alias("docs")
    given = F.col(f"docs.`{text_col}`")
    key = F.xxhash64(whole_text(given))
    same = F.col(f"docs.`{id_col}`").eqNullSafe(F.col("found.hit_id")) & (key == F.col("found.hit_key"))
    if remove == "documents":
        return docs_.join(found, same, "left_anti")
    spans = F.col("found.hit_spans")
    pieces = F.regexp_extract_all(given, F.lit(f"({_WORD}{_BETWEEN_ANY_CASE})"), 1)
    kept = F.filter(
        pieces,
        lambda _, i: ~F.exists(spans, lambda span: (i >= span["start"]) & (i < span["start"] + span["length"])),
    )
    lead = F.regexp_extract(given, f"^({_BETWEEN_ANY_CASE})", 1)
    cut = F.when(spans.isNull(), given).otherwise(F.concat(lead, F.concat_ws("", kept)))
    return docs_.join(found, same, "left").select(
        *(cut.alias(name) if name == text_col else F.col(f"docs.`{name}`") for name in docs.columns)
    )
