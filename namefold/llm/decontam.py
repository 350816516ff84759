"""Benchmark decontamination by winnowing, with built-in functions only.

A window is ``SPAN`` consecutive words of an item, or a shorter item as a whole. Of the hashes of the ``GRAM``-word
grams inside each window, the smallest is the window's fingerprint. A window of a document that equals a window of an
item has the same grams, so the same fingerprint: every shared span of ``SPAN`` words is found, while a document
keeps about two fingerprints in seven words.

1. Documents' fingerprints are computed inside the row and exploded as narrow rows, and meet the distinct fingerprints
   of the benchmark in a semi join. The benchmark's are a written table: Spark broadcasts it when its size allows and
   shuffles both sides otherwise.
2. Hits are extended: only texts with a hit are read again, once per distinct text, and the windows of a hit
   fingerprint are compared with the items' windows, word by word.
3. Words inside windows, and items, are counted per distinct text and joined to the documents. Items with the same
   windows are handled as one set, so a passage that many items and many documents share is not multiplied out.

Hashes are of words in full lower case, which only adds candidates; the comparison lowers A-Z only.

Nulls: a null text has no words; an item without an id counts as a found window, but not as an item. Repeated
documents get equal rows; items with one id count once. Documents or items without words match nothing. Other columns
of the documents pass through ``drop_contaminated``; its own columns start with ``_bench_``. An empty table on either
side gives no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namefold.llm.words import PLAIN_WORD, lower_ascii
from namefold.workspace import Workspace

SPAN = 10  # words of a window
GRAM = 5  # words of a hashed gram: SPAN - GRAM + 1 of them are in a window


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(PLAIN_WORD), F.lit(0)), F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(PLAIN_WORD)), F.lit(0)).cast("bigint")


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _starts(size: Column, width: int) -> Column:
    """Places 1 to size - width + 1."""
    return F.when(size >= width, F.sequence(F.lit(1), size - (width - 1))).otherwise(F.array().cast("array<int>"))


def _with_hashes(df: DataFrame) -> DataFrame:
    """Adds the words' hashes and those of the grams at each place."""
    hashes = F.transform(_words(F.col("text")), lambda w: F.xxhash64(F.lower(w)))
    df = df.withColumn("hashes", hashes)
    grams = F.transform(_starts(F.size("hashes"), GRAM), lambda i: F.xxhash64(F.slice("hashes", i, GRAM)))
    return df.withColumn("grams", grams)


def _fingerprints(width: int) -> Column:
    """The fingerprint of the window of ``width`` words at each place."""
    size = F.size("hashes")
    if width < SPAN:
        return F.transform(_starts(size, width), lambda i: F.xxhash64(F.slice("hashes", i, width)))
    return F.transform(_starts(size, SPAN), lambda i: F.array_min(F.slice("grams", i, SPAN - GRAM + 1)))


def _windows(width: int, chosen: Column) -> Column:
    """Place, width and text of the windows of ``width`` words at the places ``chosen``."""
    return F.transform(
        chosen,
        lambda i: F.struct(
            i.cast("int").alias("place"),
            F.lit(width).alias("width"),
            F.array_join(F.slice("words", i, width), " ").alias("window"),
        ),
    )


def benchmark_windows(items: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    """Windows with the key of their set of items, the sets, the distinct fingerprints, and the widths found."""
    own = items.select("item_id", "text").withColumn("n", F.least(n_words(F.col("text")), F.lit(SPAN)))
    own = _with_hashes(own.filter("n > 0")).withColumn("words", _words(lower_ascii(F.col("text"))))
    pairs = F.array().cast("array<struct<place:int,width:int,window:string,print:bigint>>")
    for width in range(1, SPAN + 1):
        zipped = F.zip_with(
            _windows(width, _starts(F.size("words"), width)),
            _fingerprints(width),
            lambda w, h: F.struct(w["place"].alias("place"), w["width"].alias("width"), w["window"].alias("window"), h.alias("print")),
        )
        pairs = F.when(F.col("n") == width, zipped).otherwise(pairs)
    found = own.select("item_id", F.explode(pairs).alias("w")).select("item_id", "w.width", "w.window", "w.print")
    found, _ = ws.save(found.distinct(), "item-windows")
    items_of = found.groupBy("width", "window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    items_of = items_of.withColumn("set", F.unhex(F.md5(F.array_join("items", ","))))
    items_of, _ = ws.save(items_of, "window-items")
    sets, _ = ws.save(items_of.select("set", "items").dropDuplicates(["set"]), "item-sets")
    windows, _ = ws.save(items_of.select("width", "window", "set"), "windows")
    prints, _ = ws.save(found.select("print").distinct(), "prints")
    # At most SPAN numbers.
    widths = sorted(r["width"] for r in found.select("width").distinct().collect())
    return windows, sets, prints, widths


def contaminated_texts(docs: DataFrame, items: DataFrame, ws: Workspace) -> DataFrame:
    """``(key, n_hit, n_items, items_sha256)`` of the distinct texts that share a window with an item."""
    windows, sets, prints, widths = benchmark_windows(items, ws)
    # 1. Candidate texts with the fingerprints that they share with the benchmark.
    own = _with_hashes(docs.select("doc_id", "text", _text_key(F.col("text")).alias("key")))
    every = F.array_distinct(F.concat(F.array().cast("array<bigint>"), *(_fingerprints(w) for w in widths)))
    narrow = own.select("doc_id", "key", F.explode(every).alias("print"))
    hits = narrow.join(prints, "print", "left_semi").groupBy("key")
    hits = hits.agg(F.collect_set("print").alias("hits"), F.min("doc_id").alias("first_id"))
    hits, _ = ws.save(hits, "hits")
    # 2. The windows of these fingerprints, compared with the items'.
    # Of a text's copies only the first is taken on, before an exchange; rows with one id may still repeat.
    texts = docs.select("doc_id", "text", _text_key(F.col("text")).alias("key")).join(hits, "key")
    texts = texts.filter(F.col("doc_id").eqNullSafe(F.col("first_id"))).dropDuplicates(["key"])
    texts = _with_hashes(texts).withColumn("words", _words(lower_ascii(F.col("text"))))
    spans = F.array().cast("array<struct<place:int,width:int,window:string>>")
    for width in widths:
        zipped = F.zip_with(
            _starts(F.size("hashes"), width),
            _fingerprints(width),
            lambda i, h: F.when(F.array_contains("hits", h), i),
        )
        spans = F.concat(spans, _windows(width, F.filter(zipped, lambda i: i.isNotNull())))
    met = texts.select("key", F.explode(spans).alias("w")).select("key", "w.place", "w.width", "w.window")
    met, _ = ws.save(met.join(windows, ["width", "window"]).select("key", "place", "width", "set"), "met")
    # 3. Words inside windows, and items.
    inside = met.select("key", F.explode(F.sequence("place", F.col("place") + F.col("width") - 1)).alias("word"))
    words = inside.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_hit"))
    groups = met.groupBy("key").agg(F.sort_array(F.collect_set("set")).alias("sets"))
    groups = groups.withColumn("mix", F.md5(F.array_join(F.transform("sets", lambda s: F.hex(s)), ",")))
    groups, _ = ws.save(groups, "groups")
    mixes = groups.select("mix", "sets").dropDuplicates(["mix"])
    listed = mixes.select("mix", F.explode("sets").alias("set")).join(sets, "set")
    ids = listed.select("mix", F.explode("items").alias("item")).groupBy("mix")
    ids = ids.agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("ids"))
    named = mixes.select("mix").join(ids, "mix", "left").select(
        "mix",
        F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
    )
    found = groups.select("key", "mix").join(named, "mix").join(words, "key").drop("mix")
    return ws.save(found, "contaminated")[0]


def reports(docs: DataFrame, items: DataFrame, ws: Workspace) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` per document."""
    found = contaminated_texts(docs, items, ws)
    own = docs.select("doc_id", n_words(F.col("text")).alias("n_words"), _text_key(F.col("text")).alias("key"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return own.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, ws: Workspace) -> DataFrame:
    """The rows of ``docs`` that share no window with an item."""
    found = contaminated_texts(docs, items, ws).select(F.col("key").alias("_bench_key"))
    return docs.join(found, _text_key(F.col("text")) == F.col("_bench_key"), "left_anti")
