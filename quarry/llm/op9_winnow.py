"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words give k-gram hashes, and each run of ``window`` neighbouring hashes keeps
its smallest: any ``k + window - 1`` = 13 words shared by a document and an item
share a kept hash. Kept hashes of both sides are joined; around each hit the
13-word windows are compared as text, which extends the hit to all shared words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import NO_ID, small, text_version, written

SPAN = 13
K = 8
WINDOW = SPAN - K + 1
#: Fixed pattern of the separators between words.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Broadcast at most so many kept hashes (9 bytes each) or window texts of the benchmark.
SMALL_HASHES, SMALL_WINDOWS = 1_000_000, 200_000


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, BREAKS), lambda w: w != "")


def _paired(left: str, by: int, fn) -> Column:
    """fn(x[i], x[i + by]) for every i that has both."""
    n = F.greatest(F.size(left) - by, F.lit(0))
    return F.zip_with(F.slice(F.col(left), F.lit(1), n), F.slice(F.col(left), F.lit(1 + by), n), fn)


def with_grams(df: DataFrame) -> DataFrame:
    """Adds ``grams``: the hash of the 8 words from each position of ``words``."""
    df = df.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    for name, of, by in (("h2", "h1", 1), ("h4", "h2", 2), ("grams", "h4", 4)):
        df = df.withColumn(name, _paired(of, by, lambda a, b: F.xxhash64(a, b)))
    return df.drop("h1", "h2", "h4")


def with_kept(df: DataFrame) -> DataFrame:
    """Adds ``kept``: the distinct smallest hashes of all windows of 6 grams."""
    df = with_grams(df)
    for name, of, by in (("m2", "grams", 1), ("m4", "m2", 2), ("m6", "m4", 2)):
        df = df.withColumn(name, _paired(of, by, lambda a, b: F.least(a, b)))
    return df.withColumn("kept", F.array_distinct("m6")).drop("grams", "m2", "m4", "m6")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ``version`` (hash of the text), ``n_words``, ``n_hit`` (words inside any occurrence of an
    item window), ``n_items`` (items with such windows), ``items_sha256`` and
    ``contaminated`` (at least a twentieth of the words is hit). An item of
    fewer than 13 words, but not none, is one window. A null text has no words;
    an item without an id hits, but is not among the items. Repeated rows and
    items change nothing else."""
    items = written(benchmark.select(F.col(item_id_col).cast("string").alias("item_id"), words(F.col(item_text_col)).alias("words"))
                    .where(F.size("words") > 0).distinct())
    length = F.least(F.size("words"), F.lit(SPAN))
    spots = F.transform(F.sequence(F.lit(1), F.size("words") - length + 1),
                        lambda i: F.concat_ws(" ", F.slice(F.col("words"), i, length)))
    windows = written(items.select("item_id", length.alias("length"), F.explode(spots).alias("window")).distinct())
    short = [r[0] for r in windows.where(F.col("length") < SPAN).select("length").distinct().collect()]  # at most 12 numbers
    long_items = items.where(F.size("words") >= SPAN)
    kept_items = small(with_kept(long_items).select(F.explode_outer("kept").alias("hash")).distinct(), SMALL_HASHES)

    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    base = docs.select(rank.alias("key"), text_version(text_col).alias("version"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hits = (with_kept(base.select("key", "version", words(F.col("text")).alias("words")))
            .select("key", "version", F.explode_outer("kept").alias("hash"))
            .join(kept_items, "hash").groupBy("key", "version").agg(F.collect_set("hash").alias("hashes")))
    found = base.join(hits, ["key", "version"], "left").select("key", "version", "doc_id", words(F.col("text")).alias("words"), "hashes")
    found = with_grams(found.withColumn("n_words", F.size("words")))
    found = found.withColumn("hit", F.when(F.col("hashes").isNotNull(), F.transform("grams", lambda h: F.array_contains("hashes", h))))
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - SPAN), lambda s: F.array_contains(F.slice("hit", s + 1, WINDOW), True))
    found = found.withColumn("starts", F.when(F.col("hit").isNotNull(), starts))

    def texts(at: Column, n: int) -> Column:
        return F.transform(at, lambda s: F.struct(s.alias("s"), F.lit(n).alias("length"), F.concat_ws(" ", F.slice("words", s + 1, n)).alias("window")))
    around = F.coalesce(texts(F.col("starts"), SPAN), F.array().cast("array<struct<s:int,length:int,window:string>>"))
    for n in sorted(short):  # a short item has no kept hash: its length is looked up at every word
        every = F.when(F.size("words") >= n, F.sequence(F.lit(0), F.size("words") - n))
        around = F.concat(around, F.coalesce(texts(every, n), F.array().cast("array<struct<s:int,length:int,window:string>>")))
    found = written(found.select("key", "version", "doc_id", "n_words", around.alias("around")))

    texts_only = small(windows.select("window", "length").distinct(), SMALL_WINDOWS)
    spans = (found.where(F.size("around") > 0).select("key", "version", F.explode_outer("around").alias("a")).select("key", "version", "a.*")
             .join(texts_only, ["window", "length"]))
    spans = written(spans.select("key", "version", "s", "length", "window").distinct())
    places = F.array_distinct(F.flatten(F.transform("spans", lambda x: F.sequence(x["s"], x["s"] + x["length"] - 1))))
    covered = (spans.groupBy("key", "version").agg(F.collect_set(F.struct("s", "length")).alias("spans"))
               .select("key", "version", F.size(places).cast("long").alias("n_hit")))
    named = (spans.select("key", "version", "window", "length").distinct()
             .join(windows.where("item_id is not null"), ["window", "length"])
             .groupBy("key", "version").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    none = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0))
    return (found.select("key", "version", "doc_id", F.col("n_words").cast("long").alias("n_words"))
            .join(covered, ["key", "version"], "left").join(named, ["key", "version"], "left")
            .select("doc_id", "version", "n_words", hit.cast("long").alias("n_hit"), F.size(none).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", none), 256).alias("items_sha256"),
                    ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns unchanged, that are not contaminated."""
    bad = written(decontaminate(docs, benchmark, id_col, text_col).where("contaminated")
                  .select(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).distinct())
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), text_version(text_col).alias("version"))
    return rows.join(small(bad, SMALL_HASHES), F.col("id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left_anti").select("row.*")
