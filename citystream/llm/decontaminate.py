"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ``window`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window as a whole. A document word inside any
occurrence of a window is hit.

Winnowing keeps, of every run of w consecutive k-gram hashes, the smallest (the
last of equal ones). With k + w - 1 = ``window``, documents and items that
share a window share a kept hash at the same place of it, so joining the kept
hashes finds every shared window. A hit is then extended: the windows around it
are compared word for word with the items' windows, which drops chance matches.
Shorter items take part with their whole length as k and w = 1.

The corpus is read once: each document gives one row for itself and one for
every kept hash that the benchmark also keeps. Words are hashed in stretches
that overlap by a window less a word, so that no row holds more than a stretch,
however long the text. The benchmark's hashes and
windows are broadcast if counted small, else joined by shuffle; in that case a
row carries only the few words around its hash. Texts are told apart by their
SHA-256, so copies of one text are resolved once.

Defined results: a null or word-less text has no words and isn't hit; a null or
word-less item has no window. Items without an id hit, but aren't counted or
listed; an item repeated or present with several texts counts once. Repeated
documents and documents without an id come back as often as they come in. An
empty benchmark hits nothing. Other columns are not carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.llm.common import BROADCAST_ROWS, ascii_lower, bounded, cut, shuffled, small
from citystream.session import prepare

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Words of a stretch.
STRETCH = 512

# A kept hash is a long: 33 bits of hash, then 31 bits that fall with the
# position, so that the smallest of equal hashes is the last one.
_POSITION = (1 << 31) - 1


def words_of(text: Column) -> Column:
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def kept_hashes(hashes: str, n: str, k: int, w: int) -> str:
    """SQL for the winnowed k-gram hashes of the word hashes in column ``hashes``."""
    gram = ", ".join(f"{hashes}[i + {j}]" for j in range(k))
    grams = (f"transform(sequence(0, {n} - {k}), i -> "
             f"shiftleft(shiftrightunsigned(xxhash64({gram}), 31), 31) - 1 - i + {_POSITION + 1})")
    if w == 1:
        picked = grams
    else:
        # By position: slice() copies the whole array for every window.
        least = ", ".join(f"g[s + {j}]" for j in range(w))
        picked = f"array_distinct(transform(sequence(0, {n} - {k + w - 1}), s -> least({least})))"
        picked = f"transform(array({grams}), g -> {picked})[0]"
    return f"if({n} >= {k + w - 1}, {picked}, array())"


def shape(window: int) -> tuple[int, int]:
    """(k, w) with k + w - 1 = window."""
    k = (window + 1) // 2
    return k, window - k + 1


def tokenized(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (df.select(df[id_col].alias("id"), df[text_col].alias("text"))
            .select("id", F.sha2("text", 256).alias("key"), words_of(F.col("text")).alias("words"))
            .withColumn("n", F.size("words")))


def item_windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(id, len, win): the distinct windows of every item, joined by spaces."""
    items = tokenized(benchmark, id_col, text_col).where("n > 0").withColumn("len", F.least("n", F.lit(window)))
    return (items.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("len"))))
            .select("id", "len", F.expr("concat_ws(' ', transform(sequence(s, s + len - 1), i -> words[i]))").alias("win")).distinct())


def stretches(df: DataFrame, window: int) -> DataFrame:
    """``df`` (words, n) with a row for every ``STRETCH`` words: ``base`` is the
    first one's place, ``words`` are they and the ``window`` - 1 after them, so
    every window lies within a stretch. A text without words has one."""
    cuts = F.expr(f"transform(sequence(0, greatest(n - 1, 0) div {STRETCH}), i -> slice(words, cast(i AS int) * {STRETCH} + 1, {STRETCH + window - 1}))")
    return (df.withColumn("cuts", cuts).drop("words")
            # Never empty, but the outer form keeps the optimizer from inferring a
            # filter on it, which would cut the texts twice.
            .select("*", F.posexplode_outer("cuts").alias("base", "words")).drop("cuts")
            .withColumn("base", F.col("base") * STRETCH))


def _hashed(df: DataFrame, window: int, short: list[int]) -> DataFrame:
    """For every stretch: a row for the text (len null) if it is the first, and one for each kept hash."""
    parts = [(window, kept_hashes("h", "size(words)", *shape(window)))] + [(m, kept_hashes("h", "size(words)", m, 1)) for m in short]
    tagged = [f"transform({sql}, p -> struct({m} AS len, p))" for m, sql in parts]
    itself = "if(base = 0, array(struct(cast(null AS int) AS len, cast(null AS bigint) AS p)), array())"
    return (df.withColumn("h", F.transform("words", lambda x: F.xxhash64(x)))
            .withColumn("found", F.expr(f"concat({itself}, {', '.join(tagged)})"))
            # The outer form again; a later stretch without hashes gives a row that is dropped here.
            .drop("h").select("*", F.inline_outer("found")).drop("found").where("p IS NOT NULL OR base = 0")
            .withColumn("hash", F.expr("shiftrightunsigned(p, 31)"))
            .withColumn("pos", F.expr(f"cast({_POSITION} - (p & {_POSITION}) AS int)")).drop("p"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, n_items, items, contaminated) for every document;
    ``items`` lists the ids of the items with occurring windows, as strings."""
    prepare(docs.sparkSession)
    windows = cut(item_windows(benchmark, window, item_id_col, item_text_col))
    lengths = [r[0] for r in windows.select("len").distinct().collect()]  # at most ``window`` values
    short = sorted(m for m in lengths if m < window)
    # A window is a text of its own here: what it keeps is what any text that
    # holds it keeps within it.
    wanted = (_hashed(windows.select(F.split("win", " ").alias("words"), F.col("len").alias("n"), F.lit(0).alias("base")), window, short)
              .where("len = n").select("len", "hash", F.lit(True).alias("wanted")).distinct())
    wins = windows.groupBy("win").agg(F.first("len").alias("len"))
    few = small(windows, BROADCAST_ROWS)  # a kept hash per window at most, w of them if short

    def context(df: DataFrame) -> DataFrame:
        """The words that windows around the hash may cover, from word ``lo`` on."""
        k, _ = shape(window)
        back = F.when(F.col("len") == window, F.lit(window - k)).otherwise(F.lit(0))
        return (df.withColumn("lo", F.greatest(F.col("pos") - back, F.lit(0)))
                .withColumn("hi", F.least("pos", F.size("words") - F.col("len")))
                .withColumn("near", F.expr("transform(sequence(lo, hi + len - 1), i -> words[i])")).drop("words")
                .withColumn("lo", F.col("lo") + F.col("base")).withColumn("hi", F.col("hi") + F.col("base")))

    hashed = _hashed(stretches(tokenized(docs, id_col, text_col), window), window, short)
    if few:
        rows = context(hashed.join(F.broadcast(wanted), ["len", "hash"], "left").where("wanted OR len IS NULL"))
    else:
        rows = context(hashed).join(shuffled(wanted), ["len", "hash"], "left").where("wanted OR len IS NULL")
    rows = cut(rows.select("id", "key", "n", "len", "lo", "hi", "near"))

    occurring = (rows.where("len IS NOT NULL")
                 .select("key", "len", F.expr("inline(transform(sequence(lo, hi), "
                                              "s -> struct(s, concat_ws(' ', slice(near, s - lo + 1, len)) AS win)))"))
                 .distinct().join(F.broadcast(wins) if few else shuffled(wins), ["win", "len"]))
    hit = (occurring.select("key", F.explode(F.expr("sequence(s, s + len - 1)")).alias("word")).distinct()
           .groupBy("key").agg(F.count("*").alias("n_hit")))
    listed = (occurring.select("key", "win").distinct()
              .join(F.broadcast(windows) if few else shuffled(windows), "win").where("id IS NOT NULL")
              .select("key", F.col("id").cast("string").alias("item")).distinct()
              .groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items")))
    # One narrow row per hit text, broadcast if counted few: then no document is
    # shuffled. (The list of items is as long as the benchmark at most.)
    resolved = cut(hit.join(listed, "key", "left"))
    out = rows.where("len IS NULL").join(bounded(resolved), "key", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
