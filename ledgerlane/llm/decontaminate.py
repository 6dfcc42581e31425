"""Words of documents that lie inside a benchmark window, by a prefix-filtered set join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import LOWER, UPPER, in_few_files, stored

WINDOW = 10

# A word list of the benchmark goes to the tasks as a literal set up to this size; a longer one is joined.
SET_WORDS = 50_000

# ASCII characters that no word holds; a word is a run of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lowering A-Z.
_BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case; a null text has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), UPPER + _BETWEEN, LOWER + " " * len(_BETWEEN))
    trimmed = F.trim(spaced)
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " +"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, window): every run of `window` words of an item, or all its words if fewer."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter(
        F.size("words") > 0
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return items.select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("window")
    ).distinct()


def _known_words(words: DataFrame, limit: int) -> list[str] | None:
    """The distinct words if there are at most `limit`, else None."""
    found = [r[0] for r in words.limit(limit + 1).collect()]
    return found if len(found) <= limit else None


def corpus_counts(docs: DataFrame, vocabulary: DataFrame, limit: int = SET_WORDS) -> DataFrame:
    """How often each word of the vocabulary stands in all documents: word, n."""
    known = _known_words(vocabulary, limit)
    spread = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    if known is not None:
        spread = spread.filter(F.col("word").isin(known))
    # Counted inside each task before they meet, so a frequent word is no hot key.
    counts = spread.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def rarest_words(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each distinct window with its prefix: the rarest word (ties: the lesser) and its place.

    A window occurs only where all its words do, so a prefix of one word in order of rarity
    is enough to find every occurrence.
    """
    spread = windows.select("window").distinct().select(
        "window", F.posexplode("window").alias("place", "word")
    )
    return (
        spread.join(counts, "word")
        .groupBy("window")
        .agg(F.min(F.struct("n", "word", "place")).alias("least"))
        .select("window", F.size("window").alias("length"),
                F.col("least.word").alias("prefix"), F.col("least.place").alias("place"))
    )


def _with_places(docs: DataFrame, prefixes: DataFrame, limit: int) -> DataFrame:
    """doc_id, words, and the places (from 0) of prefix words."""
    known = _known_words(prefixes, limit)
    texts = docs.select("doc_id", "text", words_of(F.col("text")).alias("words"))
    if known == []:
        return texts.select("doc_id", "words", F.array().cast("array<int>").alias("places"))
    if known is not None:
        every = F.sequence(F.lit(0), F.size("words") - 1)
        places = F.when(F.size("words") > 0, F.filter(every, lambda i: F.get("words", i).isin(known)))
        return texts.select("doc_id", "words", places.alias("places"))
    # Too many for a set: find the places by a join, then return to the texts by a hash of the text.
    keyed = texts.withColumns(
        {"k1": F.xxhash64("text"), "k2": F.hash("text"), "k3": F.octet_length("text")}
    )
    places = (
        keyed.select("k1", "k2", "k3", F.posexplode("words").alias("at", "word"))
        .join(prefixes, "word")
        .groupBy("k1", "k2", "k3").agg(F.collect_set("at").alias("places"))
    )
    return keyed.join(places, ["k1", "k2", "k3"], "left").select("doc_id", "words", "places")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = SET_WORDS
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word inside any occurrence of a benchmark window is hit. Windows
    (item_id, window) are ordered by the corpus count of their words; a document meets a window
    only where it holds the window's rarest word. The words around such a place must be long
    enough for the window (length bound), lie at the right distance (positional bound), and equal
    the window. Only the words around such places are shuffled, never whole texts, unless the
    benchmark has more than `limit` prefix words.

    Each row is judged on its own text, so repeated rows and ids get a row each. The words of a text are
    one value of a row: a text of many megabytes is one task's memory (many times its size). Null or empty
    texts have no words and no hits. An item without words has no windows; a null item_id
    hits words but is not counted in n_items. Other columns are ignored.
    """
    windows = stored(in_few_files(benchmark_windows(benchmark, window)), "windows")
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    prefixed = stored(in_few_files(rarest_words(windows, corpus_counts(docs, vocabulary, limit))), "prefixes")
    prefixes = prefixed.select(F.col("prefix").alias("word")).distinct()

    def around(i: Column) -> Column:
        first = F.greatest(i - (window - 1), F.lit(0))
        return F.struct(
            i.alias("at"), (i - first).alias("before"), F.get("words", i).alias("prefix"),
            F.slice("words", first + 1, i - first + window).alias("context"),
        )

    rows = stored(
        _with_places(docs, prefixes, limit).select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.transform("places", around).alias("places"),
        ),
        "places",
    )
    hits = stored(
        in_few_files(
            rows.select("row", F.explode("places").alias("x")).select("row", "x.*")
            .join(prefixed, "prefix")
            .withColumn("start", F.col("before") - F.col("place"))
            .filter((F.col("start") >= 0) & (F.size("context") >= F.col("start") + F.col("length")))
            .filter(F.expr("slice(context, start + 1, length) = window"))
            .select("row", (F.col("at") - F.col("place")).alias("first"), "length", "window")
            .distinct()
        ),
        "hits",
    )

    covered = (
        hits.select("row", F.explode(F.expr("sequence(first, first + length - 1)")).alias("at"))
        .distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    items = (
        hits.select("row", "window").distinct()
        .join(windows.filter(F.col("item_id").isNotNull()), "window")
        .select("row", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (
        rows.select("row", "doc_id", "n_words")
        .join(covered.join(items, "row", "left"), "row", "left")
        .select(
            "doc_id", "n_words",
            n_hit.cast("long").alias("n_hit"),
            F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", F.coalesce("items", none)).cast("binary"), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )
