"""Quality rules: counts within a text, and its distance from its language. DataFrame functions only.

Base counts are exact: words, their characters, symbols, repeated lines, and words in
five-word windows that a text holds twice or more (windows are compared by a 64-bit hash
within one text).

The verdict compares two histograms of a text with those of its language: characters by
class, and the language's common words among all words. References are sums over all
texts of the language that pass the base rules. The distance is the square root of the
Jensen-Shannon divergence (base 2, so 0 to 1). A text fails if a distance exceeds its
limit; a histogram counts only from a least length on, as few words scatter by chance.

A text without a language is compared with the language that has most of its words in its
list. A language without a list of common words has its own reference of characters, and no
test of words. Languages without reference fail nothing.
NULL and empty texts have no words and fail the base rules. Every text is handled within
its row, whatever its length; repeated rows and extra columns change nothing. What is
joined is one row for each language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tables import stored

#: Common words of each language.
COMMON = {
    "de": ["der", "die", "und", "in", "zu", "den", "das", "ist", "von", "mit", "des", "auf", "für", "nicht", "ein"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "una", "para"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "que", "du", "pour", "dans", "qui", "sur"],
}
SPACE = r"[\x20\x09-\x0D]"
#: Character classes counted by what is left of a text without all else.
CLASSES = {"lower": "[^a-z]+", "upper": "[^A-Z]+", "digit": "[^0-9]+", "mark": r"[^!-/:-@\[-`{-~]+"}
REPEAT, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Least length and largest distance for characters and for common words.
CHARS_FROM, CHARS_LIMIT = 200, 0.30
WORDS_FROM, WORDS_LIMIT = 100, 0.30


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, width: int = REPEAT) -> Column:
    """Words inside windows of ``width`` that occur twice or more."""

    def covered(pairs: Column) -> Column:
        twin = lambda x, k: F.coalesce(x["h"] == F.get(pairs, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(pairs, k + 1)["h"], F.lit(False))
        starts = F.sort_array(F.transform(F.filter(pairs, twin), lambda x: x["i"]))
        none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
        return F.aggregate(starts, none, lambda acc, i: F.struct(
            (acc["n"] + i + width - F.greatest(i, acc["to"])).alias("n"), (i + width).alias("to")))["n"]

    def of(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(pairs, covered)).otherwise(0)

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.xxhash64(F.slice(words, i, F.lit(width))))
    return F.when(F.size(words) >= width, let(hashes, of)).otherwise(0)


def common_list(language: Column) -> Column:
    chosen = F.array().cast("array<string>")
    for name, listed in COMMON.items():
        chosen = F.when(language == name, F.array(*map(F.lit, listed))).otherwise(chosen)
    return chosen


def closest_language(words: Column) -> Column:
    """The language with most of the words in its list; of equals the one that sorts last."""
    def hits(name: str) -> Column:
        return F.struct(F.size(F.filter(words, lambda w: F.lower(w).isin(COMMON[name]))).alias("n"), F.lit(name).alias("name"))

    return F.array_max(F.array(*map(hits, COMMON)))["name"]


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, counts, language, histograms) of each whole text."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", F.col("lang").alias("lang"), body.alias("text"),
                       F.array_remove(F.split(body, SPACE + "+"), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    speech = F.coalesce("lang", closest_language(F.col("words")))

    def counts(listed: Column) -> Column:
        some = F.filter(F.transform("words", F.lower), lambda w: F.array_contains(listed, w))
        return let(some, lambda some: F.transform(listed, lambda c: F.size(F.filter(some, lambda w: w == c))))

    rows = rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda some: F.size(some) - F.size(F.array_distinct(some))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        speech.alias("language"), F.length("text").cast("long").alias("chars"),
        *[F.length(F.regexp_replace("text", pattern, "")).cast("long").alias(name) for name, pattern in CLASSES.items()],
        let(common_list(speech), counts).alias("common"))
    space = F.col("chars") - F.col("word_chars")
    known = [F.col(name) for name in CLASSES]
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "language", "chars",
        F.array(*known, space, F.col("chars") - space - sum(known, F.lit(0))).alias("char_bins"),
        F.concat("common", F.array(F.col("n_words") - F.aggregate("common", F.lit(0), lambda a, x: a + x))).alias("word_bins"),
        failed.alias("base_failed"))


def shares(bins: Column) -> Column:
    return let(F.aggregate(bins, F.lit(0).cast("long"), lambda a, x: a + x), lambda total: F.transform(
        bins, lambda x: x.cast("double") / F.greatest(total, F.lit(1))))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two lists of shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) / 2 + part(y, (x + y) / 2) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def references(rows: DataFrame) -> DataFrame:
    """(language, char_ref, word_ref): shares over all texts of a language that pass the base rules."""
    width = {"char_bins": len(CLASSES) + 2, "word_bins": max(map(len, COMMON.values())) + 1}
    summed = rows.where("NOT base_failed").groupBy("language").agg(
        *[F.sum(F.get(name, F.lit(k))).alias(f"{name}_{k}") for name, n in width.items() for k in range(n)])
    gather = lambda name: F.array_compact(F.array(*[F.col(f"{name}_{k}") for k in range(width[name])]))
    return summed.select("language", shares(gather("char_bins")).alias("char_ref"), shares(gather("word_bins")).alias("word_ref"))


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """The counts of ``features`` with char_distance, word_distance and kept for each row of ``docs`` (doc_id, text, lang)."""
    rows = stored(features(docs, text), "features")
    known = stored(references(rows), "references")
    rows = rows.join(known, "language", "left").select(
        *[c for c in rows.columns if c not in ("char_bins", "word_bins")],
        F.when(F.col("chars") >= CHARS_FROM, distance(shares(F.col("char_bins")), F.col("char_ref"))).alias("char_distance"),
        F.when(F.col("n_words") >= WORDS_FROM, distance(shares(F.col("word_bins")), F.col("word_ref"))).alias("word_distance"))
    far = (F.coalesce("char_distance", F.lit(0.0)) > CHARS_LIMIT) | (F.coalesce("word_distance", F.lit(0.0)) > WORDS_LIMIT)
    return rows.withColumn("kept", ~F.col("base_failed") & ~far)
