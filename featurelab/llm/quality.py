"""Quality rules: lines are cleaned first, then documents that lost too much are rejected.

Only DataFrame functions. A document is judged by two sets of rules:

* base: fewer than 20 words, or more than 30 % of the words in eight-word windows that occur at
  least twice in the document;
* lines: each line with a word is held against three kinds of rules
    - punctuation: most of its words carry symbols of markup (`# * $ % & | < >`), or it shouts
      (most of its words end in `!!`),
    - navigation: it is a list of short entries divided by `|`,
    - boilerplate: it has a phrase of licence notices, cookie banners or page furniture;
  failing lines are removed, and a document that loses more than `MAX_LOSS` percent of its words
  is rejected.

Nulls and empty texts have no words, so they fail the base rules (n_words 0, kept false). Rows are
judged one by one: repeated rows and ties get equal answers, an empty table gives an empty result,
and only the id and the text are read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm.common import WORD, read, words_of

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED = 30  # percent of the words
MAX_LOSS = 50  # percent of the words
SYMBOL = r"[#*$%&|<>]"
NAVIGATION_BARS = 3
MARKED = r"[#*$%&|<>]{2,}([\x20\x09-\x0D]|\z)"
SHOUTED = r"!!([\x20\x09-\x0D]|\z)"
DIVIDED = r"\|([\x20\x09-\x0D]|\z)"

#: Phrases of lines that belong to a page or a licence, not to its text.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "cookie policy",
    "uses cookies",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "lorem ipsum",
    "click here to",
    "subscribe to our newsletter",
)


def has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(WORD))


def count_words(text: Column) -> Column:
    """Words of a line or text, without building an array."""
    return F.regexp_count(text, F.lit(WORD))


def repeated_words(words: Column) -> Column:
    """Number of words in windows of WINDOW words that occur twice or more, the first included.

    Windows are compared by a 64-bit hash. Only texts that repeat a window are sorted.
    """
    starts = F.when(
        F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)
    ).otherwise(F.array().cast("array<int>"))
    # `slice` would copy the whole array for each window
    hashes = once(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])),
    )

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda v, i: F.struct(v.alias("v"), i.alias("p"))))

        def positions(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda x, i: (F.get(s, i - 1)["v"] == x["v"]) | (F.get(s, i + 1)["v"] == x["v"]),
            )
            return F.sort_array(F.transform(twice, lambda x: x["p"]))

        def union(at: Column) -> Column:
            return F.aggregate(
                at,
                F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                lambda a, p: F.struct(
                    (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")
                ),
                lambda a: a["n"],
            )

        return once(once(placed, positions), union)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    return once(hashes, count)


def once(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def line_fails(line: Column) -> Column:
    """Whether a line breaks a punctuation, navigation or boilerplate rule."""
    counts = F.struct(
        count_words(line).alias("words"),
        F.regexp_count(line, F.lit(MARKED)).alias("marked"),
        F.regexp_count(line, F.lit(SHOUTED)).alias("shouted"),
        F.regexp_count(line, F.lit(DIVIDED)).alias("bars"),
    )

    def by_counts(c: Column) -> Column:
        punctuation = (2 * c["marked"] > c["words"]) | (2 * c["shouted"] > c["words"])
        entries = (c["bars"] >= NAVIGATION_BARS) & (4 * c["bars"] > c["words"])
        ending = (c["bars"] >= 1) & (3 * c["bars"] >= c["words"])
        return punctuation | entries | ending

    def by_phrases(lower: Column) -> Column:
        found = F.contains(lower, F.lit(BOILERPLATE[0]))
        for phrase in BOILERPLATE[1:]:
            found = found | F.contains(lower, F.lit(phrase))
        return found

    marked = F.rlike(line, F.lit(SYMBOL + "|!!"))  # most lines need no counting
    return (marked & once(counts, by_counts)) | once(F.lower(line), by_phrases)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Every row as a struct `row`, with its cleaned text, counts and verdict."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.struct(*df.columns).alias("row"), body.alias("body"))
    # computed inside `once`, so that the optimizer cannot copy the split into a lambda
    from_words = once(
        words_of(F.col("body")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
        ),
    )
    from_lines = once(
        F.split("body", "\n"),
        lambda every: F.struct(
            F.size(every).alias("n"),
            once(
                F.filter(every, has_word),
                lambda x: F.size(x) - F.size(F.array_distinct(x)),
            )
            .cast("long")
            .alias("n_dup_lines"),
            F.filter(every, lambda x: ~has_word(x) | ~line_fails(x)).alias("good"),
        ),
    )
    rows = rows.select(
        "row",
        from_words.alias("w"),
        from_lines.alias("l"),
        F.regexp_count("body", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
    )
    rows = rows.select(
        "row",
        "w.*",
        "n_symbols",
        F.col("l.n_dup_lines").alias("n_dup_lines"),
        (F.col("l.n") - F.size("l.good")).cast("long").alias("n_lines_removed"),
        F.array_join("l.good", "\n").alias("clean"),
    )
    rows = rows.withColumns(
        {
            "n_words_left": F.when(F.col("n_lines_removed") == 0, F.col("n_words")).otherwise(
                count_words(F.col("clean")).cast("long")
            ),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
        }
    )
    lost = F.col("n_words") - F.col("n_words_left")
    kept = ~F.col("base_failed") & (100 * lost <= MAX_LOSS * F.col("n_words"))
    return rows.select(
        "row",
        F.col("clean").alias("clean_text"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines_removed",
        "n_words_left",
        "base_failed",
        kept.alias("kept"),
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = measured(read(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("row.doc_id", *[c for c in rows.columns if c not in ("row", "clean_text")])
