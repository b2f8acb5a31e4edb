"""Line-first cleaning: judge each line, drop what fails, then judge what is left.

``base_counts`` gives the fixed counts of a text, ``line_verdicts`` the rules of single lines,
``clean`` both and the verdict. Only built-in column functions are used.

Defined cases: a null or blank text has no words and is rejected; a text of one endless line
is judged as one line; equal lines and rows are judged alike; columns of the input whose names
clash are overwritten only if they are among the output names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
# Phrases of web boilerplate, lower case.
BOILERPLATE = (
    "all rights reserved|cookie policy|privacy policy|terms of service|terms of use|click here|"
    "subscribe to our newsletter|sign up now|log in to|enable javascript|skip to content|"
    "back to top|share this|follow us on|read more"
)
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
MOST_LOST = 50  # per cent of the characters of lines
NAV_BARS = 3
MOST_SYMBOL_SHARE = 0.1


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    Three-word windows are compared by hash within one text: most texts have no repeated window,
    which a hash set shows; only others sort (hash, place) and join the covered words.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns(
        {
            "__words": words(F.col(text)),
            "n_symbols": _symbols(t).cast("long"),
            "__lines": F.filter(F.split(t, "\n"), has_word),
        }
    )
    w = F.col("__words")
    windows = F.transform(
        F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )
    df = df.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__win": windows,
        }
    ).drop("__words")
    win = F.col("__win")
    repeated = F.size(F.array_distinct(win)) < F.size(win)
    df = df.withColumn(
        "__sorted",
        F.when(repeated, F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    ).drop("__win")
    s = F.col("__sorted")
    same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
    twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
    df = df.withColumn("__at", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("__sorted")
    at = F.col("__at")
    covered = F.aggregate(
        at,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__at")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def line_fails(line: Column, tokens: Column) -> Column:
    """Whether one line fails a rule; ``tokens`` are its words. A blank line passes.

    * punctuation: as many doubled exclamation marks as half of the words, or mostly symbols;
    * navigation: three bars or arrows standing between words, one for five words or more;
    * boilerplate: a known phrase in a short line;
    * one word said again and again.
    """
    n = F.size(tokens)
    bars = F.size(F.filter(tokens, lambda x: x.isin("|", "»", "›", "•")))
    shout = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    punctuation = (_symbols(line) > MOST_SYMBOL_SHARE * F.length(line)) | ((shout > 0) & (2 * shout >= n))
    navigation = (bars >= NAV_BARS) & (bars * 5 >= n)
    boilerplate = (n > 0) & (n < 20) & F.lower(line).rlike(BOILERPLATE)
    alike = (n >= 10) & (F.size(F.array_distinct(tokens)) * 4 <= n)
    return punctuation | navigation | boilerplate | alike


def line_clean(df: DataFrame, text: str = "text") -> DataFrame:
    """Add clean_text, kept_chars, all_chars: the text without its failing lines.

    Blank lines stay, so paragraphs stay apart; a text whose lines all pass is unchanged.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    split = F.transform(F.split(t, "\n"), lambda x: F.struct(x.alias("line"), words(x).alias("tokens")))
    df = df.withColumn("__good", F.transform(F.filter(split, lambda x: ~line_fails(x["line"], x["tokens"])), lambda x: x["line"]))
    good = F.col("__good")
    joined = F.array_join(good, "\n")
    # Line breaks are not counted: kept lines are joined by one less than there are.
    kept = F.greatest(F.length(joined) - F.size(good) + 1, F.lit(0)).cast("long")
    everything = (F.length(t) - F.size(F.split(t, "\n")) + 1).cast("long")
    return df.withColumns({"clean_text": joined, "kept_chars": kept, "all_chars": everything}).drop("__good")


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """Counts, cleaned text and verdict ``kept`` of each row."""
    df = line_clean(base_counts(df, text), text)
    lost = F.col("all_chars") - F.col("kept_chars")
    fine = 100 * lost <= MOST_LOST * F.col("all_chars")
    return df.withColumn("kept", ~F.col("base_failed") & fine)


def kept_rows(df: DataFrame) -> DataFrame:
    """The rows of ``clean`` that are kept.

    The partition number stops the optimizer from copying the whole chain of counts into the
    filter, once for each use of each count.
    """
    return df.withColumn("__part", F.spark_partition_id()).filter(F.col("kept") & (F.col("__part") >= 0)).drop("__part")
