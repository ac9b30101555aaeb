"""Quality rules in DataFrame operations, with thresholds that follow the data.

One scan makes the measures of each text. Mergeable KLL sketches of the measures are kept for each language and source,
merged into those of languages, and these into one of all rows. A group's quartiles are drawn to its language's, and those
to all rows', as if PRIOR_ROWS rows lay there, by one formula at all sizes. A threshold is a fence beyond the quartiles, so
a group without outliers loses nothing. The measures join the groups' fences and are filtered.

Repeated words: each word is hashed once, eight neighbours are folded into a window's hash by three pairwise steps, and
only texts that have an equal pair of windows sort them. Hashes have 64 bits; equal hashes of different windows of one
text come about with a chance of n * n / 2 ** 65 for n words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, WORD_PATTERN, cut, text_column

#: Sizes of sketches (rank error about 0.4 %), and the rows that the wider group's quartiles count as.
SKETCH_K, PRIOR_ROWS = 800, 100
#: A fence is this many spreads beyond a quartile; the spread is that between the quartiles, but at least the second value.
FENCE = 3.0
MEASURES = {"word_length": 0.75, "symbol_share": 0.02, "dup_line_share": 0.1, "repeat_share": 0.1}
#: Measures of which too small is as bad as too large.
TWO_SIDED = ("word_length",)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for each row however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _tail(a: Column, n: Column, by: int) -> Column:
    """a without its first `by` elements; n: those that stay."""
    return F.slice(a, F.lit(by + 1), n)


def _window_hashes(words: Column) -> Column:
    """A hash for each eight words in a row (there are at least eight)."""

    def fold(a: Column, by: int) -> Column:
        return let(a, lambda x: let(F.size(x) - by, lambda n: F.zip_with(F.slice(x, F.lit(1), n), _tail(x, n, by), lambda p, q: F.xxhash64(p, q))))

    return fold(fold(fold(F.transform(words, lambda w: F.xxhash64(w)), 1), 2), 4)


def _covered(hashes: Column) -> Column:
    """Words that lie in windows found twice or more."""

    def of_sorted(s: Column) -> Column:
        n = F.size(s) - 1
        equal = F.zip_with(F.slice(s, F.lit(1), n), _tail(s, n, 1), lambda a, b: a["h"] == b["h"])
        no = F.array(F.lit(False))
        flags = let(equal, lambda e: F.zip_with(F.concat(no, e), F.concat(e, no), lambda a, b: a | b))
        at = F.sort_array(F.array_compact(F.zip_with(s, flags, lambda x, d: F.when(d, x["i"]))))
        return let(at, lambda p: F.aggregate(F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), _tail(p, F.size(p) - 1, 1), lambda a, b: F.least(b - a, F.lit(8))), F.lit(8), lambda x, y: x + y))

    return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of_sorted)


def repeat_words(words: Column) -> Column:
    found = let(_window_hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0)))
    return F.when(F.size(words) > 8, found).otherwise(F.lit(0)).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the whole numbers that the rules use, of whole texts; null texts have no word."""
    text = F.col("text")
    words = F.filter(F.split(text, WORD_PATTERN), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeat_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long")
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text_column().alias("text"))
    made = rows.select("doc_id", "lang", "source", of_words.alias("w"), of_lines.alias("l"), symbols.alias("n_symbols"))
    return made.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")


def with_shares(rows: DataFrame) -> DataFrame:
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b))

    return rows.withColumns({"word_length": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words")})


def fences(rows: DataFrame) -> DataFrame:
    """For each (lang, source), nulls being values: lo and hi of each measure, from the quartiles of its sketches, drawn to
    those of its language, which are drawn to those of all rows. A measure that a group has no value of weighs nothing."""
    sketched = rows.groupBy("lang", "source").agg(*(F.expr(f"kll_sketch_agg_double({m}, {SKETCH_K})").alias(m) for m in MEASURES))
    sketched = cut(sketched, "sketches")

    def quartiles(df: DataFrame, keys: list[str], suffix: str) -> DataFrame:
        out = []
        for m in MEASURES:
            n = f"coalesce(kll_sketch_get_n_double({m}), 0)"
            out.append(F.expr(f"named_struct('n', {n}, 'q1', CASE WHEN {n} > 0 THEN kll_sketch_get_quantile_double({m}, 0.25D) END, 'q3', CASE WHEN {n} > 0 THEN kll_sketch_get_quantile_double({m}, 0.75D) END)").alias(f"{m}_{suffix}"))
        return df.select(*keys, *out)

    def merged(keys: list[str]) -> DataFrame:
        return sketched.groupBy(*keys).agg(*(F.expr(f"kll_merge_agg_double({m})").alias(m) for m in MEASURES))

    by_lang = quartiles(merged(["lang"]), ["lang"], "lang").withColumnRenamed("lang", "lang_")
    # one row for each language, and one row of all: the first join's size is that of the groups
    wide = quartiles(sketched, ["lang", "source"], "own").join(by_lang, F.col("lang").eqNullSafe(F.col("lang_")), "left").join(F.broadcast(quartiles(merged([]), [], "all")), F.lit(True), "left")
    out = []
    for m, least in MEASURES.items():
        q1, q3 = (drawn(F.col(f"{m}_own.n"), F.col(f"{m}_own.{q}"), drawn(F.col(f"{m}_lang.n"), F.col(f"{m}_lang.{q}"), F.col(f"{m}_all.{q}"))) for q in ("q1", "q3"))
        spread = FENCE * F.greatest(q3 - q1, F.lit(least))
        out += [(q3 + spread).alias(f"{m}_hi"), *([(q1 - spread).alias(f"{m}_lo")] if m in TWO_SIDED else [])]
    return wide.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), *out)


def drawn(n: Column, own: Column, wider: Column) -> Column:
    """own, of n rows, drawn to wider as if PRIOR_ROWS rows had that value."""
    return (n * F.coalesce(own, F.lit(0.0)) + PRIOR_ROWS * wider) / (n + PRIOR_ROWS)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept: a row for each row of docs.

    docs(doc_id, text, lang, source, ...). base_failed: fewer than 20 words, or over 30 % of them in repeated windows of
    eight words. kept: neither that nor any measure beyond its group's fence. A null or empty text has no word and fails.
    Null languages and sources are groups like others. Equal rows have equal results; ties at a fence are kept. Texts may
    be of any length. An empty table gives an empty one; other columns aren't read.
    """
    rows = with_shares(cut(measures(docs), "measures"))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    joined = rows.join(fences(rows), F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    inside = F.lit(True)
    for m in MEASURES:
        inside &= F.coalesce(F.col(m) <= F.col(f"{m}_hi"), F.lit(True))
        if m in TWO_SIDED:
            inside &= F.coalesce(F.col(m) >= F.col(f"{m}_lo"), F.lit(True))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & inside).alias("kept"))
