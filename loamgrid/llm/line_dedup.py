"""Line dedup in DataFrame operations: which lines of which documents go, as run-length coded keep bitmaps.

Each line of enough characters becomes a 128-bit hash of its key with its document and position; texts stay behind.
The hashes are range-partitioned and sorted by hash, document and position, and a pass in that order finds how many
documents have a key and which of them is the last. A frequent key is dealt over many ranges: a salt made of the
document follows the hash of those keys that a mergeable frequent-items sketch names, and the counts of such keys (at
most MOST_HOT_KEYS) are summed up across their salts. The sketch decides only where rows go, never what is counted.

The lines to drop return as runs (lines kept, lines dropped) for each document; joining these with the documents rebuilds
texts. Two 64-bit hashes with different seeds stand for a key, so two keys are taken for one with a chance of about
n * n / 2 ** 129 among n keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, LOWER, UPPER, cut, free_name, text_column

#: Keys that are dealt by document too, at least and at most, and into how many parts.
HOT_KEYS, MOST_HOT_KEYS, HOT_PARTS = 256, 100_000, 1024
#: Lines of a key that one task takes: the number of hot keys follows the lines, so that none has more unless it is hot.
TASK_LINES = 1_000_000
#: A key is hot from this share of all lines for each hot key on.
HOT_SHARE = 1 / 8


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER)


def line_hashes(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """doc_id, h (hash of the text: rows with one id and different texts stay apart), pos, k1 and k2 (of the key)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    lines = rows.select("doc_id", F.xxhash64("text").alias("h"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.where(F.length("line") >= min_chars).select("doc_id", "h", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keys.select("doc_id", "h", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, h, pos of the lines that go."""
    spark = docs.sparkSession
    hashes = cut(line_hashes(docs, min_chars), "lines")
    n = hashes.count()
    keys = int(min(MOST_HOT_KEYS, max(HOT_KEYS, n * HOT_SHARE / TASK_LINES)))
    top = hashes.agg(F.expr(f"approx_top_k(k1, {keys}, {min(1_000_000, 16 * keys)})").alias("top")).first()
    hot = [r["item"] for r in top["top"] or [] if r["count"] > max(1000, n * HOT_SHARE / keys)]
    is_hot = F.col("k1").isin(hot) if hot else F.lit(False)
    salted = hashes.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("doc_id"), F.lit(HOT_PARTS))).otherwise(F.lit(0)).cast("int"))
    # the windows' groups lie within one range of (k1, salt), so they need no further exchange
    ranged = salted.repartitionByRange(F.col("k1"), F.col("salt"))
    group = Window.partitionBy("k1", "salt", "k2")
    ordered = group.orderBy(F.col("doc_id").desc_nulls_last(), "h", "pos")
    first = F.when((F.row_number().over(ordered) == 1) | ~F.col("doc_id").eqNullSafe(F.lag("doc_id").over(ordered)), 1).otherwise(0)
    seen = ranged.withColumn("first", first)
    known = seen.withColumns({"n_docs": F.sum("first").over(group), "last": F.max("doc_id").over(group)})
    rest = known.where(~is_hot) if hot else known
    gone = rest.where((F.col("n_docs") >= min_docs) & ~F.col("doc_id").eqNullSafe(F.col("last"))).select("doc_id", "h", "pos")
    if not hot:
        return gone
    # of hot keys each salt's group has a part of the documents; their totals are few rows
    parts = known.where(is_hot)
    totals = parts.groupBy("k1", "k2").agg(F.sum("first").alias("total"), F.max("doc_id").alias("top"))
    hot_gone = parts.join(totals, ["k1", "k2"]).where((F.col("total") >= min_docs) & ~F.col("doc_id").eqNullSafe(F.col("top")))
    return gone.unionByName(hot_gone.select("doc_id", "h", "pos"))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """doc_id, h, n_dropped, runs: array of (keep, drop), so many lines kept and then so many dropped, from the top."""
    doc = Window.partitionBy("doc_id", "h").orderBy("pos")
    # equal rows of documents give a position more than once
    lines = dropped.groupBy("doc_id", "h", "pos").agg(F.lit(1).alias("one"))
    runs = lines.withColumn("run", F.col("pos") - F.row_number().over(doc)).groupBy("doc_id", "h", "run").agg(F.min("pos").alias("at"), F.count("*").cast("int").alias("drop"))
    gaps = runs.withColumn("keep", F.col("at") - F.coalesce(F.lag(F.col("at") + F.col("drop")).over(Window.partitionBy("doc_id", "h").orderBy("at")), F.lit(0)))
    each = gaps.groupBy("doc_id", "h").agg(F.sum("drop").alias("n_dropped"), F.sort_array(F.collect_list(F.struct("at", "keep", "drop"))).alias("runs"))
    return each.select("doc_id", "h", "n_dropped", F.transform("runs", lambda r: F.struct(r["keep"].alias("keep"), r["drop"].alias("drop"))).alias("runs"))


def kept_text(text: Column, runs: Column) -> Column:
    """The text of the kept lines. The mask is one argument of zip_with, so it is made once for each text."""
    mask = F.flatten(F.transform(runs, lambda r: F.concat(F.array_repeat(F.lit(True), r["keep"]), F.array_repeat(F.lit(False), r["drop"]))))
    kept = F.zip_with(F.split(text, "\n"), mask, lambda line, keep: F.when(F.coalesce(keep, F.lit(True)), line))
    return F.when(runs.isNull(), text).otherwise(F.array_join(kept, "\n"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, names: tuple[str, str, str] = ("_n_lines", "_n_dropped", "_keep_runs")) -> DataFrame:
    """docs with text replaced by its kept lines and three more columns, by default _n_lines, _n_dropped and _keep_runs
    (the bitmap).

    A key of at least min_chars code points in at least min_docs different doc_ids loses its lines except in the largest
    doc_id. A null or empty text is one empty line; a text that loses nothing is unchanged, null stays null. A null
    doc_id is one document below all others that counts like any. Rows with one doc_id are one document for the count and
    all keep or lose a key's lines; equal rows are treated alike. Texts may be of any length. An empty table gives an
    empty one. Columns named like the three are replaced; all others stay.
    """
    doc_id, h, n, runs = (free_name(docs, k) for k in ("__id", "__h", "__n", "__runs"))
    maps = keep_bitmaps(dropped_lines(docs, min_chars, min_docs)).toDF(doc_id, h, n, runs)
    same = docs["doc_id"].cast("long").eqNullSafe(maps[doc_id]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == maps[h])
    joined = docs.join(maps, same, "left")
    lines, dropped, bitmap = names
    return joined.withColumns({
        "text": kept_text(F.col("text"), F.col(runs)),
        lines: F.size(F.split(text_column(), "\n")).cast("long"),
        dropped: F.coalesce(F.col(n), F.lit(0)).cast("long"),
        bitmap: F.col(runs),
    }).drop(doc_id, h, n, runs)


def line_report(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of each row's kept text; null and empty texts have one empty line."""
    out = dedup_lines(docs, min_chars, min_docs)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(text_column().cast("binary"), 256).alias("kept_sha256"))
