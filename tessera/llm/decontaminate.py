"""Benchmark decontamination by a broadcast set of test n-grams.

Benchmark items are cut into windows of ``n`` consecutive words (an item of
fewer words is one window). Each window's hash goes into one broadcast table;
documents are scanned as word windows of the same widths, every position is
looked up by hash, and a hit is verified on the words themselves. Hits mark
words, from which documents or just the marked words can be removed.

Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters.
Everything is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import as_row, lower_ascii

WINDOW = 10
#: What separates words, in lower-cased text and in any text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The window table is broadcast up to so many bytes of words and ids; beyond, it is joined by shuffle.
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """The words of a text; a null text has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), "")


def windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(h, w, gram, items) of the distinct windows of ``benchmark`` (item_id, text).

    ``items`` are the distinct ids of the items that hold the window; a null id
    is not listed, but its windows count.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text").cast("string")).alias("ws"))
    items = items.filter("size(ws) > 0").withColumn("w", F.least(F.lit(n), F.size("ws")))
    grams = items.select("item_id", "w", "ws", F.explode_outer(F.expr("sequence(1, size(ws) - w + 1)")).alias("at")).select(
        "item_id", "w", F.expr("slice(ws, at, w)").alias("gram"))
    return grams.groupBy("w", "gram").agg(F.collect_set("item_id").alias("items")).select(
        F.xxhash64("gram").alias("h"), "w", F.array_join("gram", " ").alias("gram"), "items")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text and the words: rows equal in the first two are equal."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), words(text).alias("ws"))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, th, spans, item_ids) of the documents (doc_id, text) that hold a window.

    ``spans`` are the sorted (at, w) of the windows found, at counted in words
    from 1; ``item_ids`` are distinct, sorted as strings.
    """
    table = windows(benchmark, n)
    size = table.agg(F.sum(F.length("gram") + 8 * F.size("items") + 24), F.sort_array(F.collect_set("w"))).first()
    widths = size[1] or []  # at most n numbers
    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id long, th long, spans array<struct<at:int,w:int>>, item_ids array<string>")
    # One array of hashes for all widths: those of the first width, then of the next one.
    each = [f"if(size(ws) < {w}, array(), transform(sequence(1, size(ws) - {w - 1}), i -> xxhash64(slice(ws, i, {w}))))" for w in widths]
    scanned = _keyed(docs).select("doc_id", "th", "ws", F.expr(f"concat({', '.join(each)})").alias("hs"))
    small = size[0] <= BROADCAST_BYTES
    scanned = scanned.withColumn("n", F.size("ws"))
    # The outer form, as the plain one would also be planned as a filter that finds the words anew for every position.
    found = scanned.select("doc_id", "th", "n", *(["ws"] if small else []), F.posexplode_outer("hs").alias("place", "h"))
    wide, at, before = "", "", "0"
    for w in widths:
        count = f"greatest(0, n - {w - 1})"
        wide += f" when place < {before} + {count} then {w}"
        at += f" when place < {before} + {count} then place - ({before}) + 1"
        before += f" + {count}"
    found = found.withColumn("wide", F.expr(f"case{wide} end")).withColumn("at", F.expr(f"case{at} end"))
    table = table.withColumnRenamed("h", "window_h")
    ids = F.array_sort(F.array_distinct(F.transform(F.flatten(F.collect_set("items")), lambda x: x.cast("string"))))
    if small:
        # Only the hash is a join key; the words are compared where it matches.
        same = F.expr("""h = window_h and wide <= w and wide >= w and startswith(array_join(slice(ws, at, wide), ' '), gram)
                         and startswith(gram, array_join(slice(ws, at, wide), ' '))""")
        return found.join(F.broadcast(table), same).groupBy("doc_id", "th").agg(
            F.sort_array(F.collect_set(F.struct("at", "w"))).alias("spans"), ids.alias("item_ids"))
    # Hash hits first, then the words of the documents that have any.
    hit = found.join(table, F.expr("h = window_h and wide <= w and wide >= w")).groupBy("doc_id", "th").agg(
        F.collect_set(F.struct("at", "w", "gram", "items")).alias("c")).select(
        F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th"), "c")
    checked = scanned.select("doc_id", "th", "ws").join(hit, F.expr("th = hit_th and doc_id <=> hit_id")).dropDuplicates(
        ["doc_id", "th"]).select("doc_id", "th", F.explode_outer(F.expr(
            "filter(c, x -> array_join(slice(ws, x.at, x.w), ' ') = x.gram)")).alias("x")).filter("x is not null")
    return checked.select("doc_id", "th", "x.at", "x.w", "x.items").groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_set(F.struct("at", "w"))).alias("spans"), ids.alias("item_ids"))


def _covered(spans: str) -> Column:
    """Words in the union of sorted (at, w) spans."""
    return F.expr(f"""aggregate({spans}, struct(0L as n, 0 as upto), (a, s) -> struct(
        a.n + greatest(0, s.at + s.w - 1 - greatest(a.upto, s.at - 1)) as n, greatest(a.upto, s.at + s.w - 1) as upto)).n""")


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs`` (doc_id, text).

    Repeated rows get the same figures; null and empty texts have no words and
    no hits, null ids are matched like others. An empty benchmark contaminates
    nothing, an empty table gives no rows. Other columns are ignored.
    """
    all_ = _keyed(docs).select("doc_id", "th", F.size("ws").cast("long").alias("n_words"))
    h = hits(docs, benchmark, n).select(F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th"), _covered("spans").alias("n"), "item_ids")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return all_.join(h, F.expr("th = hit_th and doc_id <=> hit_id"), "left").select(
        "doc_id", "n_words", F.coalesce("n", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), F.coalesce(F.col("n") > 0, F.lit(False)).alias("contaminated"))


def _beside_hits(docs: DataFrame, benchmark: DataFrame, n: int, how: str) -> DataFrame:
    """``docs`` as ``row`` joined with the spans found in each."""
    d = docs.select(as_row(docs), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    h = hits(docs, benchmark, n).select(F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th"), "spans")
    return d.join(h, F.expr("hash = hit_th and id <=> hit_id"), how)


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text holds a window of the benchmark."""
    return _beside_hits(docs, benchmark, n, "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` with the marked words, and what follows each up to the next word, cut out of ``text``."""
    out = _beside_hits(docs, benchmark, n, "left").withColumn("text", F.col("row.text"))
    # Parts of the text: what stands before the first word, then each word with the gap after it.
    gap = GAP_ANY_CASE.replace("\\", "\\\\")
    word = gap.replace("[", "[^", 1)
    parts = F.expr(f"regexp_extract_all(text, '^{gap}|{word}({gap})?', 0)")
    out = out.withColumn("parts", F.when(F.col("spans").isNotNull(), parts)).withColumn(
        "lead", F.expr(f"if(text rlike '^{gap}', 1, 0)"))
    kept = F.expr("array_join(filter(parts, (p, i) -> not exists(spans, s -> i - lead + 1 >= s.at and i - lead + 1 < s.at + s.w)), '')")
    cut = F.when(F.col("spans").isNotNull(), kept).otherwise(F.col("text"))
    return out.select(F.col("row").withField("text", cut).alias("row")).select("row.*")
