"""Operator 2: benchmark decontamination by winnowing, with DataFrame functions only.

A window is ten consecutive words of a benchmark item, or the whole of a shorter item.  Its
fingerprint is the smallest hash of its 4-word grams, a function of its words alone, so a window
shared by a document and an item has the same fingerprint in both: no shared window is missed.
Neighbouring windows mostly share their minimum, so a document gives one row for each run of
them, about every fourth word.  The runs are joined to the items' fingerprints; those that hit
are extended to whole windows and compared word by word.  Items shorter than ten words are
matched by windows of their own length, one pass for each length that occurs.

The fingerprints of the items are broadcast only if there are at most ``broadcast_rows`` of
them.  Otherwise the runs are shuffled to them without their words, and the words of the hits
are taken from the documents again.  Documents meet windows and sets of items, never pairs
of all items with all documents: the item list is made once for each distinct set of window
classes.

Defined cases: null, empty and wordless texts have no words and no hits; null, empty and wordless
items have no window; an item with a null id makes hits but is not listed; items of equal id
count once; repeated documents each get a row; empty tables give no rows or no hits; other
columns are ignored.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.components import stored
from millrace.llm.native import ascii_lower, let, row_key

WINDOW = 10
GRAM = 4
BROADCAST_ROWS = 1 << 19

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def part(words: Column, start: Column, n) -> Column:
    """``n`` words from ``start`` on (from 0).  ``slice`` would copy the whole array each time."""
    return F.transform(F.sequence(start, start + n - 1), lambda i: F.get(words, i))


def words_of(text: Column) -> Column:
    words = F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")
    return F.coalesce(words, F.array().cast("array<string>"))


def _minima(words: Column, length: int) -> Column:
    """The smallest gram hash of every window of ``length`` words."""
    gram = min(GRAM, length)

    def hashes(ws):
        heads = F.slice(ws, F.lit(1), F.greatest(F.size(ws) - (gram - 1), F.lit(0)))
        return F.transform(heads, lambda w, i: F.xxhash64(w, *[F.get(ws, i + j) for j in range(1, gram)]))

    def smaller_of(step):
        def pairs(ms):
            heads = F.slice(ms, F.lit(1), F.greatest(F.size(ms) - step, F.lit(0)))
            return F.transform(heads, lambda m, i: F.least(m, F.get(ms, i + step)))

        return pairs

    values, done = let(words, hashes), 1
    while done < length - gram + 1:
        step = min(done, length - gram + 1 - done)
        values, done = let(values, smaller_of(step)), done + step
    return values


def fingerprints(words: Column, length: int) -> Column:
    """Array of ``print``, ``start``, ``n`` and ``span``: the runs of windows with one minimum.

    ``span`` has the words of the run, from its first window to the end of its last.
    """

    def runs(ms):
        changes = F.filter(F.sequence(F.lit(0), F.size(ms) - 1), lambda i: (i == 0) | (F.get(ms, i) != F.get(ms, i - 1)))

        def described(starts):
            def one(s, j):
                n = F.coalesce(F.get(starts, j + 1), F.size(ms)) - s
                return F.struct(
                    F.get(ms, s).alias("print"), s.alias("start"), n.alias("n"), part(words, s, n + (length - 1)).alias("span")
                )

            return F.transform(starts, one)

        return let(changes, described)

    whole = F.when(F.size(words) >= length, words)
    return F.when(whole.isNotNull(), let(_minima(whole, length), runs))


def _windows(items: DataFrame, window: int) -> DataFrame:
    """``length``, ``window`` (words joined by spaces) and ``item_id`` of every distinct item window."""
    sized = items.withColumn("length", F.least(F.size("words"), F.lit(window))).filter("length > 0")
    starts = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    parts = F.transform(starts, lambda i: F.array_join(part(F.col("words"), i, F.col("length")), " "))
    return sized.select("item_id", "length", F.explode(parts).alias("window")).distinct()


def _covered(intervals: Column) -> Column:
    """How many places the half-open intervals (start, end) cover together."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("until"))

    def add(state, x):
        new = F.greatest(x["end"] - F.greatest(x["start"], state["until"]), F.lit(0))
        return F.struct((state["n"] + new).alias("n"), F.greatest(state["until"], x["end"]).alias("until"))

    return F.aggregate(F.array_sort(intervals), start, add, lambda state: state["n"])


def find_benchmark_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with a ``key``, their hits, and the sets of items that the hits name.

    The first table has ``key``, ``doc_id`` and ``n_words``, a row for each document.  The second
    has ``key``, ``start``, ``end`` and ``items``, the name of the set of items with that window.
    The third has ``items`` and ``item_ids``, a row for each set.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = named.withColumn("key", row_key("doc_id", "text"))
    texts = named.select("key", words_of(F.col("text")).alias("words"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text").cast("string")).alias("words"))
    windows = stored(_windows(items, window), "item-windows")
    sets = windows.groupBy("length", "window").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    sets = stored(sets.withColumn("items", F.md5(F.to_json("item_ids").cast("binary"))), "item-sets")

    hits = None
    for length in sorted(r.length for r in sets.select("length").distinct().collect()):
        known = sets.filter(F.col("length") == length)
        split = F.split("window", " ")
        prints = stored(known.select(F.get(_minima(split, length), F.lit(0)).alias("print")).distinct(), "prints")
        runs = texts.select("key", F.explode(fingerprints(F.col("words"), length)).alias("run")).select("key", "run.*")
        if prints.count() <= broadcast_rows:
            near = runs.join(F.broadcast(prints), "print", "left_semi")
        else:
            places = runs.select("key", "print", "start", "n").join(prints, "print", "left_semi")
            places = places.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("places"))
            span = part(F.col("words"), F.col("place.start"), F.col("place.n") + (length - 1))
            near = texts.join(places, "key").select("key", "words", F.explode("places").alias("place"))
            near = near.select("key", "place.start", "place.n", span.alias("span"))
        each = near.select("key", "start", "span", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
        each = each.select(
            "key", (F.col("start") + F.col("i")).alias("start"), F.array_join(part(F.col("span"), F.col("i"), length), " ").alias("window")
        )
        found = each.join(known.select("window", "items"), "window").select("key", "start", (F.col("start") + length).alias("end"), "items")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = docs.sparkSession.createDataFrame([], "key binary, start int, end int, items string")
    out = named.select("key", "doc_id", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    return out, hits, sets.select("items", "item_ids").dropDuplicates(["items"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``item_ids`` and ``contaminated`` of every document."""
    out, hits, sets = find_benchmark_spans(docs, benchmark, window, broadcast_rows)
    per_doc = hits.groupBy("key").agg(
        _covered(F.collect_set(F.struct("start", "end"))).alias("n_hit"), F.array_sort(F.collect_set("items")).alias("sets")
    )
    per_doc = stored(per_doc.withColumn("mix", F.md5(F.array_join("sets", ",").cast("binary"))), "hits")
    mixes = per_doc.select("mix", "sets").dropDuplicates(["mix"]).select("mix", F.explode("sets").alias("items"))
    mixes = mixes.join(sets, "items").select("mix", F.explode_outer("item_ids").alias("item_id"))
    mixes = mixes.groupBy("mix").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    found = per_doc.drop("sets").join(mixes, "mix").drop("mix")
    joined = out.join(found, "key", "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    listed = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), "contaminated")
