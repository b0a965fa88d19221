"""Operator 4: delete later copies of repeated line runs, with DataFrame functions only.

1. *Suffixes.*  The lines of all documents, blank ones left out, are sequences of line ids.  A line that
   is nowhere else ends every run, so only lines that are there twice begin a suffix.
2. *Prefix doubling.*  Suffixes are ranked by their first line, then by pairs of ranks one line apart, two apart
   and so on, until all are told apart or have ended; a round works on those that are left.  Ordered
   by rank and place in the documents they are the suffix array.
3. *Common prefixes.*  Suffixes that are equal to the end are one in the suffix array; all but the earliest have
   all their lines in common with it.  Of all earlier suffixes the one with the longest prefix in common with the
   earliest is the nearest in the suffix array, on either side, that is earlier in the documents.  Minima of stretches
   that double find both; the prefix itself is put together from the ranks, longest first.
4. *Runs.*  A line whose suffix has ``min_lines`` lines or more in common with an earlier one begins a run, and lines whose
   runs end at one place belong to one: from the first of them on it is a maximal run.  Its lines go.

Places are ordered by ``doc_id``, document and line.  Most joins are on unique places.  Those on a line's id or rank
have one row for each on the other side, so adaptive execution splits them; counting combines before the
shuffle, and no pile of equal lines meets in one task.

Defined cases: null texts stay null and have no lines; empty or blank texts are unchanged; a text
that loses lines also loses its blank lines, others keep them; a text that loses all lines is
empty; rows equal in ``doc_id`` and text are one document and get the same result; a null
``doc_id`` comes first; texts shorter than ``min_lines`` lines are unchanged; an empty table gives
no rows; other columns are ignored.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.llm.components import stored
from millrace.llm.native import fresh, let, row_key
from millrace.llm.ordering import numbered

MIN_LINES = 1


def lines_of(text: Column) -> Column:
    """The lines that have a character other than 0x20 and 0x09-0x0D."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x09-\x0D\x20]"))


def _suffixes(docs: DataFrame) -> DataFrame:
    """``at``, ``key``, ``line``, ``rank`` and ``left`` of every line that is there twice.

    ``at`` numbers them in the order of documents and lines; ``rank`` is the number of lines whose content
    sorts before; ``left`` counts the lines up to the next that is nowhere else.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = named.withColumn("key", row_key("doc_id", "text"))
    lines = named.select("key", "doc_id", F.posexplode(lines_of(F.col("text"))).alias("line", "content"))
    lines = lines.select("key", "doc_id", "line", F.unhex(F.md5(F.col("content").cast("binary"))).alias("id"))
    twice = lines.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    found = lines.join(twice, "id").dropDuplicates(["key", "line"])
    found = numbered(found, "doc_id", "key", "line").withColumnRenamed("place", "at")
    firsts = numbered(found.groupBy("id").agg(F.count("*").alias("n")), "id", weight="n").select("id", F.col("place").alias("rank"))
    stretch = F.col("line") - F.row_number().over(Window.partitionBy("key").orderBy("line"))
    left = F.max("line").over(Window.partitionBy("key", "stretch")) - F.col("line") + 1
    found = found.join(firsts, "id").withColumn("stretch", stretch).select("at", "key", "line", "rank", left.alias("left"))
    return stored(found, "suffixes")


def _doubled(suffixes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of ``at``, ``rank`` and ``left`` with ranks by 1, 2, 4 and so on lines, and each suffix's last rank.

    A rank is the number of suffixes that sort before, so ranks of different rounds can be compared.  Suffixes that
    have ended, or share their rank with no other, keep it and take no part in further rounds.
    """
    latest = suffixes.select("at", "rank", "left")
    levels = [latest]
    while True:
        step = 1 << (len(levels) - 1)
        classes = levels[-1].groupBy("rank").agg(F.count("*").alias("n"), F.count_if(F.col("left") <= step).alias("ended"))
        onward = levels[-1].filter(F.col("left") > step).join(classes.filter("n > 1 and ended < n").select("rank", "ended"), "rank")
        after = latest.select((F.col("at") - step).alias("at"), F.col("rank").alias("next"))
        pairs = stored(onward.join(after, "at").select("at", "rank", "left", "ended", "next"), "pairs")
        if pairs.isEmpty():
            return levels, latest
        names = numbered(pairs.groupBy("rank", "next", "ended").agg(F.count("*").alias("n")), "rank", "next", weight="n")
        own = names.groupBy("rank").agg(F.min("place").alias("first"))
        names = names.join(own, "rank").select("rank", "next", (F.col("rank") + F.col("ended") + F.col("place") - F.col("first")).alias("name"))
        levels.append(stored(pairs.join(names, ["rank", "next"]).select("at", F.col("name").alias("rank"), "left"), "ranks"))
        newer = levels[-1].select("at", F.col("rank").alias("newer"))
        latest = stored(latest.join(newer, "at", "left").select("at", F.coalesce("newer", "rank").alias("rank"), "left"), "latest")


def _nearest_earlier(array: DataFrame) -> DataFrame:
    """``at`` and ``its_at``: on each side the nearest suffix in the array that is earlier, if its first line is the same.

    ``array`` has ``place``, ``at``, ``base``, the rank of the first line, and ``size``, how many have it.  For each
    place the earliest suffix of the next 1, 2, 4 and so on places is known; from the widest stretch down every
    suffix steps over those in which all are later.  Lines that begin ``n`` places need stretches below ``n``.
    """
    largest = array.agg(F.max("size")).first()[0] or 1
    side = F.explode(F.array(F.lit(-1), F.lit(1))).alias("side")
    least = [array.select("place", side, F.col("at").alias("least"), "size")]
    while 1 << len(least) < largest:
        step = 1 << (len(least) - 1)
        here = least[-1].filter(F.col("size") > step)
        beyond = here.select((F.col("place") - F.col("side") * step).alias("place"), "side", F.col("least").alias("its"))
        wider = here.filter(F.col("size") > 2 * step).join(beyond, ["place", "side"], "left")
        least.append(stored(wider.select("place", "side", F.least("least", "its").alias("least"), "size"), "least"))
    rows = array.select("at", "base", "size", side, (F.col("place") + F.col("side")).alias("other"))
    found = None
    for level in reversed(range(len(least))):
        fresh_ = rows.filter((F.col("size") > 1 << level) & (F.col("size") <= (1 << (level + 1) if found is not None else largest)))
        active = fresh_ if found is None else found.unionByName(fresh_)
        there = least[level].select(F.col("place").alias("other"), "side", "least")
        later = F.coalesce(F.col("least") > F.col("at"), F.lit(False))
        onward = F.col("other") + F.when(later, F.col("side") * (1 << level)).otherwise(0)
        found = stored(active.join(there, ["other", "side"], "left").select("at", "base", "size", "side", onward.alias("other")), "nearest")
    its = array.select(F.col("place").alias("other"), F.col("base").alias("its_base"), F.col("at").alias("its_at"))
    return found.join(its, "other").filter("its_base = base and its_at < at").select("at", "its_at")


def _common_prefixes(pairs: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``at`` and ``length``, the lines that a suffix has in common with the one at ``its_at``; they share the first line.

    Both follow their stretch of repeated lines, ``left`` and ``its_left`` of them, so only as many can agree.
    """
    pairs = stored(pairs.withColumn("length", F.lit(0)), "prefixes")
    found, done = None, []
    for level in reversed(range(1, len(levels))):
        most = F.least("left", "its_left")
        low, high = 1 << (level - 1), 1 << level
        fresh_ = pairs.filter(most > low if found is None else (most > low) & (most <= high))
        active = fresh_ if found is None else found.unionByName(fresh_)
        rank = levels[level].select(F.col("at").alias("a"), "rank", F.col("left").alias("further"))
        # beyond its end another stretch begins
        inside = F.col("length") < most
        here = active.join(rank, inside & (F.col("at") + F.col("length") == F.col("a")), "left").drop("a")
        its = levels[level].select(F.col("at").alias("a"), F.col("rank").alias("its_rank"))
        both = here.join(its, inside & (F.col("its_at") + F.col("length") == F.col("a")), "left")
        more = F.when(F.col("rank") == F.col("its_rank"), F.least("further", F.lit(high))).otherwise(0)
        found = stored(both.select("at", "its_at", "left", "its_left", (F.col("length") + more).alias("length")), "prefixes")
    short = pairs if found is None else found.filter("length = 0").unionByName(pairs.filter(F.least("left", "its_left") <= 1))
    done.append(short.select("at", F.lit(1).alias("length")))
    if found is not None:
        # one line more, if it is within both stretches
        some = found.filter("length > 0")
        rank = levels[0].select(F.col("at").alias("a"), "rank")
        inside = F.col("length") < F.least("left", "its_left")
        here = some.join(rank, inside & (F.col("at") + F.col("length") == F.col("a")), "left").drop("a")
        its = rank.withColumnRenamed("rank", "its_rank")
        both = here.join(its, inside & (F.col("its_at") + F.col("length") == F.col("a")), "left")
        more = F.when(F.col("rank") == F.col("its_rank"), 1).otherwise(0)
        done.append(both.select("at", (F.col("length") + more).alias("length")))
    return reduce(DataFrame.unionByName, done)


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``key``, ``start`` and ``end`` (excluded) of every maximal run of lines that stand together at an earlier place.

    A run has ``min_lines`` lines or more; runs of a document may overlap, but none holds another.
    """
    suffixes = _suffixes(docs)
    levels, latest = _doubled(suffixes)
    # suffixes that share their last rank are equal to the end, and the earliest of them stands for all
    classes = stored(latest.groupBy("rank").agg(F.min("at").alias("at")), "classes")
    equal = latest.join(classes.select("at"), "at", "left_anti").select("at", F.col("left").alias("length"))
    base = suffixes.select("at", F.col("rank").alias("base"))
    array = stored(numbered(classes, "rank").join(base, "at").select("place", "at", "base"), "array")
    sizes = array.groupBy("base").agg(F.count("*").alias("size")).filter("size > 1")
    nearest = _nearest_earlier(stored(array.join(sizes, "base").select("place", "at", "base", "size"), "array"))
    left = suffixes.select("at", "left")
    its = left.withColumnsRenamed({"at": "its_at", "left": "its_left"})
    prefixes = _common_prefixes(nearest.join(left, "at").join(its, "its_at"), levels)
    longest = prefixes.groupBy("at").agg(F.max("length").alias("length")).unionByName(equal).filter(F.col("length") >= min_lines)
    placed = longest.join(suffixes.select("at", "key", "line"), "at")
    return placed.groupBy("key", (F.col("line") + F.col("length")).alias("end")).agg(F.min("line").alias("start")).select("key", "start", "end")


def drop_repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, count: str = "_n_lines", removed: str = "_removed", runs: str = "_runs") -> DataFrame:
    """The rows of ``docs`` with their text cut, and three columns more.

    ``count`` names the number of lines, ``removed`` the numbers of those that went, ``runs`` the maximal runs they
    were in, as structs of ``start`` and ``end``.  All columns of ``docs`` stay; the names must be free.
    """
    key = fresh(docs, "_key")
    found = repeated_runs(docs, min_lines).groupBy(F.col("key").alias(key)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(runs))
    # of a run that overlaps the one before only what is new, so that lines are listed once
    last = lambda i: F.when(i > 0, F.get(runs, i - 1)["end"]).otherwise(0)
    new = F.transform(runs, lambda r, i: F.sequence(F.greatest(r["start"], last(i)), r["end"] - 1))
    gone = F.coalesce(F.flatten(new), F.array().cast("array<int>"))
    none = F.array().cast(found.schema[runs].dataType)
    found = docs.withColumn(key, row_key("doc_id", "text")).join(found, key, "left").withColumn(removed, gone)
    found = found.withColumn(runs, F.coalesce(runs, none)).drop(key)

    def kept(lines: Column) -> Column:
        numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
        return F.array_join(F.transform(numbers, lambda i: F.get(lines, i)), "\n")

    lines = lines_of(F.col("text").cast("string"))
    text = F.when(F.size(removed) > 0, let(lines, kept)).otherwise(F.col("text"))
    return found.withColumn(count, F.coalesce(F.size(lines), F.lit(0))).withColumn("text", text)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document's kept text, how many lines it lost, and in how many maximal runs."""
    found = drop_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("_n_lines").cast("long").alias("n_lines"),
        F.size("_removed").cast("long").alias("n_removed"),
        F.size("_runs").cast("long").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


OP4_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x09-\x0D\x20]')) AS lines
  FROM documents
), doc AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(coalesce(length(doc_id::VARCHAR)::VARCHAR, '-') || ':' || coalesce(doc_id::VARCHAR, '') || length(text) || ':' || text)) AS p
  FROM (SELECT DISTINCT * FROM cut)
), line AS (
  SELECT p, unnest(range(len(lines))) AS i, unnest(lines) AS content FROM doc
), pair AS (
  SELECT x.p AS xp, y.p, y.i, y.i - x.i AS d FROM line x JOIN line y ON x.content = y.content AND (x.p < y.p OR x.p = y.p AND x.i < y.i)
), lane AS (
  SELECT *, i - row_number() OVER (PARTITION BY xp, p, d ORDER BY i) AS lane FROM pair
), reach AS (
  SELECT p, i, max(i) OVER (PARTITION BY xp, p, d, lane) + 1 AS stop FROM lane
), longest AS (
  SELECT p, i, max(stop) AS stop FROM reach GROUP BY p, i
), per_doc AS (
  SELECT p, list(i ORDER BY i) AS gone, count(DISTINCT stop) AS n_runs FROM longest GROUP BY p
)
SELECT cut.doc_id, len(cut.lines)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs,
       sha256(CASE WHEN gone IS NULL THEN cut.text
                   ELSE array_to_string(list_filter(cut.lines, lambda l, j: NOT list_contains(gone, j - 1)), chr(10)) END) AS kept_sha256
FROM cut JOIN doc ON cut.doc_id IS NOT DISTINCT FROM doc.doc_id AND cut.text = doc.text LEFT JOIN per_doc USING (p)
"""
