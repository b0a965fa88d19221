"""Operator 12: periodic runs of words, found on a grammar of each document.

1. *Re-Pair.*  Every document's word ids are replaced pair by pair, frequent pairs first, until no pair
   occurs twice.  The documents of a block go through the rounds together; a round replaces all
   pairs that are more frequent than those they overlap.  Ids are not shared between documents,
   so a document's grammar does not depend on its block.
2. *Boundaries.*  A run lies in one nonterminal whose two parts it spans, or across the symbols that are
   left, over which a balanced binary tree is laid.  For each of these nodes, at its first place
   only, every period up to half its length is tried at the boundary: at least a quarter of the least length must
   agree at that distance on one side; then the agreement is extended both ways inside the node.
3. *Translation.*  What a nonterminal holds is copied to all its places.  Intervals of one period that lie
   in another are pieces of it and are merged into it; of equal intervals the smallest period stays.
   The runs left are compared word by word in the end.

A task holds one document's words at once, and candidates in chunks; nothing is shuffled.

Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text; repeated rows and
null ids are documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.blocks import WordBlock, mixed, pieces, ship
from millrace.llm.native import let

ship(__name__)

MIN_LENGTH = 12
# Candidates that are tried at once.
CHUNK = 1 << 21


class _Grammar:
    """Nonterminals and left-over symbols of a block's documents, all by word places in the block.

    ``node`` has a row for each boundary: begin, boundary and end of its first place; ``places`` holds, for
    the nodes that are nonterminals, their number and each of their places.
    """

    def __init__(self, block: WordBlock, min_length: int):
        n = len(block.ids)
        doc = np.repeat(np.arange(len(block.counts)), block.counts)
        # a word is another symbol in every document
        self.symbol = np.unique(block.ids + doc * (int(block.ids.max(initial=0)) + 1), return_inverse=True)[1].astype(np.int64)
        self.length = np.ones(n, np.int64)
        # n stands for no neighbour
        self.next, self.before = np.arange(1, n + 1), np.arange(-1, n)
        self.next[block.starts[1:][block.counts > 0] - 1] = n
        self.before[:-1][block.starts[:-1][block.counts > 0]] = n
        self.before[n] = n
        self.there = np.ones(n, bool)
        self.rank = np.zeros(n + 1, np.int64)
        self.fresh = int(self.symbol.max(initial=-1)) + 1
        nodes, places, number = [], [], 0
        live = np.flatnonzero(self.next < n)
        while len(live):
            live, first, left, at, of = self._round(live, n)
            long = self.length[first] >= min_length
            nodes.append(np.stack([first[long], first[long] + left[long], first[long] + self.length[first[long]]], 1))
            renamed = np.cumsum(long) - 1 + number
            here = long[of]
            places.append(np.stack([renamed[of[here]], at[here]], 1))
            number += int(long.sum())
        self.n_rules = number
        self.node = np.concatenate([*nodes, self._tree(block, n, min_length)])
        self.places = np.concatenate(places) if places else np.zeros((0, 2), np.int64)

    def _round(self, live: np.ndarray, n: int):
        """Replace the pairs that win over those they overlap; what may still repeat, and the new rules."""
        none = np.zeros(0, np.int64)
        after = self.next[live]
        a, b = self.symbol[live], self.symbol[after]
        _, pair = np.unique(a * self.fresh + b, return_inverse=True)
        # in a stretch of one symbol every other pair counts
        same = np.append(False, (pair[1:] == pair[:-1]) & (after[:-1] == live[1:]) & (a[1:] == b[1:]))
        begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(live))))
        even = (np.arange(len(live)) - begin) % 2 == 0
        count = np.bincount(pair[even], minlength=pair.max() + 1)
        shuffled = np.empty(len(count), np.int64)
        shuffled[np.argsort(mixed(np.arange(len(count), dtype=np.uint64)), kind="stable")] = np.arange(len(count))
        again = count[pair] > 1
        live, after, pair, even = live[again], after[again], pair[again], even[again]
        self.rank[live] = (count[pair] << 32) | (shuffled[pair] + 1)
        wins = even & (self.rank[live] >= self.rank[self.before[live]]) & (self.rank[live] >= self.rank[after])
        self.rank[live] = 0
        chosen = np.bincount(pair[wins], minlength=len(count))
        wins &= chosen[pair] > 1
        if not wins.any():
            return none, none, none, none, none
        at, gone = live[wins], after[wins]
        _, first, of = np.unique(pair[wins], return_index=True, return_inverse=True)
        left = self.length[at[first]]
        self.symbol[at] = self.fresh + of
        self.fresh += len(first)
        self.length[at] += self.length[gone]
        self.there[gone] = False
        self.next[at] = self.next[gone]
        self.before[self.next[at]] = at
        self.before[n] = n
        # the pairs of the others did not change
        around = self.before[at]
        live = np.unique(np.concatenate([live[self.there[live]], at, around[around < n]]))
        return live[self.next[live] < n], at[first], left, at, of

    def _tree(self, block: WordBlock, n: int, min_length: int) -> np.ndarray:
        """Boundaries between the symbols left: the k-th divides 2**t symbols on either side, 2**t the power of two in k."""
        begin = np.flatnonzero(self.there)
        doc = np.searchsorted(block.starts, begin, side="right") - 1
        first = np.searchsorted(begin, block.starts)  # of each document, in begin
        k = np.arange(len(begin)) - first[doc]
        half = k & -k
        inner = k > 0
        low = np.arange(len(begin)) - half
        high = np.minimum(np.arange(len(begin)) + half, first[doc + 1])
        ends = np.append(begin, n)
        node = np.stack([begin[low[inner]], begin[inner], ends[high[inner]]], 1)
        return node[node[:, 2] - node[:, 0] >= min_length]


def _agree(block: WordBlock, u: np.ndarray, v: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many words agree from ``u`` and ``v`` on, or before them, up to ``most``."""
    out = np.zeros(len(u), np.int64)
    for bit in reversed(range(int(most.max(initial=0)).bit_length())):
        step = 1 << bit
        room = np.flatnonzero(out + step <= most)
        shift = -out[room] - step if back else out[room]
        equal = block.spans(u[room] + shift, step) == block.spans(v[room] + shift, step)
        out[room[equal]] += step
    return out


def _at_boundaries(block: WordBlock, node: np.ndarray, min_length: int) -> np.ndarray:
    """Node, begin, end and period of the periodic intervals at the nodes' boundaries, maximal in their node."""
    n = len(block.ids)
    # words on both sides of a boundary agree over half the least length, so a quarter does on one side;
    # equal grams have equal hashes, and those that reach over the end of the block agree by chance only
    size = max(1, -(-min_length // 4))
    word = np.concatenate([mixed(block.ids.astype(np.uint64) + np.uint64(1)), np.zeros(size, np.uint64)])
    gram = np.zeros(n, np.uint64)
    for i in range(size):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + word[i : i + n]
    right = np.concatenate([np.zeros(size, np.uint64), gram, np.zeros(1, np.uint64)])  # from its word on
    tries = (node[:, 2] - node[:, 0]) // 2
    ends = np.cumsum(tries)
    out = [np.zeros((0, 4), np.int64)]
    total = int(ends[-1]) if len(ends) else 0
    for at in range(0, total, CHUNK):
        place = np.arange(at, min(at + CHUNK, total))
        of = np.searchsorted(ends, place, side="right")
        period = place - (ends[of] - tries[of]) + 1
        low, cut, high = node[of].T
        for u in (cut - period, cut):
            inside = (u >= low) & (u + period <= high)
            a, b = np.where(inside, u, 0) + size, np.where(inside, u + period, 0) + size
            hope = np.flatnonzero(inside & ((right[a] == right[b]) | (right[a - size] == right[b - size])))
            p, lo, hi, u_ = period[hope], low[hope], high[hope], u[hope]
            ahead = _agree(block, u_, u_ + p, hi - u_ - p, False)
            behind = _agree(block, u_, u_ + p, u_ - lo, True)
            good = (ahead + behind >= p) & (ahead + behind + p >= min_length)
            out.append(np.stack([of[hope], u_ - behind, u_ + p + ahead, p], 1)[good])
    found = np.concatenate(out)
    return _smallest_periods(found)


def _smallest_periods(found: np.ndarray) -> np.ndarray:
    """The row of least period for each node and interval."""
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    again = np.append(False, (found[1:, :3] == found[:-1, :3]).all(1))[: len(found)]
    return found[~again]


def _merged(found: np.ndarray, n: int) -> np.ndarray:
    """Without intervals that lie in another one of their period, and of equal ones that of least period."""
    found = found[np.lexsort((-found[:, 2], found[:, 1], found[:, 3]))]
    # the farthest end so far among those of the period
    reach = np.maximum.accumulate(found[:, 3] * (n + 1) + found[:, 2])
    inner = np.append(False, found[1:, 3] * (n + 1) + found[1:, 2] <= reach[:-1])[: len(found)]
    found = found[~inner]
    found[:, 0] = 0
    return _smallest_periods(found)


def _spelled_out(ids: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """The runs of one document by trying each period, where hashes have not told its words apart."""
    found: dict[tuple[int, int], int] = {}
    for p in range(1, len(ids) // 2 + 1):
        equal = np.concatenate([[False], ids[:-p] == ids[p:], [False]])
        turns = np.flatnonzero(equal[1:] != equal[:-1])
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            if b - a >= max(p, min_length - p):
                found.setdefault((a, b + p), p)
    return [(a, b, p) for (a, b), p in found.items()]


def find_runs(block: WordBlock, min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(begin, end, period) of the maximal runs of each text, by begin and period."""
    grammar = _Grammar(block, min_length)
    here = _at_boundaries(block, grammar.node, min_length)
    rules, rest = here[here[:, 0] < grammar.n_rules], here[here[:, 0] >= grammar.n_rules]
    # all places of a rule that holds intervals; both tables by rule
    places = grammar.places[np.argsort(grammar.places[:, 0], kind="stable")]
    a, b = (np.searchsorted(places[:, 0], rules[:, 0], side=s) for s in ("left", "right"))
    which = np.repeat(np.arange(len(rules)), b - a)
    across = np.arange(len(which)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
    shift = places[across, 1] - grammar.node[rules[which, 0], 0]
    copied = rules[which]
    copied[:, 1] += shift
    copied[:, 2] += shift
    runs = _merged(np.concatenate([copied, rest]), len(block.ids))
    of = np.searchsorted(block.starts, runs[:, 1], side="right") - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in block.counts]
    wrong = set()
    for doc, (_, begin, end, period) in zip(of.tolist(), runs.tolist(), strict=True):
        if not np.array_equal(block.ids[begin : end - period], block.ids[begin + period : end]):
            wrong.add(doc)
        start = int(block.starts[doc])
        out[doc].append((begin - start, end - start, period))
    for doc in wrong:
        out[doc] = _spelled_out(block.ids[block.starts[doc] : block.starts[doc + 1]], min_length)
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def _rows(min_length: int):
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                block = WordBlock(part.column("text").to_pylist())
                found = find_runs(block, min_length)
                texts = []
                for start, end, runs in zip(block.starts[:-1].tolist(), block.starts[1:].tolist(), found, strict=True):
                    words = block.words[start:end]
                    if runs:
                        turns = np.zeros(len(words) + 1, np.int64)
                        for a, b, p in runs:
                            turns[a + p] += 1
                            turns[b] -= 1
                        words = [words[i] for i in np.flatnonzero(np.cumsum(turns[:-1]) == 0).tolist()]
                    texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                listed = [[{"start": a, "length": b - a, "period": p} for a, b, p in runs] for runs in found]
                columns = [part.column("doc_id"), pa.array(block.counts), pa.array(listed, run_type), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed_text"])

    return run


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Every document's maximal periodic runs, and its words without the repetitions.

    A run is a stretch of words with smallest period ``period``, at least ``min_length`` and two periods long,
    that no neighbouring word extends.  Returns ``doc_id``, ``n_words``, ``runs`` (``start``, ``length`` and
    ``period`` in words, by start and period) and ``collapsed_text``: the words that no run covers after its
    first period, joined by one space.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string"
    return rows.mapInArrow(_rows(min_length), kind)


def with_planted_periods(text: Column, doc_id: Column) -> Column:
    """Every tenth text with its words from some place on repeated, by a checksum of the id.

    With ``h`` the checksum and ``g`` its tenth, words from ``a = g % n`` on repeat the first ``p`` of them.
    A null id leaves the text as it is.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(s: Column) -> Column:
        a, p = s["a"], s["p"]
        word = lambda w, i: F.when(i < a, w).otherwise(F.get(s["words"], (a + (i - a) % p).cast("int")))
        return F.array_join(F.transform(s["words"], word), " ")

    def placed(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        return F.when(n > 0, let(F.struct(words.alias("words"), a.alias("a"), period.alias("p")), repeated)).otherwise("")

    return F.when(h % 10 == 0, let(words, placed)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs and collapsed text as digests, and its longest run."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = collapse_runs(docs.select("doc_id", with_planted_periods(F.col("text"), F.col("doc_id")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP12_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_transform(range(8 * length(doc_id::VARCHAR)), lambda i: (ascii((doc_id::VARCHAR)[i // 8 + 1]) >> (i % 8)) & 1) AS bits
  FROM documents
), summed AS (
  SELECT r, doc_id, words, xor(list_reduce(list_prepend(4294967295::BIGINT, bits::BIGINT[]), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) AS h FROM doc
), part AS (
  SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM summed
), period AS (
  SELECT *, 1 + (len(words) - a) // (3 + g % 8) AS p FROM part
), word AS (
  SELECT r, i, CASE WHEN i >= a THEN words[a + (i - a) % p + 1] ELSE words[i + 1] END AS w
  FROM (SELECT *, unnest(range(len(words))) AS i FROM period)
), gram AS (
  SELECT r, i, w, string_agg(w, ' ') OVER f AS k, count(*) OVER f AS n FROM word
  WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)
), pair AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM gram x JOIN gram y ON x.r = y.r AND x.k = y.k AND x.i < y.i WHERE x.n = 6 AND y.n = 6
), island AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS lane FROM pair
), stretch AS (
  SELECT r, q, min(i) AS s, max(i) + 6 + q AS e FROM island GROUP BY r, q, lane HAVING max(i) + 6 - min(i) >= greatest(q, 12 - q)
), run AS (
  SELECT r, s, e, min(q) AS q FROM stretch GROUP BY r, s, e
), gone AS (
  SELECT DISTINCT r, unnest(range(s + q, e)) AS i FROM run
), kept AS (
  SELECT word.r, string_agg(w, ' ' ORDER BY word.i) FILTER (gone.i IS NULL) AS text FROM word LEFT JOIN gone ON gone.r = word.r AND gone.i = word.i GROUP BY word.r
), listed AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS runs,
         first({'s': s, 'l': e - s, 'q': q} ORDER BY e - s DESC, s, q) AS best
  FROM run GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.q::BIGINT AS period,
       (1000 * best.l // best.q)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM doc LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""
