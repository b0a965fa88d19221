"""Operator 5: near-duplicates by SetSketch registers, banding, joint likelihood and full sets.

1. A document's set is its distinct word shingles (five words, or as told), as 64-bit hashes.  Register ``i`` holds
   the least of exponentially distributed hash values of the set, truncated to powers of ``BASE``;
   registers of a union are the larger ones, and equal registers grow with the Jaccard index.
2. Documents of equal sets form one class.  Bands of 5 registers make the candidates: 39 of them
   for a Jaccard index of 0.8, 26 for 0.85, so that a pair at the threshold shares none with a
   probability of 2.5e-7 at most.
3. A bucket is named by its smallest class; buckets of one name make a cluster, in which every
   class is there once however many bands it shares.  Members that the joint likelihood of their
   registers leaves possible go on to the full sets.
4. A cluster's sets are compared in a block: those outside the largest component of the first
   few with all others.  A cluster beyond ``MOST_SHINGLES`` is dealt over blocks of that size: first
   each member meets a few pivots, then what that left outside the largest component meets all
   members.  So a cluster that its pivots hold together costs in proportion to its size.  A block
   returns the links that connect its members, one for each merge, and never its pairs; a link
   between components is never lost, as one of its ends is outside and meets the other.

Texts are moved once, to build the sets of candidates.  Links and components stay distributed.

Defined cases: null, empty and wordless texts have an empty set, no link, and are their own
component; texts shorter than a shingle have one, all their words; repeated rows are copies
of each other; a null ``doc_id`` is never the smallest of a component, and a component of nulls
alone keeps them all; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.blocks import BLOCK_BYTES, WordBlock, pieces, ship
from millrace.llm.components import components, stored
from millrace.llm.native import row_key

ship(__name__)

BASE, RATE, TOP = 1.001, 20.0, 65535

# Classes of a block of sketches, and shingles of either side of a block of sets, about.
MOST_SKETCHES, MOST_SHINGLES = 2048, 1 << 20
PIVOTS = 4

# A pair is dropped unread if its registers are e^-18 times as likely at the threshold as at best.
SLACK = 18.0

MOST_REGISTERS = 1024
_SEEDS = np.random.default_rng(20).integers(1, 2**63, (MOST_REGISTERS, 2), dtype=np.uint64)
_FACTORS, _SHIFTS = (_SEEDS[:, 0] << np.uint64(1)) | np.uint64(1), _SEEDS[:, 1]


@dataclass(frozen=True)
class Likeness:
    """What counts as near: words in a shingle, and the least Jaccard index in percent.

    There are as many bands of ``rows`` registers as it takes for a pair at the threshold to
    share none with a probability of ``miss`` at most.
    """

    shingle: int = 5
    percent: int = 80
    rows: int = 5
    miss: float = 2.5e-7

    @property
    def bands(self) -> int:
        alike = (self.percent / 100) ** self.rows
        return 1 if alike >= 1 else math.ceil(math.log(self.miss) / math.log1p(-alike))

    @property
    def registers(self) -> int:
        if self.bands * self.rows > MOST_REGISTERS:
            raise ValueError(f"{self} needs more than {MOST_REGISTERS} registers")
        return self.bands * self.rows


def shingle_sets(texts, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    block = WordBlock(texts, lower=True)
    hashes = np.zeros(0, np.uint64)
    starts = block.window_starts(size)
    if len(starts):
        hashes = block.spans(starts, size)
    room = np.maximum(block.counts - size + 1, 0)
    ends = np.cumsum(room)
    out = []
    for i, (count, n, end) in enumerate(zip(block.counts, room, ends, strict=True)):
        if n:
            out.append(np.unique(hashes[end - n : end]))
        elif count:
            out.append(block.spans(block.starts[i : i + 1], int(count)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(found: np.ndarray, count: int) -> np.ndarray:
    """SetSketch registers of a set of hashes that is not empty."""
    factors, shifts = _FACTORS[:count], _SHIFTS[:count]
    least = np.full(count, 2**64 - 1, np.uint64)
    for i in range(0, len(found), 2048):
        part = found[i : i + 2048, None] * factors
        part += shifts
        np.minimum(least, part.min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    spaced = np.floor(1.0 - np.log(-np.log1p(-uniform) / RATE) / np.log(BASE))
    return np.clip(spaced, 0, TOP).astype(np.uint16)


def _sketch_rows(like: Likeness):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                sets = shingle_sets(part.column("text").to_pylist(), like.shingle)
                columns = [
                    part.column("doc_id"),
                    part.column("row_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([registers(s, like.registers).tobytes() if len(s) else None for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "n_shingles", "set_key", "sketch"])

    return run


def joint_likelihood(n_a, n_b, above, below, equal, at):
    """Log likelihood of the Jaccard values ``at`` (one column each), sizes being known."""
    u = (n_a / (n_a + n_b))[:, None]
    step = (BASE - 1.0) / BASE

    def exceeds(x):
        return -np.log1p(-np.clip(x, 0.0, 1.0) * step) / np.log(BASE)

    up, down = exceeds(u - (1 - u) * at), exceeds((1 - u) - u * at)
    tiny = 1e-12
    return (
        above[:, None] * np.log(np.maximum(up, tiny))
        + below[:, None] * np.log(np.maximum(down, tiny))
        + equal[:, None] * np.log(np.maximum(1 - up - down, tiny))
    )


def possible(n, sketches, n_b, sketch_b, percent: int) -> np.ndarray:
    """Which sets may reach the threshold with the set ``b``, by their registers."""
    most = np.minimum(n, n_b) / np.maximum(n, n_b)
    keep = 100 * np.minimum(n, n_b) >= percent * np.maximum(n, n_b)
    where = np.flatnonzero(keep)
    if len(where):
        n, most, part = n[where], most[where], sketches[where]
        counts = (part > sketch_b).sum(axis=1), (part < sketch_b).sum(axis=1), (part == sketch_b).sum(axis=1)
        goal = np.minimum(most, percent / 100)[:, None]
        less = joint_likelihood(n, n_b, *counts, goal * np.linspace(0, 1, 21)[None, :])
        more = joint_likelihood(n, n_b, *counts, goal + (most[:, None] - goal) * np.linspace(0, 1, 9)[None, :])
        keep[where] = more.max(axis=1) >= less.max(axis=1) - SLACK
    return keep


def _blocks(batches):
    """The rows of each ``cluster``, ``i``, ``j`` from batches that are sorted by them."""
    waiting, last = [], None
    for batch in batches:
        names = list(zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j")), strict=True))
        start = 0
        for row, name in enumerate(names):
            if name != last:
                if row > start:
                    waiting.append(batch.slice(start, row - start))
                if waiting:
                    yield pa.Table.from_batches(waiting)
                waiting, last, start = [], name, row
        if len(names) > start:
            waiting.append(batch.slice(start))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _possible_rows(like: Likeness):
    """The members of each block that may reach the threshold with another one."""

    def run(batches):
        for block in _blocks(batches):
            n = block["n"].to_numpy().astype(np.float64)
            sketches = np.frombuffer(b"".join(block["sketch"].to_pylist()), np.uint16).reshape(len(n), -1)
            keep = np.zeros(len(n), bool)
            for row in range(len(n) - 1):
                near = possible(n[row + 1 :], sketches[row + 1 :], n[row], sketches[row], like.percent)
                keep[row + 1 :] |= near
                keep[row] |= near.any()
            found = block.filter(pa.array(keep)).select(["cluster", "key"])
            yield from found.combine_chunks().to_batches()

    return run


def _member_sets(like: Likeness):
    """Each document's set, once for every block it is in."""
    kinds = {"cluster": pa.binary(), "i": pa.int32(), "j": pa.int32(), "asks": pa.bool_(), "key": pa.binary(), "content": pa.binary()}

    def batch(entries):
        columns = zip(*entries, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))

    def run(batches):
        for rows in batches:
            for part in pieces(rows):
                sets = shingle_sets(part.column("text").to_pylist(), like.shingle)
                entries, size = [], 0
                for key, places, found in zip(part.column("key").to_pylist(), part.column("places").to_pylist(), sets, strict=True):
                    packed = found.tobytes()
                    for place in places:
                        entries.append((place["cluster"], place["i"], place["j"], place["asks"], key, packed))
                        size += len(packed)
                        if size > 4 * BLOCK_BYTES:
                            yield batch(entries)
                            entries, size = [], 0
                if entries:
                    yield batch(entries)

    return run


def spanning_links(sets: list[np.ndarray], percent: int, asking: list[int] | None = None) -> list[tuple[int, int]]:
    """Links at the threshold, one for each merge of what they connect.

    The sets in ``asking`` are compared with all others, by counting common shingles.  Without
    it these are the first few and all outside the largest component of those; so the links
    connect all that any link connects.
    """
    n = np.array([len(s) for s in sets])
    _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), n)
    holders = owner[np.argsort(shingle, kind="stable")]
    ends = np.cumsum(np.bincount(shingle))
    starts = np.concatenate(([0], ends[:-1]))
    first = np.concatenate(([0], np.cumsum(n)))
    label = np.arange(len(sets))
    links = []

    def compare(one: int) -> None:
        own = shingle[first[one] : first[one + 1]]
        width = ends[own] - starts[own]
        shift = np.repeat(starts[own] - (np.cumsum(width) - width), width)
        both = np.bincount(holders[np.arange(width.sum()) + shift], minlength=len(sets))
        near = np.flatnonzero(100 * both >= percent * (n[one] + n - both))
        for other in near[np.unique(label[near], return_index=True)[1]].tolist():
            if label[other] != label[one]:
                links.append((one, other))
                label[label == label[other]] = label[one]

    if asking is not None:
        for one in asking:
            compare(one)
        return links
    few = min(4, len(sets))
    for one in range(few):
        compare(one)
    names, counts = np.unique(label, return_counts=True)
    anchor = int(np.flatnonzero(label == names[np.argmax(counts)])[0])
    for one in range(few, len(sets)):
        if label[one] != label[anchor]:
            compare(one)
    return links


def _confirmed(like: Likeness):
    def run(batches):
        for block in _blocks(batches):
            keys, asks = block["key"].to_pylist(), block["asks"].to_pylist()
            # a set may come twice, from a repeated row or in both roles
            rows = {}
            for row in sorted(range(len(keys)), key=lambda row: not asks[row]):
                rows.setdefault(keys[row], row)
            rows = list(rows.values())
            asking = None if None in asks else [at for at, row in enumerate(rows) if asks[row]]
            content = block["content"].combine_chunks()
            sets = [np.frombuffer(content[row].as_buffer(), np.uint64) for row in rows]
            links = spanning_links(sets, like.percent, asking)
            if links:
                pairs = [sorted((keys[rows[x]], keys[rows[y]])) for x, y in links]
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.binary()) for side in zip(*pairs, strict=True)], ["a", "b"])

    return run


PLACE = ["cluster", "i", "j"]


def _likely(classes: DataFrame, members: DataFrame, like: Likeness) -> DataFrame:
    """Members of clusters, without those whose registers leave no other one possible.

    A cluster of more than ``MOST_SKETCHES`` keeps all.
    """
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n_keys"))
    sized = members.join(sizes, "cluster")
    small = sized.filter(F.col("n_keys") <= MOST_SKETCHES).join(classes.select("key", "n", "sketch"), "key")
    small = small.select("cluster", F.lit(0).alias("i"), F.lit(0).alias("j"), "key", "n", "sketch")
    near = small.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(_possible_rows(like), "cluster binary, key binary")
    return near.unionByName(sized.filter(F.col("n_keys") > MOST_SKETCHES).select("cluster", "key"))


def _chunked(rows: DataFrame, name: str) -> DataFrame:
    """Rows with a chunk number, by key; a cluster's chunks have about ``MOST_SHINGLES`` shingles."""
    sizes = rows.groupBy("cluster").agg(F.ceil(F.sum("n") / MOST_SHINGLES).cast("int").alias(f"{name}s"))
    return rows.join(sizes, "cluster").withColumn(name, F.pmod(F.xxhash64("key"), f"{name}s").cast("int"))


def _met(asking: DataFrame, members: DataFrame) -> DataFrame:
    """Places where every chunk of ``asking`` meets every chunk of ``members`` of its cluster."""
    asking, members = _chunked(asking, "x"), _chunked(members, "y")
    of_x, of_y = (side.select("cluster", f"{name}s").distinct() for side, name in ((asking, "x"), (members, "y")))
    one = asking.join(of_y, "cluster").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("ys") - 1)))
    two = members.join(of_x, "cluster").withColumn("x", F.explode(F.sequence(F.lit(0), F.col("xs") - 1)))
    columns = ["key", "row_key", "cluster", F.col("x").alias("i"), F.col("y").alias("j")]
    return one.select(*columns, F.lit(True).alias("asks")).union(two.select(*columns, F.lit(False)))


def _linked(rows: DataFrame, placed: DataFrame, like: Likeness) -> DataFrame:
    """Links (``a``, ``b``) found in the blocks of ``placed``; each text is read from one row of its class."""
    wanted = placed.groupBy("key", "row_key").agg(F.collect_list(F.struct(*PLACE, "asks")).alias("places"))
    texts = rows.join(stored(wanted, "wanted"), "row_key").select("key", "places", "text")
    sets = texts.mapInArrow(_member_sets(like), "cluster binary, i int, j int, asks boolean, key binary, content binary")
    links = sets.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(_confirmed(like), "a binary, b binary")
    return stored(links.distinct(), "links")


def _components(rows: DataFrame, classes: DataFrame, members: DataFrame, like: Likeness) -> DataFrame:
    """``node`` and ``root`` of the classes that have a link within any cluster."""
    near = _likely(classes, members, like).join(classes.select("key", "n", "row_key"), "key")
    near = stored(near, "near")
    sizes = stored(near.groupBy("cluster").agg((F.sum("n") > MOST_SHINGLES).alias("large")), "sizes")
    sized = near.join(sizes, "cluster")
    whole = sized.filter("not large").select("key", "row_key", "cluster", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(None).cast("boolean").alias("asks"))
    if sizes.filter("large").isEmpty():
        return components(_linked(rows, whole, like))
    large = sized.filter("large").drop("large")
    picks = [F.min_by(F.struct("key", "row_key", "n"), F.xxhash64("key", F.lit(i))) for i in range(PIVOTS)]
    pivots = large.groupBy("cluster").agg(F.array_distinct(F.array(*picks)).alias("pivots"))
    pivots = pivots.select("cluster", F.explode("pivots").alias("pivot")).select("cluster", "pivot.*")
    links = _linked(rows, whole.union(_met(pivots, large)), like)
    roots = components(links)

    # what the pivots of a large cluster have left outside its largest component
    found = large.join(roots, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key"))
    parts = found.groupBy("cluster", "root").agg(F.count("*").alias("n_keys"))
    main = parts.groupBy("cluster").agg(F.max(F.struct("n_keys", "root")).alias("top")).select("cluster", F.col("top.root").alias("main"))
    outside = stored(found.join(main, "cluster").filter("root != main").select("cluster", "key", "row_key", "n"), "outside")
    if outside.isEmpty():
        return roots
    return components(links.union(_linked(rows, _met(outside, large), like)))


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every document.

    Also ``row_key``, the content of ``doc_id`` and ``text`` in 16 bytes, and ``group``, a name of
    the component that stays apart where all ids are null; it is null for an empty set.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("row_key", row_key("doc_id", "text"))
    sketched = stored(
        rows.mapInArrow(_sketch_rows(like), "doc_id long, row_key binary, n_shingles long, set_key binary, sketch binary"), "sketches"
    )
    classes = stored(
        sketched.filter("set_key is not null")
        .groupBy(F.col("set_key").alias("key"))
        .agg(F.min("row_key").alias("row_key"), F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch")),
        "classes",
    )
    # the registers of a band, as they lie in the sketch
    width = 2 * like.rows
    parts = F.transform(F.sequence(F.lit(0), F.lit(like.bands - 1)), lambda i: F.substring("sketch", i * width + 1, F.lit(width)))
    bands = classes.select("key", F.posexplode(parts).alias("band", "part"))
    bands = bands.select("key", F.xxhash64("band", "part").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n_keys"), F.min("key").alias("cluster")).filter("n_keys > 1")
    members = stored(bands.join(shared, "bucket").select("cluster", "key").distinct(), "clusters")
    roots = _components(rows, classes, members, like)

    placed = classes.select("key", "first_id").join(roots, F.col("key") == F.col("node"), "left")
    placed = placed.select("key", "first_id", F.coalesce("root", "key").alias("root"))
    ids = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_set = placed.join(ids, "root").select(F.col("key").alias("set_key"), "component_id", F.col("root").alias("group"))
    out = sketched.select("doc_id", "n_shingles", "row_key", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), "row_key", "group")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Likeness(shingle=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
