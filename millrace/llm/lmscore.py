"""Operator 13: log probabilities of documents under a trigram model in Elias-Fano tries.

1. *Words.*  Tasks cut the documents into pieces of about 8 MB and write each with word numbers of its own, in a
   table bucketed by piece.  The pieces ask for their words: buckets of words by a hash sum the counts of
   all pieces, give ids to those that training documents hold, and answer with ids and counts.
2. *Tries.*  Every piece sends its distinct trigrams, each with its count in training documents, to the shard of
   the middle word; one that is there more than ``split`` times is dealt by its successors over several
   shards.  A shard builds its trie from the trigrams that were counted, and looks up all that the
   pieces sent through the trie's flat levels.
3. *Scoring.*  The codes go back to the pieces, which add them up by document.  A pair of words comes back with the
   weight it has as the context of the next word, as in a backoff model, so no shard needs to know its contexts' totals.

The probabilities are hierarchical Dirichlet estimates: with prior weights q2 and q3,
p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)), p(w|v) = (c(vw) + q2 p(w)) / (c(v) + q2),
p(w|uv) = (c(uvw) + q3 p(w|v)) / (c(uv) + q3).  They sum to one over all words and one unknown word;
logarithms that come from a trie are rounded to steps of 1/1024.  Two begin marks
stand before each document, in contexts only.

All trigrams of one pair of middle and last words meet in one shard, one row for each piece and first word.

Defined cases: null, empty and blank texts are the end token alone; a null ``held_out`` counts as false; repeated
rows and null ids are documents of their own; without training documents all probabilities are 1, for the unknown
word is the only one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.blocks import WordBlock, mixed, pieces, ship
from millrace.llm.components import stored
from millrace.llm.eliasfano import OPEN, Trie, grouped, logarithm
from millrace.session import scratch_dir

ship(__name__)
ship("millrace.llm.eliasfano")

PIECE_BYTES = 8 << 20
# Tokens of the corpus for each shard of trigrams, and for each bucket of words.
SHARD_TOKENS = 500_000
WORD_TOKENS = 4_000_000
SPLIT = 250_000
PRIOR2 = 500.0
PRIOR3 = 5.0
# Bytes of a word's key: a hash of 80 bits.
KEY = 10
# Key of the end token; the keys of words are hashes of words without blanks.
END = b"\xff" * KEY
# Bytes in which numbers are sent.
WIDTH = 6


def _packed(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, compressed: the high ones are mostly alike."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    wide = np.zeros((n, 8), np.uint8)
    if n:
        wide[:, :WIDTH] = np.frombuffer(pa.Codec("zstd").decompress(data[8:], n * WIDTH), np.uint8).reshape(WIDTH, n).T
    return wide.view("<u8").ravel().astype(np.int64)


def _joined(parts) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *map(_unpacked, parts)])


def _piece_rows(piece_bytes: int, buckets: int):
    one_row = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, size=piece_bytes):
                block = WordBlock(part.column("text").to_pylist(), lower=True)
                size = block.counts + 1
                inner = np.ones(int(size.sum()), bool)
                inner[np.cumsum(size) - 1] = False
                tokens = np.full(len(inner), len(block.digests), np.int64)
                tokens[inner] = block.ids
                training = np.repeat(~part.column("held_out").to_numpy(zero_copy_only=False), size)
                keys = np.concatenate([block.digests.view(np.uint8).reshape(-1, 16)[:, :KEY], np.frombuffer(END, np.uint8)[None]])
                bucket = np.ascontiguousarray(keys[:, :8]).view("<u8").ravel() % np.uint64(buckets)
                often = np.bincount(tokens, minlength=len(keys))
                # by bucket, and frequent words first: their numbers are small
                order = np.lexsort((-often, bucket))
                number = np.empty(len(order), np.int64)
                number[order] = np.arange(len(order))
                tokens = number[tokens]
                n = np.bincount(tokens[training], minlength=len(keys))
                held = np.bincount(bucket.astype(np.int64), minlength=buckets)
                lists = [one_row(pa.array(x)) for x in (part.column("doc_id"), part.column("held_out"), size, held)]
                data = [pa.array([x], pa.binary()) for x in (_packed(tokens), keys[order].tobytes(), _packed(n))]
                yield pa.RecordBatch.from_arrays([*lists, *data], ["doc_id", "held_out", "size", "held", "tokens", "keys", "n"])

    return run


def _asked_words(batches):
    """A row for each bucket that the piece has words of."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ends, n = np.cumsum(row["held"]).tolist(), _unpacked(row["n"])
            cuts = [(b, e - k, e) for b, (k, e) in enumerate(zip(row["held"], ends, strict=True)) if k]
            columns = [
                pa.array([b for b, _, _ in cuts], pa.int32()), pa.array([row["piece"]] * len(cuts), pa.int64()),
                pa.array([row["keys"][a * KEY : e * KEY] for _, a, e in cuts], pa.binary()), pa.array([_packed(n[a:e]) for _, a, e in cuts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "piece", "keys", "n"])


WORDS = "piece long, part int, ids binary, counts binary, words long, tokens long, documents long"


def _named_words(buckets: int):
    """Ids and counts of the words that every piece asked for; and a row without a piece, of the bucket's totals."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint8).reshape(-1, KEY)
        high = np.ascontiguousarray(keys[:, :8]).view("<u8").ravel()
        low = np.ascontiguousarray(keys[:, 8:]).view("<u2").ravel()
        order = np.lexsort((low, high))
        new = np.append(True, (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0))[: len(order)]
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        asked = [_unpacked(x) for x in table["n"].to_pylist()]
        count = np.bincount(of, np.concatenate(asked)).astype(np.int64)
        rank = np.empty(len(count), np.int64)
        rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
        bucket = table["bucket"][0].as_py()
        ids = np.where(count > 0, rank * buckets + bucket, -1)
        ends = (keys == np.frombuffer(END, np.uint8)).all(1)
        documents = int(count[of[ends][0]]) if ends.any() else 0
        edge, rows = 0, []
        for piece, n in zip(table["piece"].to_pylist(), asked, strict=True):
            mine = of[edge : edge + len(n)]
            edge += len(n)
            rows.append((piece, bucket, _packed(ids[mine] + 1), _packed(count[mine]), 0, 0, 0))
        rows.append((-1, bucket, b"", b"", int((count > 0).sum()), int(count.sum()), documents))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["piece", "part", "ids", "counts", "words", "tokens", "documents"]
        return pa.table([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


class _Model:
    """What every task knows: totals of the training tokens, ids beyond the words', and where trigrams are dealt."""

    def __init__(self, tokens: int, words: int, documents: int, ids: int, shards: int, split: int, prior2: float, prior3: float):
        self.tokens, self.words, self.documents = tokens, words, documents
        self.begin, self.unknown = ids, ids + 1
        self.shards, self.split, self.prior2, self.prior3 = shards, split, prior2, prior3

    def own(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.1) / (self.tokens + 0.1 * (self.words + 1))

    def shard(self, middle: np.ndarray, middle_count: np.ndarray, last: np.ndarray) -> np.ndarray:
        parts = (1 + middle_count // self.split).astype(np.uint64)
        part = mixed(last.astype(np.uint64) + np.uint64(1)) % parts
        key = mixed(middle.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + part)
        return (key % np.uint64(self.shards)).astype(np.int64)


class _Piece:
    """A piece's distinct trigrams by shard; ``of`` has each token's, in the piece's order of tokens."""

    def __init__(self, row: dict, words: pa.Table, model: _Model):
        self.row = row
        words = words.sort_by("part")
        ids, counts = _joined(words["ids"].to_pylist()) - 1, _joined(words["counts"].to_pylist())
        local = _unpacked(row["tokens"])
        self.size = np.array(row["size"], np.int64)
        self.count = counts[local]
        # words by id; all unknown ones are one
        ids = np.concatenate([np.where(ids < 0, model.unknown, ids), [model.begin]])
        counts = np.append(counts, model.documents)
        at, rank = grouped(ids)
        ids, counts, local, begin = ids[at], counts[at], rank[local], rank[-1]
        k, start = len(ids), np.repeat(np.cumsum(self.size) - self.size, self.size)
        place = np.arange(len(local))
        middle = np.where(place - 1 >= start, np.roll(local, 1), begin)
        first = np.where(place - 2 >= start, np.roll(local, 2), begin)
        pair = middle * k + local
        if k >= 1 << 21:
            pair = grouped(pair)[1]
        at, of = grouped(pair * k + first)
        self.first, self.middle, self.last = ids[first[at]], ids[middle[at]], ids[local[at]]
        self.total, self.last_count = counts[middle[at]], counts[local[at]]
        held_out = np.array([bool(x) for x in row["held_out"]])
        self.n = np.bincount(of[np.repeat(~held_out, self.size)], minlength=len(at))
        shard = model.shard(self.middle, self.total, self.last)
        # nothing follows a word that training documents lack, and they have no pair with such a word
        shard[(self.middle == model.unknown) | (self.last == model.unknown)] = model.shards
        order = np.argsort(shard, kind="stable")
        new = np.empty(len(order), np.int64)
        new[order] = np.arange(len(order))
        self.of = new[of]
        for name in PARTS:
            setattr(self, name, getattr(self, name)[order])
        self.shard = shard[order]

    def by_shard(self, shards: int):
        asked = self.shard[: np.searchsorted(self.shard, shards)]
        edges = np.append(np.flatnonzero(np.diff(asked, prepend=-1)), len(asked)).tolist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield int(asked[a]), slice(a, b)


PARTS = ("first", "middle", "last", "n", "total", "last_count")
SENT = "shard int, piece long, " + ", ".join(f"{x} binary" for x in PARTS)


def _sent(model: _Model):
    schema = pa.schema([("shard", pa.int32()), ("piece", pa.int64()), *[(x, pa.binary()) for x in PARTS]])

    def run(key, cut: pa.Table, words: pa.Table) -> pa.Table:
        (row,) = cut.to_pylist()
        piece = _Piece(row, words, model)
        found = list(piece.by_shard(model.shards))
        columns = [[s for s, _ in found], [row["piece"]] * len(found)]
        columns += [[_packed(getattr(piece, name)[part]) for _, part in found] for name in PARTS]
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, schema.types, strict=True)], schema=schema)

    return run


ANSWERS = "piece long, part int, codes binary, weights binary"


def _answers(model: _Model):
    schema = pa.schema([("piece", pa.int64()), ("part", pa.int32()), ("codes", pa.binary()), ("weights", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        # the trie must not depend on the order in which the rows came
        table = table.sort_by("piece")
        asked = [_unpacked(x) for x in table["n"].to_pylist()]
        first, middle, last, total, last_count = (_joined(table[c].to_pylist()) for c in PARTS if c != "n")
        pair = grouped(middle * (model.unknown + 1) + last)[1] if model.unknown < 1 << 31 else np.unique(np.stack([middle, last], 1), axis=0, return_inverse=True)[1].ravel()
        before = grouped(first)[1]
        at, of = grouped(pair * (int(before.max()) + 1) + before)
        count = np.bincount(of, np.concatenate(asked), len(at))
        seen = at[count > 0]
        trie = Trie(Trie.build(first[seen], middle[seen], last[seen], count[count > 0], model.own(last_count[seen]), total[seen], model.prior2, model.prior3))
        codes, weights = (x[of] for x in trie.codes(first[at], middle[at], last[at]))
        edges = np.cumsum([0, *map(len, asked)]).tolist()
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
        shard = pa.array(np.full(len(asked), table["shard"][0].as_py(), np.int32))
        return pa.table([table["piece"], shard, cut(codes), cut(weights)], schema=schema)

    return run


def _scored(model: _Model):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ])

    def run(key, cut: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = cut.to_pylist()
        is_word = answers["codes"].is_null()
        piece = _Piece(row, answers.filter(is_word), model)
        found = {r["part"]: r for r in answers.filter(pc.invert(is_word)).to_pylist()}
        codes, weights = (np.full(len(piece.shard), OPEN, np.uint16) for _ in range(2))
        for shard, part in piece.by_shard(model.shards):
            codes[part] = np.frombuffer(found[shard]["codes"], np.uint16)
            weights[part] = np.frombuffer(found[shard]["weights"], np.uint16)
        # a pair that was not seen: the middle word's weight, and the last one's own probability
        lower = np.log10(model.prior2 / (piece.total + model.prior2)) + np.log10(model.own(piece.last_count))
        value = np.where(codes == OPEN, lower, logarithm(codes))[piece.of]
        weight = np.where(weights == OPEN, 0.0, logarithm(weights))[piece.of]
        # a token's context is the pair that ends with the token before it
        first = np.cumsum(piece.size) - piece.size
        context = np.roll(weight, 1)
        context[first] = np.log10(model.prior3 / (model.documents + model.prior3))
        add = lambda x: np.add.reduceat(x, first)
        return pa.table([
            pa.array(row["doc_id"], pa.int64()), pa.array(row["held_out"]), piece.size, add((piece.count > 0).astype(np.int64)),
            np.full(len(first), model.tokens), add(np.log10(model.own(piece.count))), add(context + value),
        ], schema=schema)

    return run


def _bucketed(df: DataFrame, column: str) -> DataFrame:
    """``df`` written in as many buckets as there are shuffle partitions: groups by ``column`` need no shuffle of it."""
    spark, name = df.sparkSession, f"pieces_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).format("parquet").option("path", scratch_dir(spark, "pieces")).saveAsTable(name)
    found = spark.table(name)
    # an external table: its files stay as long as the scratch folder does
    found.schema, spark.sql(f"DROP TABLE {name}")
    return found


def score_documents(
    docs: DataFrame, prior2: float = PRIOR2, prior3: float = PRIOR3, piece_bytes: int = PIECE_BYTES,
    shard_tokens: int = SHARD_TOKENS, word_tokens: int = WORD_TOKENS, split: int = SPLIT,
) -> DataFrame:
    """Scores of all ``docs`` (``doc_id``, ``text``, ``held_out``), learned from those that are not held out.

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens that training documents have),
    ``train_tokens``, ``base_score`` (of words alone) and ``score``, both log10 probabilities.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("held_out"), F.lit(False)).alias("held_out"),
    )
    # a token has two bytes at least, five or so in prose
    buckets = -(-max(1, rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (5 * word_tokens))
    cut = rows.mapInArrow(
        _piece_rows(piece_bytes, buckets),
        "doc_id array<long>, held_out array<boolean>, size array<long>, held array<long>, tokens binary, keys binary, n binary",
    )
    cut = _bucketed(cut.withColumn("piece", F.monotonically_increasing_id()), "piece")
    asked = cut.select("piece", "held", "keys", "n").mapInArrow(_asked_words, "bucket int, piece long, keys binary, n binary")
    words = stored(asked.groupBy("bucket").applyInArrow(_named_words(buckets), WORDS), "words")
    totals = words.filter("piece < 0").agg(F.sum("tokens"), F.sum("words"), F.max("documents"), F.max("words")).first()
    all_tokens = cut.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    model = _Model(
        totals[0] or 0, totals[1] or 0, totals[2] or 0, (totals[3] or 0) * buckets, -(-max(all_tokens, 1) // shard_tokens), split, prior2, prior3
    )
    named = words.filter("piece >= 0").select("piece", "part", "ids", "counts")
    texts = cut.select("piece", "doc_id", "held_out", "size", "tokens").groupBy("piece")
    sent = texts.cogroup(named.groupBy("piece")).applyInArrow(_sent(model), SENT)
    answers = sent.groupBy("shard").applyInArrow(_answers(model), ANSWERS)
    both = named.unionByName(answers, allowMissingColumns=True)
    return texts.cogroup(both.groupBy("piece")).applyInArrow(
        _scored(model), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability, with a tenth of the documents held out from training."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return score_documents(docs.select("doc_id", "text", held_out.alias("held_out")))
