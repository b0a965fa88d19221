"""Operator 3: sharding by jump consistent hashing, with DataFrame functions only.

The shard is a function of the key and the number of shards: a 64-bit linear congruential
generator, seeded with the key, jumps through ever higher shard numbers and the last one below the
shard count stands.  With one shard more, a key either stays or goes to the new shard, so about
1/(n+1) of the rows move.  The generator's product is taken in 16- and 32-bit parts, since a
64-bit product that wraps is an error under ANSI arithmetic.

Slots number the rows of a shard without gaps.  Each shard is cut into ranges of a hash of the
whole row, about ``range_rows`` rows each; the ranges' row counts give each its first slot, and
rows are numbered within their range.  Rows that agree in all columns are counted before the
shuffle and get consecutive slots; the rows themselves meet their slots by a hash of their content,
so texts are shuffled once.

Defined cases: a null ``doc_id`` is key 0; a null text has size 1 and checksum 0; repeated rows get
a slot each; an empty table gives no rows; other columns stay.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType

from millrace.llm.components import stored

SHARDS = 8
RANGE_ROWS = 4096

MULTIPLIER = 2862933555777941757
_LOW32, _LOW16 = 0xFFFFFFFF, 0xFFFF


def _next_state(low: Column, high: Column) -> tuple[Column, Column]:
    """The generator's next state, as two unsigned 32-bit halves."""
    m_low, m_high = MULTIPLIER & _LOW32, MULTIPLIER >> 32

    def part(x: Column, mask: int) -> Column:
        return x.bitwiseAND(F.lit(mask).cast("long"))

    one, two = part(low, _LOW16) * F.lit(m_low), F.shiftrightunsigned(low, 16) * F.lit(m_low)
    bottom = one + F.shiftleft(part(two, _LOW16), 16) + F.lit(1)
    high_one = part(high, _LOW16) * F.lit(m_low)
    high_two = F.shiftleft(part(F.shiftrightunsigned(high, 16) * F.lit(m_low), _LOW16), 16)
    top = (
        F.shiftrightunsigned(bottom, 32)
        + F.shiftrightunsigned(two, 16)
        + part(low * F.lit(m_high), _LOW32)
        + part(high_one, _LOW32)
        + part(high_two, _LOW32)
    )
    return part(bottom, _LOW32), part(top, _LOW32)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a 64-bit key.  A jump goes up by one at least, so ``shards`` steps are enough."""
    key = key.cast("long")
    start = F.struct(
        F.lit(-1).cast("long").alias("at"),
        F.lit(0).cast("long").alias("to"),
        key.bitwiseAND(F.lit(_LOW32)).alias("low"),
        F.shiftrightunsigned(key, 32).alias("high"),
    )

    def jump(state: Column, _: Column) -> Column:
        low, high = _next_state(state["low"], state["high"])
        span = (F.shiftrightunsigned(high, 1) + 1).cast("double")
        to = F.floor((state["to"] + 1).cast("double") * (F.lit(float(1 << 31)) / span))
        moved = F.struct(state["to"].alias("at"), to.alias("to"), low.alias("low"), high.alias("high"))
        return F.when(state["to"] < shards, moved).otherwise(state)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, jump, lambda state: state["at"].cast("int"))


def _content(docs: DataFrame) -> Column:
    """16 bytes that name a row by the content of all its columns."""
    parts = []
    for field in docs.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            value = F.to_json(value)
        else:
            value = F.hex(value) if isinstance(field.dataType, BinaryType) else value.cast("string")
        parts += [F.coalesce(F.length(value).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(value, F.lit(""))]
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def shard_rows(docs: DataFrame, shards: int = SHARDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard``.

    All columns of ``docs`` stay; these five names must be free.
    """
    text = F.col("text").cast("string")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    sized = docs.select(
        _content(docs).alias("content"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        jump_shard(key, shards).alias("shard"),
        jump_shard(key, shards + 1).alias("grown_shard"),
    )
    rows = ["doc_id", "size", "text_crc32", "shard", "grown_shard"]
    kinds = sized.groupBy("content", *rows).agg(F.count("*").alias("n"))
    kinds = kinds.withColumn("mark", F.xxhash64("doc_id", "size", "text_crc32"))
    kinds = stored(kinds, "sharded")
    total = kinds.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-total // (range_rows * shards)))
    ranged = kinds.withColumn("range", F.pmod("mark", F.lit(ranges)))
    counts = ranged.groupBy("shard", "range").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("shard", "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "range").orderBy("mark", "doc_id", "size", "text_crc32", "content")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("ahead", F.coalesce(F.sum("n").over(within), F.lit(0)))
    placed = placed.join(firsts, ["shard", "range"])
    slot = F.col("first") + F.col("ahead")
    placed = placed.select("content", *rows[1:], slot.alias("from"), (slot + F.col("n") - 1).alias("to"))
    # equal rows are one until they get their slots; the join finds its rows dealt by content
    whole = docs.select(_content(docs).alias("content"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = whole.groupBy("content").agg(F.first("row").alias("row")).join(placed, "content")
    return whole.select("row.*", *rows[1:], F.explode(F.sequence("from", "to")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the rows in folders by shard; each task has a range of a shard's slots."""
    shard_rows(docs, shards).repartitionByRange("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
