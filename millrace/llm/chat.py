"""Operator 8: chat formatting by linking quotations to the messages they quote.

1. *Parse.*  A line's level is its number of leading ``>``.  Level 0 is the message's own text;
   the attribution line above a quotation belongs to the quotation.
2. *Hash.*  Passages are normalised (case and white space).  A message can be quoted as its own
   text, as that with what it quotes itself, and so on down its levels; each of these chains gets a
   key, and so does each of its own lines.  A reply is looked up by the chain of all it quotes, so
   equal short messages are told apart by what they answer.  If no smaller id has that chain, the
   quoted lines vote, each for all messages with a smaller id that hold it.
3. *Join.*  The original of a chain is the last message before the reply that has it, so that conversations
   with equal openings stay apart.  An as-of join finds it: ids are numbered, chains and replies of one key are
   sorted by number and the last chain is carried forward; a key that a third of all messages repeat
   is cut into slices.
4. *Order.*  Replies point to smaller ids only, so links make trees.  Pointer doubling finds root
   and depth; positions come from one global sort by root, depth and id.

Defined cases: null and empty texts have no own text and no quotation, and are conversations of
their own; a message of quotations alone can reply but not be quoted; a quotation that no smaller
id explains is dropped and leaves a root; rows of equal id take the smallest parent found for
them, and a place each; a null id has a null conversation and no parent; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
from hashlib import md5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.llm.blocks import pieces, ship
from millrace.llm.components import stored
from millrace.llm.ordering import numbered
from millrace.operators.asof import asof_join

ship(__name__)

# Lines that more messages hold are counted for sets of lines, not for single quotations.
COMMON = 100

QUOTE = re.compile(r"(?:> ?)+")
ATTRIBUTION = re.compile(r"\b(?:wrote|schrieb|a écrit|escribió)\s?:$", re.IGNORECASE)


def parse(text: str | None) -> tuple[str, list[str]]:
    """Own text, and the quoted text of level 1, 2 and so on."""
    levels: dict[int, list[str]] = {}
    lines = [(len(m[0].replace(" ", "")), line[m.end() :]) if (m := QUOTE.match(line)) else (0, line) for line in (text or "").split("\n")]
    for i, (level, line) in enumerate(lines):
        if i + 1 < len(lines) and lines[i + 1][0] > level and ATTRIBUTION.search(line.rstrip()):
            continue
        levels.setdefault(level, []).append(line)
    own = "\n".join(levels.pop(0, [])).strip()
    return own, ["\n".join(levels[level]).strip() for level in sorted(levels)]


def normal(passage: str) -> str:
    return " ".join(passage.casefold().split())


def _key(*passages: str) -> bytes:
    return md5("\0".join(passages).encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()


def _line_keys(passage: str) -> list[bytes]:
    return [_key("line", normal(line)) for line in passage.split("\n") if line.strip()]


def _parsed_rows(batches):
    for batch in batches:
        for part in pieces(batch):
            out = {"own": [], "known": [], "quoted": [], "own_lines": [], "quoted_lines": []}
            for text in part.column("text").to_pylist():
                own, quotes = parse(text)
                quotes = [q for q in quotes if q]
                chain = [normal(own), *map(normal, quotes)]
                out["own"].append(own)
                out["known"].append([_key(*chain[:n]) for n in range(1, len(chain) + 1)] if chain[0] else [])
                out["quoted"].append(_key(*chain[1:]) if quotes else None)
                out["own_lines"].append(_line_keys(own))
                out["quoted_lines"].append(_line_keys(quotes[0]) if quotes else [])
            kinds = [pa.string(), pa.list_(pa.binary()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
            arrays = [pa.array(column, kind) for column, kind in zip(out.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("msg_id"), *arrays], ["msg_id", *out])


def _voted(parsed: DataFrame, asked: DataFrame, common: int) -> DataFrame:
    """``msg_id`` and ``parent_id``: the smaller id that holds most of the quoted lines, then the smallest.

    Equal quotations are counted once, and of the ids with the same number of lines only the smallest
    goes on.  A line of up to ``common`` messages names them all; what such a candidate holds of the
    commoner lines is looked up.  Candidates of the commoner lines alone are the same for all
    quotations with the same ones of these, so they are counted once for each such set.
    """
    quote = F.unhex(F.md5(F.array_join(F.transform("quoted_lines", F.hex), "").cast("binary"))).alias("quote")
    asked = stored(asked.select("msg_id", "quoted_lines", quote), "asked")
    if asked.isEmpty():
        return asked.select("msg_id", F.col("msg_id").alias("parent_id"))
    quotes = asked.dropDuplicates(["quote"]).select("quote", F.explode("quoted_lines").alias("key"))
    quotes = quotes.groupBy("quote", "key").agg(F.count("*").alias("n"))
    held = parsed.filter("msg_id is not null").select(F.col("msg_id").alias("parent_id"), F.explode("own_lines").alias("key")).distinct()
    held = stored(held.join(quotes.select("key").distinct(), "key", "left_semi"), "held")
    holders = held.groupBy("key").agg((F.count("*") > common).alias("common"))
    quotes = stored(quotes.join(holders, "key"), "quotes")
    rare, often = quotes.filter("not common").drop("common"), quotes.filter("common").drop("common")
    named = stored(rare.join(held, "key").groupBy("quote", "parent_id").agg(F.sum("n").alias("n")), "named")
    more = named.select("quote", "parent_id").join(often, "quote").join(held, ["parent_id", "key"]).select("quote", "parent_id", "n")
    votes = named.unionByName(more).groupBy("quote", "parent_id").agg(F.sum("n").alias("n"))
    # the sets are named by their lines and how often each is quoted
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", "n"))), lambda x: F.concat_ws(":", F.hex(x["key"]), x["n"].cast("string"))), " ")
    sets = stored(often.groupBy("quote").agg(F.unhex(F.md5(lines.cast("binary"))).alias("set")), "sets")
    in_sets = often.join(sets.groupBy("set").agg(F.min("quote").alias("quote")), "quote")
    of_sets = in_sets.join(held, "key").groupBy("set", "parent_id").agg(F.sum("n").alias("n"))
    of_sets = of_sets.groupBy("set", "n").agg(F.min("parent_id").alias("parent_id"))
    firsts = votes.groupBy("quote", "n").agg(F.min("parent_id").alias("parent_id"))
    firsts = firsts.unionByName(of_sets.join(sets, "set").select("quote", "n", "parent_id"))
    earlier = asked.select("msg_id", "quote").join(firsts, "quote").filter("parent_id < msg_id")
    # most lines first, then the smallest id: the largest count with the least id
    best = earlier.groupBy("msg_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "parent_id")).alias("best"))
    return best.select("msg_id", "best.parent_id")


def _parents(parsed: DataFrame, common: int) -> DataFrame:
    """``msg_id`` and ``parent_id`` of the messages whose quotation has an original."""
    # numbers in the order of ids stand for times
    ids = numbered(parsed.select("msg_id").filter("msg_id is not null").distinct(), "msg_id")
    ids = ids.select("msg_id", F.timestamp_micros("place").alias("number"))
    known = parsed.select(F.explode("known").alias("key"), "msg_id").join(ids, "msg_id")
    known = known.select("key", F.col("number").alias("its_number"), F.col("msg_id").alias("parent_id"))
    asked = parsed.filter("quoted is not null").select("msg_id", F.col("quoted").alias("key"), "quoted_lines").join(ids, "msg_id")
    asked = stored(asof_join(asked, known, "key", "number", "its_number", strict=True), "originals")
    whole = asked.filter("parent_id is not null").select("msg_id", "parent_id")
    voted = _voted(parsed, asked.filter("parent_id is null").select("msg_id", "quoted_lines"), common)
    # rows of one id may have several
    return whole.union(voted).groupBy("msg_id").agg(F.min("parent_id").alias("parent_id"))


def _trees(links: DataFrame) -> DataFrame:
    """``msg_id``, ``root`` and ``depth``: every round doubles the way gone.

    A message whose way has come to a root is settled and takes no part in further rounds.
    """
    settled, active = links.filter("depth = 0"), links.filter("depth > 0")
    while True:
        known = settled.unionByName(active)
        up = known.select(F.col("msg_id").alias("over"), F.col("root").alias("over_root"), F.col("depth").alias("over_depth"))
        further = active.join(up, active["root"] == up["over"])
        moved = stored(
            further.select("msg_id", F.col("over_root").alias("root"), (F.col("depth") + F.col("over_depth")).alias("depth"), (F.col("over_depth") == 0).alias("done")),
            "trees",
        )
        settled = settled.unionByName(moved.filter("done").drop("done"))
        active = moved.filter("not done").drop("done")
        if active.isEmpty():
            return settled


def build_conversations(messages: DataFrame, common: int = COMMON) -> DataFrame:
    """Reply-ordered conversations of ``messages`` (``msg_id``, any ordered type, and ``text``).

    Returns ``msg_id``, ``conversation_id`` (the root's id), ``parent_id``, ``depth``, ``position``
    in the conversation from 0, and ``own_text``, the text without quotations.  ``common`` chooses how
    lines are counted, not what is found.
    """
    kind = messages.schema["msg_id"].dataType.simpleString()
    rows = messages.select("msg_id", F.col("text").cast("string").alias("text"))
    parsed = rows.mapInArrow(
        _parsed_rows, f"msg_id {kind}, own string, known array<binary>, quoted binary, own_lines array<binary>, quoted_lines array<binary>"
    )
    parsed = stored(parsed, "parsed")
    parents = stored(_parents(parsed, common), "parents")
    ids = parsed.select("msg_id").filter("msg_id is not null").distinct()
    links = ids.join(parents, "msg_id", "left")
    links = links.select("msg_id", F.coalesce("parent_id", "msg_id").alias("root"), F.when(F.col("parent_id").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    trees = _trees(stored(links, "links"))
    placed = parsed.select("msg_id", F.col("own").alias("own_text")).join(trees, "msg_id", "left").join(parents, "msg_id", "left")
    placed = placed.select("msg_id", F.col("root").alias("conversation_id"), "parent_id", F.coalesce("depth", F.lit(0)).alias("depth"), "own_text")
    placed = numbered(placed, "conversation_id", "depth", "msg_id")
    firsts = placed.groupBy("conversation_id").agg(F.min("place").alias("first"))
    firsts = firsts.withColumnRenamed("conversation_id", "of")
    found = placed.join(firsts, placed["conversation_id"].eqNullSafe(firsts["of"]))
    return found.select("msg_id", "conversation_id", "parent_id", "depth", (F.col("place") - F.col("first")).alias("position"), "own_text")


def quoting_messages(conversations: DataFrame) -> DataFrame:
    """The turns as mail: each quotes the turn before it, and what that one answered, one level deeper."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.select("*", *[F.lag("text", n).over(order).alias(f"before{n}") for n in (1, 2)], F.lag("role").over(order).alias("sender"))
    number = lambda c: F.lpad(F.coalesce(F.col(c).cast("string"), F.lit("-")), 20, "0")
    quote = lambda c, mark: F.regexp_replace(F.col(c), "(?m)^", mark)
    head = F.concat(F.coalesce("sender", F.lit("someone")), F.lit(" wrote:"))
    text = F.concat_ws("\n", F.when(F.col("before1").isNotNull(), head), quote("before2", ">> "), quote("before1", "> "), F.col("text"))
    return turns.select(F.concat(number("conv_id"), F.lit("/"), number("turn")).alias("msg_id"), text.alias("text"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations found again from mail that quotes, without looking at ``conv_id`` and ``turn``."""
    found = build_conversations(quoting_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return found.select(
        "msg_id", "conversation_id", "parent_id", "depth", "position", F.sha2(F.col("own_text").cast("binary"), 256).alias("own_sha256")
    )
