"""Exact dedup by deterministic block naming, in DataFrame functions alone.

A normalised text is cut into blocks of fixed size. The distinct blocks are
sorted and named by integers; two blocks have one name only if their bytes
are equal. Then adjacent names are paired and the distinct pairs named, level
by level, until one name stands for the whole text. A document's identity is
(level, name): equal for equal texts, different for different ones.

Text crosses the network once, to find the distinct blocks. Every occurrence
then looks up its name by a 64-bit hash of the block; hashes that two
different blocks share are found while naming, and their occurrences are
looked up by the block itself.

Nulls and ties: a null text counts as empty, and empty texts are equal to
each other. A null doc_id is larger than any other. Rows that repeat both
doc_id and text count once each in group_size; one of them stays at most.
An empty table gives an empty result; columns beside doc_id and text are not
looked at, and pass through ``deduplicate``, where of rows that repeat both
doc_id and text the least one by all columns stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .common import SPACES, one_spaced, table

#: Bytes in a block.
BLOCK = 512
KEY = ["doc_id", "text_hash"]
#: Places over which the rows of a group of copies are spread.
SALTS = 16


def _same(left: str, right: str, names: list[str]) -> Column:
    out = F.lit(True)
    for c in names:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _blocks(text: Column, block: int) -> Column:
    """The blocks of a text as an array; an empty text is one empty block."""
    last = F.greatest(F.ceil(F.octet_length(text) / block) - 1, F.lit(0)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text.cast("binary"), i * block + 1, F.lit(block))
    )


def _block_names(docs: DataFrame, block: int, block_hash: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, rows, text_sha256) and (doc_id, text_hash, n, at,
    name): the distinct texts of each id, and the name of each of their n blocks."""
    texts = docs.select("doc_id", one_spaced(F.col("text")).alias("_text"))
    cut = _blocks(F.col("_text"), block)
    sha = F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256")
    occurring = texts.select("doc_id", F.xxhash64("_text").alias("text_hash"), sha, F.transform(cut, lambda b: block_hash(b)).alias("bh"))
    occurring = stage(
        occurring.groupBy("doc_id", "text_hash", "text_sha256", "bh").agg(F.count(F.lit(1)).alias("rows")), "occurring"
    )
    at = occurring.select(*KEY, F.size("bh").alias("n"), F.posexplode("bh").alias("at", "bh"))

    blocks = texts.select(F.explode(cut).alias("block")).select(block_hash(F.col("block")).alias("bh"), "block")
    named = blocks.groupBy("bh", "block").agg(F.count(F.lit(1)).alias("times")).sortWithinPartitions("block")
    named = named.select("bh", F.monotonically_increasing_id().alias("name"))
    by_hash = stage(named.groupBy("bh").agg(F.count(F.lit(1)).alias("blocks"), F.min("name").alias("name")), "blocks")
    out = at.join(by_hash.where("blocks = 1").select("bh", "name"), "bh").select(*KEY, "n", "at", "name")
    shared = by_hash.where("blocks > 1").select("bh")
    if not shared.isEmpty():
        # Blocks whose hash is not theirs alone get names below all others.
        clash = blocks.join(shared, "bh", "left_semi").groupBy("bh", "block").agg(F.count(F.lit(1)).alias("times"))
        clash = clash.sortWithinPartitions("block").withColumn("name", -2 - F.monotonically_increasing_id())
        clash = stage(clash.select("bh", "block", "name"), "clashes")
        texts_at = texts.select("doc_id", F.xxhash64("_text").alias("text_hash"), F.posexplode(cut).alias("at", "block"))
        texts_at = texts_at.withColumn("bh", block_hash(F.col("block")))
        n = occurring.select(*KEY, F.size("bh").alias("n")).alias("n")
        found = texts_at.join(clash, ["bh", "block"]).select(*KEY, "at", "name").distinct().alias("f")
        out = out.unionByName(found.join(n, _same("f", "n", KEY)).select("f.doc_id", "f.text_hash", "n.n", "f.at", "f.name"))
    return occurring.drop("bh"), out


def identities(
    docs: DataFrame, block: int = BLOCK, block_hash: Callable[[Column], Column] = F.xxhash64
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, rows, text_sha256) and (doc_id, text_hash, level,
    name), one row each for each distinct (doc_id, text) of ``docs``."""
    rows, names = _block_names(docs, block, block_hash)
    names = stage(names, "names0")
    longest = names.agg(F.max("n")).first()[0] or 1
    level, done = 0, None
    while True:
        # A text is finished when one name is left of it.
        single = names.where("n = 1").select(*KEY, F.lit(level).alias("level"), "name")
        done = single if done is None else done.unionByName(single)
        if longest == 1:
            return rows, done
        odd = F.col("at") % 2 == 1
        pairs = (
            names.where("n > 1")
            .groupBy(*KEY, F.shiftright(F.col("n") + 1, 1).alias("n"), F.shiftright("at", 1).alias("at"))
            .agg(F.max(F.when(~odd, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("b"))
        )
        level += 1
        named = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")).sortWithinPartitions("a", "b")
        named = stage(named.withColumn("name", F.monotonically_increasing_id()), f"pairs{level}")
        names = stage(pairs.join(named.select("a", "b", "name"), ["a", "b"]).select(*KEY, "n", "at", "name"), f"names{level}")
        longest = (longest + 1) // 2


def groups(docs: DataFrame, block: int = BLOCK, block_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, text_hash, rows, text_sha256, keep_id, keep_hash, group_size)
    per distinct (doc_id, text)."""
    rows, known = identities(docs, block, block_hash)
    rows, known = rows.alias("r"), known.alias("i")
    rows = stage(rows.join(known, _same("r", "i", KEY)).select("r.*", "i.level", "i.name"), "identities")
    # Equal texts have one hash, so the least id is all there is to find; max and min pass over nulls.
    kept = rows.groupBy("level", "name").agg(F.min("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"), F.count(F.lit(1)).alias("_members"))
    # A row alone in its group needs no join; the others meet their group in one of SALTS places.
    some = kept.where("_members > 1").select("level", "name", "keep_id", F.col("group_size").alias("_size"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(SALTS)).cast("int"))
    found = salted.join(some, ["level", "name", "_salt"], "left")
    alone = F.col("_size").isNull()
    return found.select(
        *KEY,
        "rows",
        "text_sha256",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.col("text_hash").alias("keep_hash"),
        F.coalesce("_size", "rows").alias("group_size"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"))
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    again = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))
    return found.withColumn("_row", again).select(
        "doc_id", "keep_id", "group_size", (first & (F.col("_row") == 1)).alias("kept"), "text_sha256"
    )


def deduplicate(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows that stay, with all their columns."""
    found = groups(docs, block)
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(*KEY, "rows").alias("k")
    names = docs.columns
    d = docs.withColumn("text_hash", F.xxhash64(one_spaced(F.col("text")))).alias("d")
    rows = d.join(stays, _same("d", "k", KEY)).select("d.*", F.col("k.rows").alias("_rows"))
    once = rows.where("_rows = 1")
    if not stays.where("rows > 1").isEmpty():
        every = F.struct(*[F.col(f"`{c}`") for c in names])
        least = rows.where("_rows > 1").groupBy("doc_id", "text_hash").agg(F.min(every).alias("_row"))
        return once.select(*[F.col(f"`{c}`") for c in names]).unionByName(least.select("_row.*"))
    return once.select(*[F.col(f"`{c}`") for c in names])


OP5_SQL = f"""
with d as (
  select doc_id, regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g') as t from documents),
g as (
  select doc_id, t, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from g
"""
