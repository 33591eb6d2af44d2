"""A Merkle manifest of a dataset, and proofs of its rows by octopus multiproofs.

Every row is a leaf: the hash of its columns. Leaves of one group (language)
ascend by id; every ``ARITY`` consecutive nodes become one of the next level
until one is left, the group's subroot. The subroots, ordered by group, become
the root in the same way.

A tree is built in blocks of ``BLOCK`` aligned leaves, each the bottom of one
task's subtree of ``DEPTH`` levels, then of blocks of the nodes left, and so
on; what moves shrinks by ``BLOCK`` every time.

Proofs are made block by block. A block's leaves together need far fewer nodes
than one by one: :func:`missing` lists the coordinates that none of its leaves
can give, the smallest such set. They are fetched once for the block, by a
join with the stored nodes; what its leaves share is derived from them, and
the proof of each leaf is expanded in place, with no further lookup.

Hashes are lower-case hex text of sha256 over the concatenated inputs. A
column's value is hashed with its length before it and a null as ``-``, so no
two rows give the same input.

Nulls and ties: a null group is a group of its own, before all others; null
ids come last in their group; rows of one id are ordered by leaf, and equal
rows are equal leaves beside each other, each with a proof of its own. A group
of one row has its leaf as subroot, and a dataset of one group that subroot as
root. An empty table has no leaves, no root and no proofs. Columns other than
those hashed are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import ranked, table

ARITY = 8
#: Levels that one task builds of its block of leaves.
DEPTH = 4
BLOCK = ARITY**DEPTH
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The number of the tree over the subroots.
TOP = -1
NODES = "tree long, n long, level int, idx long, hash string"


def leaf(values: list[Column]) -> Column:
    """The hash of a row's values."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v), F.lit(":"), v)) for v in text]).cast("binary"), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // ARITY), levels + 1
    return levels


def _height(leaves: Column) -> Column:
    steps = [(F.lit(ARITY**k), k) for k in range(20)]
    first, k = steps[0]
    return reduce(lambda found, step: found.when(leaves <= step[0], step[1]), steps[1:], F.when(leaves <= first, k)).cast("int")


@dataclass(frozen=True)
class Manifest:
    """``leaves``: tree, n, idx, the group, the id, leaf and claimed; ``nodes``:
    tree, level, idx, hash of all that lies above; ``trees``: tree, group, n and
    subroot; the number of trees and the root, None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    groups: int
    root: str | None


def _numbered(rows: DataFrame, group: str, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows with tree, n and idx, and (tree, group, n) per group.

    A range sort lays a group over as many tasks as it needs; the place in a
    task is added to the rows of the group in the tasks before it.
    """
    order = [F.col(group).asc_nulls_first(), F.col(key).asc_nulls_last(), F.col("leaf").asc()]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    laid = stage(laid, "leaves").withColumn("_part", F.shiftright("_at", 33))
    runs = laid.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    runs = stage(runs, "runs")
    trees = ranked(runs.groupBy(group).agg(F.sum("_n").alias("n")), [], [F.col(group).asc_nulls_first()], "trees")
    trees = stage(trees.select((F.col("rank") - 1).alias("tree"), group, "n"), "trees")
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("r")
    t = trees.withColumnRenamed(group, "_group").alias("t")
    runs = runs.join(t, F.col(f"r.{group}").eqNullSafe(F.col("t._group"))).select("r.*", "t.tree", "t.n").alias("r")
    same = (F.col("l._part") == F.col("r._part")) & F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}"))
    idx = F.col("l._at") - F.col("r._first") + F.col("r._before")
    return laid.alias("l").join(runs, same).select("r.tree", "r.n", idx.alias("idx"), "l.*").drop("_at", "_part"), trees


def _built(key: tuple, block: pa.Table) -> pa.Table:
    """The nodes above a block, ``DEPTH`` levels or up to its tree's root."""
    tree, n, level = key[0].as_py(), block["n"][0].as_py(), block["level"][0].as_py()
    now = dict(sorted(zip(block["idx"].to_pylist(), block["hash"].to_pylist())))
    found: list[tuple[int, int, str]] = []
    for up in range(level + 1, min(level + DEPTH, height(n)) + 1):
        runs: dict[int, list[str]] = {}
        for i, h in now.items():
            runs.setdefault(i // ARITY, []).append(h)
        now = {i: digest(*run) for i, run in runs.items()}
        found += [(up, i, h) for i, h in now.items()]
    levels, idx, hashes = zip(*found) if found else ((), (), ())
    return pa.table(
        {
            "tree": pa.array([tree] * len(found), pa.int64()),
            "n": pa.array([n] * len(found), pa.int64()),
            "level": pa.array(levels, pa.int32()),
            "idx": pa.array(idx, pa.int64()),
            "hash": pa.array(hashes, pa.string()),
        }
    )


def _above(nodes: DataFrame, most: int) -> DataFrame:
    """All nodes above those given (tree, n, level, idx, hash), for trees of ``most`` leaves at most."""
    spark, all_nodes = nodes.sparkSession, []
    for level in range(0, height(most), DEPTH):
        blocks = nodes.where((F.col("level") == level) & (_height(F.col("n")) > level))
        block = F.floor(F.col("idx") / BLOCK).alias("block")
        nodes = stage(blocks.groupBy("tree", block).applyInArrow(_built, NODES), "nodes")
        all_nodes.append(nodes)
    return reduce(DataFrame.unionByName, all_nodes) if all_nodes else spark.createDataFrame([], NODES)


def _tops(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("level") == _height(F.col("n"))).select("tree", "hash")


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "lang", key: str = "doc_id", claimed: Column | None = None) -> Manifest:
    """The manifest of ``docs``. ``claimed`` is the leaf that a reader of the
    rows works out (null: the true one), kept beside the true one for
    :func:`proved` to check."""
    rows = docs.select(group, key, leaf([F.col(c) for c in columns]).alias("leaf"), (F.lit(None) if claimed is None else claimed).cast("string").alias("claimed"))
    leaves, trees = _numbered(rows, group, key)
    size = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    groups, most = size[0], size[1] or 0
    bottom = leaves.select("tree", "n", F.lit(0).alias("level"), "idx", F.col("leaf").alias("hash"))
    inner = _above(bottom, most)
    lone = bottom.where("n = 1").select("tree", "hash")
    trees = stage(trees.join(_tops(inner).unionByName(lone).withColumnRenamed("hash", "subroot"), "tree"), "subroots")
    subroots = trees.select(F.lit(TOP).cast("long").alias("tree"), F.lit(groups).cast("long").alias("n"), F.lit(0).alias("level"), F.col("tree").alias("idx"), F.col("subroot").alias("hash"))
    upper = _above(subroots, groups)
    top = (_tops(upper) if groups > 1 else subroots).first()
    nodes = inner.unionByName(subroots).unionByName(upper).select("tree", "level", "idx", "hash")
    return Manifest(leaves, nodes, trees, groups, top["hash"] if top else None)


def missing(known: list[int], n: int) -> list[tuple[int, int]]:
    """(level, idx) of the nodes that leaves ``known`` of ``n`` need to derive
    the root and cannot derive themselves: no smaller set does."""
    found, level, now = [], 0, set(known)
    while n > 1:
        up = {i // ARITY for i in now}
        found += [(level, i) for p in sorted(up) for i in range(p * ARITY, min(p * ARITY + ARITY, n)) if i not in now]
        now, n, level = up, -(-n // ARITY), level + 1
    return found


def _coordinates(groups: int):
    def run(key: tuple, block: pa.Table) -> pa.Table:
        tree, number = (k.as_py() for k in key)
        inner = [(tree, *c) for c in missing(block["idx"].to_pylist(), block["n"][0].as_py())]
        wanted = inner + [(TOP, *c) for c in missing([tree], groups)]
        at, level, idx = zip(*wanted) if wanted else ((), (), ())
        return pa.table(
            {
                "tree": pa.array([tree] * len(wanted), pa.int64()),
                "block": pa.array([number] * len(wanted), pa.int64()),
                "at": pa.array(at, pa.int64()),
                "level": pa.array(level, pa.int32()),
                "idx": pa.array(idx, pa.int64()),
            }
        )

    return run


class _Paths:
    """What leaves of one tree need on their way to its root: the hashes left
    and right of a node in its run, level by level."""

    def __init__(self, leaves: dict[int, str], n: int, fetched: dict[tuple[int, int], str]) -> None:
        self.levels: list[dict[int, tuple[str, str]]] = []
        self._above: list[dict[int, str]] = []
        now, level = dict(leaves), 0
        while n > 1:
            sides: dict[int, tuple[str, str]] = {}
            up = {}
            for p in {i // ARITY for i in now}:
                places = range(p * ARITY, min(p * ARITY + ARITY, n))
                run = [now[i] if i in now else fetched[level, i] for i in places]
                for i, at in zip(places, range(ARITY)):
                    if i in now:
                        sides[i] = "".join(run[:at]), "".join(run[at + 1 :])
                up[p] = digest(*run)
            self.levels.append(sides)
            now, n, level = up, -(-n // ARITY), level + 1
        self.root = next(iter(now.values()))
        # The siblings from a node up to the root, worked out once for all leaves below it.
        above: dict[int, str] = {0: ""}
        for sides in reversed(self.levels):
            above = {i: before + after + above[i // ARITY] for i, (before, after) in sides.items()}
            self._above.append(above)
        self._above.reverse()

    def siblings(self, idx: int) -> str:
        return self._above[0][idx] if self.levels else ""

    def folded(self, idx: int, value: str) -> str:
        for sides in self.levels:
            before, after = sides[idx]
            value, idx = digest(before, value, after), idx // ARITY
        return value


def _expanded(groups: int, names: list[str], with_proofs: bool):
    def run(key: tuple, block: pa.Table, fetched: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        nodes: dict[int, dict[tuple[int, int], str]] = {tree: {}, TOP: {}}
        for at, level, idx, h in zip(*[fetched[c].to_pylist() for c in ("at", "level", "idx", "hash")]):
            nodes[at][level, idx] = h
        idx, leaves = block["idx"].to_pylist(), block["leaf"].to_pylist()
        inner = _Paths(dict(zip(idx, leaves)), block["n"][0].as_py(), nodes[tree])
        top = _Paths({tree: inner.root}, groups, nodes[TOP])
        end = top.siblings(tree)
        proofs = [inner.siblings(i) + end for i in idx]
        claims = [c or h for c, h in zip(block["claimed"].to_pylist(), leaves)]
        out = {c: block[c] for c in names}
        out["subroot"] = pa.array([inner.root] * len(idx), pa.string())
        out["proof_sha256"] = pa.array([digest(p) for p in proofs], pa.string())
        out["folded_root"] = pa.array([top.folded(tree, inner.folded(i, c)) for i, c in zip(idx, claims)], pa.string())
        if with_proofs:
            out["proof"] = pa.array([[p[k : k + 64] for k in range(0, len(p), 64)] for p in proofs], pa.list_(pa.string()))
        return pa.table(out)

    return run


def proved(made: Manifest, asked: DataFrame | None = None, with_proofs: bool = False) -> DataFrame:
    """The leaves with subroot, root, the hash of their proof (with
    ``with_proofs`` the siblings themselves), the root that folding the claimed
    leaf along the proof gives, and whether that is the manifest's.

    ``asked`` are rows of ``made.leaves``; without it all leaves are proved.
    """
    leaves = made.leaves if asked is None else asked
    names = [c for c in leaves.columns if c not in ("tree", "n", "idx")]
    blocked = leaves.withColumn("block", F.floor(F.col("idx") / BLOCK))
    wanted = stage(
        blocked.select("tree", "block", "n", "idx").groupBy("tree", "block").applyInArrow(_coordinates(made.groups), "tree long, block long, at long, level int, idx long"),
        "coordinates",
    )
    nodes = made.nodes
    if asked is not None:  # of blocks that are not asked for whole, leaves may be missing too
        nodes = nodes.unionByName(made.leaves.select("tree", F.lit(0).alias("level"), "idx", F.col("leaf").alias("hash")))
    fetched = wanted.join(nodes.withColumnRenamed("tree", "at"), ["at", "level", "idx"])
    fields = [f"`{c}` {leaves.schema[c].dataType.simpleString()}" for c in names]
    schema = ", ".join([*fields, "subroot string", "proof_sha256 string", "folded_root string", *(["proof array<string>"] if with_proofs else [])])
    found = blocked.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(_expanded(made.groups, names, with_proofs), schema)
    root = F.lit(made.root).cast("string")
    return found.withColumn("root", root).withColumn("verified", F.col("folded_root") == root)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claimed = F.when(tampered, leaf([lowered if c == "text" else F.col(c) for c in COLUMNS]))
    found = proved(manifest(docs, claimed=claimed))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# The oracle writes levels out: so many reach 8^9 rows of a language and 8^4 languages.
_LEVELS, _TOP_LEVELS = 9, 4


def _value(text: str) -> str:
    return f"coalesce(strlen({text})::varchar || ':' || {text}, '-')"


def _sql_tree(name: str, keys: str, levels: int) -> str:
    """CTEs of the nodes of each level and what lies beside them in their runs."""
    out = []
    over = f"over (partition by {keys}, idx // 8 order by idx rows between"
    for k in range(levels):
        out.append(
            f"""{name}s{k} as (select *, n > 1 as up,
  case when n > 1 then coalesce(string_agg(h, '') {over} unbounded preceding and 1 preceding), '') else '' end as pre,
  case when n > 1 then coalesce(string_agg(h, '') {over} 1 following and unbounded following), '') else '' end as post from {name}{k}),
{name}{k + 1} as (select {keys}, idx // 8 as idx, case when any_value(n) > 1 then sha256(string_agg(h, '' order by idx)) else any_value(h) end as h,
  (any_value(n) + 7) // 8 as n from {name}{k} group by {keys}, idx // 8)"""
        )
    return ",\n".join(out)


def _sql_folds(name: str, start: str, levels: int, key: str) -> str:
    out, source = [], start
    for k in range(levels):
        out.append(
            f"""{name}f{k} as (select f.* exclude (folded, proof, pos), f.pos // 8 as pos, f.proof || s.pre || s.post as proof,
  case when s.up then sha256(s.pre || f.folded || s.post) else f.folded end as folded
  from {source} f join {name}s{k} s on {key} and f.pos = s.idx)"""
        )
        source = f"{name}f{k}"
    return ",\n".join(out)


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""
_FIRST = "'' || " + " || ".join(_value(f"{c}::varchar") for c in COLUMNS[:-1])

OP12_SQL = f"""
with hashed as (
  select doc_id, lang, sha256({_FIRST} || {_value("text")}) as leaf,
    case when doc_id is not null and {_CRC} % 3 = 0 then sha256({_FIRST} || {_value(_LOWERED)}) end as claimed from documents),
leaves as (select *, row_number() over (partition by lang order by doc_id nulls last, leaf) - 1 as idx, count(*) over (partition by lang) as n from hashed),
a0 as (select lang, idx, leaf as h, n from leaves),
{_sql_tree("a", "lang", _LEVELS)},
subroots as (select lang, h from a{_LEVELS}),
b0 as (select 1 as one, row_number() over (order by encode(lang) nulls first) - 1 as idx, h, count(*) over () as n, lang from subroots),
{_sql_tree("b", "one", _TOP_LEVELS)},
begun as (select l.doc_id, l.lang, l.leaf, s.h as subroot, b.idx as place, l.idx as pos, coalesce(l.claimed, l.leaf) as folded, '' as proof
  from leaves l join subroots s on l.lang is not distinct from s.lang join b0 b on l.lang is not distinct from b.lang),
{_sql_folds("a", "begun", _LEVELS, "f.lang is not distinct from s.lang")},
turned as (select * replace (place as pos) from af{_LEVELS - 1}),
{_sql_folds("b", "turned", _TOP_LEVELS, "true")}
select f.doc_id, f.leaf, f.subroot, r.h as root, sha256(f.proof) as proof_sha256, f.folded as folded_root, f.folded = r.h as verified
from bf{_TOP_LEVELS - 1} f, b{_TOP_LEVELS} r
"""
