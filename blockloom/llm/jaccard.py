"""N-gram Jaccard join with signature trees.

A document is the set of its distinct word shingles. Every set has a bitmap
of its tokens. A signature tree holds sets as leaves; an inner node holds the
OR of the bitmaps below it and the range of their sizes. Two trees are walked
together from their roots: a pair of nodes is dropped, with everything below
it, if the largest overlap that bitmaps and sizes allow is too small for the
similarity asked for. What is left at the leaves is checked with the sets
themselves.

A tree over all documents would not fit one task, so sets are first dealt out
by tokens: two sets of enough overlap share one of the first few tokens of
each, in any order of tokens that is the same for all. Tokens that a sample
finds often come last in that order; this changes how much work there is, not
what is found. Each token shared by several sets is a group with a tree of
its own, groups of equal members count once, and a large group is cut into
blocks whose pairs are walked on their own. Before that, a few tokens more of
each set are looked at: a set that shares too few of them is like no other.

Links are kept as components, so a group of copies costs about as many links
as it has members. Equal sets are one node. Tokens are 64-bit hashes of
shingles, and sets are told apart by two 64-bit sums and their size.

Nulls and ties: null and empty texts and texts without words have no
shingles and link with nothing. A text of fewer words than a shingle has its
whole sequence as the one shingle. Null doc_ids are larger than any other;
rows that repeat an id are rows of their own, and a component is named by its
smallest id. An empty table gives an empty result; columns beside doc_id and
text are not looked at and pass through ``representatives``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .common import bounded_sample, kept, table
from .graph import components

#: Words in a shingle and the least similarity, as a fraction.
WORDS, LEAST = 3, (90, 100)
#: Documents that are looked at for tokens that are frequent, and how often these occur in them.
SAMPLE, OFTEN = 5_000, 3
#: Sets in a block.
BLOCK = 256
#: Leaves' sets and children in a tree node.
LEAF, FAN = 16, 4
#: Rows up to which the sets to be checked are looked up by broadcast (24 bytes each).
BROADCAST_ROWS = 1_000_000
#: Words whose hashes a worker keeps at a time.
REMEMBERED = 100_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingles(text: str | None, words: int, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles. Lower-casing and
    splitting bytes touches A-Z and ASCII white space alone."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    at = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
    n = min(words, len(at))
    out = np.full(len(at) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out ^= at[i : len(at) - n + 1 + i]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def bits_for(n: int) -> int:
    """Bits of the bitmap of a set: a power of two, at least four a token."""
    return max(256, 1 << (4 * max(n, 1) - 1).bit_length())


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """The set's bits as 64-bit words."""
    bits = bits_for(len(tokens))
    out = np.zeros(bits, dtype=np.uint8)
    out[(tokens >> np.uint64(20)) & np.uint64(bits - 1)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, n: int) -> np.ndarray:
    """A bitmap at ``n`` words, half as many or as many as it has."""
    return words if len(words) == n else words[:n] | words[n:]


class SignatureTree:
    """Bitmaps of one width, with sizes, in nodes from the leaves up."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray) -> None:
        self.spare = sizes - np.bitwise_count(maps).sum(1)
        self.sizes, self.maps = sizes, maps
        # Each level: OR of bitmaps, least and largest size, most tokens beyond one a bit.
        self.levels = [(maps, sizes, sizes, self.spare)]
        step = LEAF
        while len(self.levels[-1][1]) > 1:
            m, low, high, spare = self.levels[-1]
            cut = np.arange(0, len(low), step)
            self.levels.append((
                np.bitwise_or.reduceat(m, cut, axis=0), np.minimum.reduceat(low, cut),
                np.maximum.reduceat(high, cut), np.maximum.reduceat(spare, cut),
            ))
            step = FAN

    def pairs(self, least: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places a < b whose overlap may be enough, by walking the
        tree against itself level by level."""
        num, den = least
        a = b = np.zeros(1, dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            m, low, high, spare = self.levels[level]
            out_a, out_b = [], []
            step = max(1, (1 << 21) // m.shape[1])
            for s in range(0, len(a), step):
                x, y = a[s : s + step], b[s : s + step]
                fits = (high[x] * den >= low[y] * num) & (high[y] * den >= low[x] * num)
                x, y = x[fits], y[fits]
                common = np.bitwise_count(m[x] & m[y]).sum(1, dtype=np.int64)
                most = np.minimum(common + np.minimum(spare[x], spare[y]), np.minimum(high[x], high[y]))
                enough = most * (num + den) >= num * (low[x] + low[y])
                out_a.append(x[enough])
                out_b.append(y[enough])
            a, b = np.concatenate(out_a), np.concatenate(out_b)
            if level:
                n = len(self.levels[level - 1][1])
                fan = LEAF if level == 1 else FAN
                steps = np.arange(fan)
                x = np.repeat(a[:, None] * fan + steps, fan, axis=1).ravel()
                y = np.tile(b[:, None] * fan + steps, (1, fan)).ravel()
                inside = (x < n) & (y < n) & ((x < y) if level == 1 else (x <= y))
                a, b = x[inside], y[inside]
        return a[a < b], b[a < b]


def possible_pairs(sizes: np.ndarray, maps: list[np.ndarray], least: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of sets that may be similar enough. Bitmaps of one width share a
    tree; the next larger width joins it at half its width."""
    width = np.array([len(m) for m in maps])
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for w in np.unique(width):
        # Wider than one step apart, sizes differ by more than twice.
        at = np.flatnonzero((width == w) | (width == 2 * w))
        if len(at) < 2:
            continue
        at = at[np.lexsort((at, sizes[at]))]
        a, b = SignatureTree(sizes[at], np.stack([folded(maps[i], w) for i in at])).pairs(least)
        a, b = at[a], at[b]
        mine = (width[a] == w) | (width[b] == w)
        out_a.append(a[mine])
        out_b.append(b[mine])
    return np.concatenate(out_a), np.concatenate(out_b)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place each of ``n`` places is connected with."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def similar(x: np.ndarray, y: np.ndarray, least: tuple[int, int]) -> bool:
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    overlap = int((x[at] == y).sum())
    return least[1] * overlap >= least[0] * (len(x) + len(y) - overlap)


def linked(sets: list[np.ndarray], least: tuple[int, int], join: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Checked links that connect what is connected; ``join`` names what
    already is."""
    sizes = np.array([len(s) for s in sets])
    a, b = possible_pairs(sizes, [bitmap(s) for s in sets], least)
    parent = list(range(len(sets)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    if join is not None:
        first: dict = {}
        for i, j in enumerate(join.tolist()):
            parent[i] = first.setdefault(j, i)
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q and similar(sets[x], sets[y], least):
            parent[p] = q
            out.append((x, y))
    return out


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key of sorted batches, key after key."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for start, end in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            key = tuple(c[start] for c in columns)
            if held and key != current:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _in_blocks(rows: DataFrame, key: str, size: Column, block: int = BLOCK) -> DataFrame:
    """``rows`` with i and j: each row once for every pair of blocks of its key
    that its own block is in. ``size`` is the number of rows of the key."""
    blocks = F.ceil(size / block).cast("int")
    rows = rows.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64(F.lit(17), "node"), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    i, j = F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j")
    return rows.select(*[c for c in rows.columns if not c.startswith("_")], i, j)


def _by_size(members: DataFrame, least: tuple[int, int], block: int = BLOCK) -> DataFrame:
    """(token, part, over, i, j, node, n): the groups that members (token,
    sets, node, n) of a token are walked in.

    Members of one block are one group. More are parted by size, in steps of
    the least similarity: sets of two sizes can be similar only if these lie
    in one step or in neighbouring ones, so blocks meet blocks of their own
    step and of the next, and those further apart never move.
    """
    num, den = least
    few = members.where(F.col("sets") <= block).select("token", *[F.lit(0).alias(c) for c in ("part", "over", "i", "j")], "node", "n")
    # A trifle wider than the similarity, so that rounding parts no two sets that may be similar.
    step = F.floor(F.log(F.col("n").cast("double")) / (float(np.log(den / num)) + 1e-6)).cast("int") if num < den else F.hash("n")
    many = members.where(F.col("sets") > block).withColumn("_step", step)
    sizes = many.groupBy("token", "_step").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    # As many entries a token as there are steps of size.
    sizes = sizes.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("_step", "_blocks"))).alias("_sizes"))
    many = many.join(sizes, "token")
    blocks = lambda k: F.coalesce(F.try_element_at("_sizes", F.col("_step") + k), F.lit(0))
    each = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    own = F.pmod(F.xxhash64(F.lit(17), "node"), blocks(0)).cast("int")
    place = lambda part, over, i, j: F.struct(part.alias("part"), F.lit(over).alias("over"), i.alias("i"), j.alias("j"))
    many = many.withColumn("_own", own)
    here = F.transform(each(blocks(0)), lambda o: place(F.col("_step"), 0, F.least("_own", o), F.greatest("_own", o)))
    above = F.transform(each(blocks(1)), lambda o: place(F.col("_step"), 1, F.col("_own"), o))
    below = F.transform(each(blocks(-1)), lambda o: place(F.col("_step") - 1, 1, o, F.col("_own")))
    many = many.select("token", F.inline(F.concat(here, above, below)), "node", "n")
    return few.unionByName(many)


def _grouped(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def signatures(docs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame:
    """(doc_id, text_hash, n, sum_a, sum_b, first, bits) per document: size, two
    sums that tell sets apart, the first tokens in the common order, and the bitmap."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))

    def all_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept(("shingle words",), _Hashes)
        for batch in batches:
            for t in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t.as_py(), words, known).view(np.int64))], names=["token"])

    # At most SAMPLE documents' tokens; those found OFTEN are fewer still.
    often = bounded_sample(docs, "doc_id", SAMPLE).select("text").mapInArrow(all_tokens, "token long")
    often = often.groupBy("token").count().where(F.col("count") >= OFTEN).orderBy("token").toArrow()
    frequent, times = often["token"].to_numpy(), often["count"].to_numpy()
    by_token = np.argsort(frequent.view(np.uint64))
    frequent, times = frequent.view(np.uint64)[by_token], times[by_token]
    (num, den), more = least, more_tokens(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept(("shingle words",), _Hashes)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                size, sum_a, sum_b, first, bits = [], [], [], [], []
                for t in batch.column(1):
                    tokens = shingles(t.as_py(), words, known)
                    n = len(tokens)
                    size.append(n)
                    _, x, y = set_sums(tokens)
                    sum_a.append(x)
                    sum_b.append(y)
                    if len(frequent) and n:
                        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                        rank = np.where(frequent[at] == tokens, times[at], 0)
                        tokens_in_order = tokens[np.lexsort((tokens, rank))]
                    else:
                        tokens_in_order = tokens
                    first.append(tokens_in_order[: n - -(-num * n // den) + 1 + n // more].view(np.int64))
                    bits.append(bitmap(tokens).tobytes() if n else b"")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(sum_a, pa.int64()), pa.array(sum_b, pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                    names=["doc_id", "text_hash", "n", "sum_a", "sum_b", "first", "bits"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, text_hash long, n long, sum_a long, sum_b long, first array<long>, bits binary")


SET = ["n", "sum_a", "sum_b"]
GROUP = ["token", "part", "over", "i", "j"]


def more_tokens(least: tuple[int, int]) -> int:
    """A set's first tokens go on beyond those it is dealt out by: by one for
    so many tokens of the set."""
    num, den = least
    return 20 if 10 * num >= 9 * den else 40


def set_sums(tokens: np.ndarray) -> tuple[int, int, int]:
    """What tells a set apart: its size and two sums over its tokens."""
    if not len(tokens):
        return 0, 0, 0
    mixed = (tokens ^ (tokens >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(29)
    return len(tokens), int(tokens.sum().astype(np.int64)), int(mixed.sum().astype(np.int64))


def signed_rows(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with _n, _sum_a and _sum_b of each row's set."""
    schema = T.StructType([*docs.schema.fields, *[T.StructField(f"_{c}", T.LongType()) for c in SET]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept(("shingle words",), _Hashes)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                sums = [set_sums(shingles(t.as_py(), words, known)) for t in batch.column(batch.schema.get_field_index("text"))]
                more = [pa.array(x, pa.int64()) for x in zip(*sums)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *[f"_{c}" for c in SET]])

    return docs.mapInArrow(run, schema)


def possible_links(sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b): nodes whose bitmaps allow enough overlap, thinned out to what
    connects them."""
    num, den = least
    at_least = lambda n: F.ceil(n * num / den)
    postings = sets.select("node", "n", F.posexplode("first").alias("at", "token"))
    tokens = postings.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    shared = stage(postings.join(stage(tokens.select("token"), "tokens"), "token"), "shared")
    # With k tokens more, similar sets share k + 1 of them at least, k being that
    # of the smaller set. A set with fewer shared ones is like no other.
    enough = F.col("found") > F.floor(at_least(F.col("n")) / more_tokens(least))
    nodes = shared.groupBy("node", "n").agg(F.count(F.lit(1)).alias("found")).where(enough).select("node")
    live = stage(shared.join(nodes, "node").where(F.col("at") <= F.col("n") - at_least(F.col("n"))).select("token", "node"), "live")
    mark = lambda seed: F.sum(F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(1 << 40)))
    tokens = live.groupBy("token").agg(F.count(F.lit(1)).alias("sets"), mark(1).alias("x"), mark(2).alias("y")).where("sets > 1")
    # Tokens with the same sets are one group.
    tokens = stage(tokens.groupBy("sets", "x", "y").agg(F.min("token").alias("token")).select("token", "sets"), "groups")
    members = stage(live.join(tokens, "token").join(sets.select("node", "n"), "node"), "members")
    rows = _by_size(members, least).join(sets.select("node", "bits"), "node")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, GROUP):
            if group.num_rows < 2:
                continue
            # In the order of nodes, so that stars of different groups have the same centre.
            order = np.argsort(group["node"].to_numpy())
            node, size = group["node"].to_numpy()[order], group["n"].to_numpy()[order]
            maps = [np.frombuffer(group["bits"][int(i)].as_py(), dtype=np.uint64) for i in order]
            label = spanning(len(node), *possible_pairs(size, maps, least))
            own = np.flatnonzero(label != np.arange(len(node)))
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[label[own]])], names=["a", "b"])

    return _grouped(rows, GROUP).mapInArrow(walk, "a long, b long")


def _checked(rows: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b): links of rows (cluster, i, j, node, tokens, joined), checked with the sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["cluster", "i", "j"]):
            node, first = np.unique(group["node"].to_numpy(), return_index=True)
            sets = [np.frombuffer(group["tokens"][int(i)].as_py(), dtype=np.uint64) for i in first]
            found = linked(sets, least, group["joined"].to_numpy()[first])
            if found:
                label = spanning(len(node), *np.array(found).T)
                own = np.flatnonzero(label != np.arange(len(node)))
                yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[label[own]])], names=["a", "b"])

    rows = rows.select("cluster", "i", "j", "node", "tokens", "joined")
    return _grouped(rows, ["cluster", "i", "j"]).mapInArrow(check, "a long, b long")


def checked_links(docs: DataFrame, sets: DataFrame, clusters: DataFrame, words: int, least: tuple[int, int], block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect the nodes of each cluster (node, component)
    as all links between them would."""
    clusters = clusters.withColumnRenamed("component", "cluster")
    wanted = stage(clusters.join(sets.select("node", "doc_id", "text_hash", *SET), "node"), "wanted")
    total = wanted.count()
    side = F.broadcast(wanted) if total <= BROADCAST_ROWS else wanted
    d, w = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).alias("d"), side.alias("w")
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    rows = d.join(w, same).select("w.cluster", "w.node", *[f"w.{c}" for c in SET], "d.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept(("shingle words",), _Hashes)
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                tokens = [shingles(t.as_py(), words, known) for t in batch.column(5)]
                # Another text under the same id is not the set that is wanted.
                mine = [
                    i for i, (t, *sums) in enumerate(zip(tokens, *[batch.column(c).to_pylist() for c in (2, 3, 4)])) if set_sums(t) == tuple(sums)
                ]
                part = batch.select(["cluster", "node"]).take(pa.array(mine, pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([tokens[i].tobytes() for i in mine], pa.binary())], names=["cluster", "node", "tokens"])

    rows = stage(rows.mapInArrow(run, "cluster long, node long, tokens binary").join(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets")), "cluster"), "sets")
    alone = F.col("node").alias("joined")
    own = F.pmod(F.xxhash64(F.lit(19), "node"), F.ceil(F.col("sets") / block)).cast("int")
    # Every cluster in blocks; a cluster of one block is done with that.
    inside = stage(_checked(rows.select("*", alone).withColumn("i", own).withColumn("j", F.lit(0)), least), "inside")
    large = rows.where(F.col("sets") > block)
    if large.isEmpty():
        return inside

    def with_joined(links: DataFrame) -> DataFrame:
        joined = stage(components(links).select("node", F.col("component").alias("joined")), "joined")
        return large.join(joined, "node", "left").withColumn("joined", F.coalesce("joined", "node"))

    # One set for each component of a block, against those of all blocks.
    heads = stage(with_joined(inside).where("node = joined").drop("joined"), "heads")
    counted = heads.groupBy("cluster").agg(F.count(F.lit(1)).alias("heads"))
    heads = _in_blocks(heads.join(counted, "cluster"), "cluster", F.col("heads"), block).select("*", alone)
    across = stage(_checked(heads, least), "across")
    # What is outside the largest component of its cluster, against all the cluster.
    now = stage(with_joined(inside.unionByName(across)), "now")
    sizes = now.groupBy("cluster", "joined").agg(F.count(F.lit(1)).alias("rows"))
    most = sizes.groupBy("cluster").agg(F.max(F.struct("rows", "joined")).alias("most"), F.sum("rows").alias("all"))
    most = stage(most.select("cluster", F.col("most.joined").alias("largest"), (F.col("all") - F.col("most.rows")).alias("outside")).where("outside > 0"), "most")
    now = now.join(most, "cluster")
    parts = F.ceil(F.col("outside") / block).cast("int")
    outer = now.where("joined <> largest").withColumn("i", F.pmod(F.xxhash64(F.lit(23), "node"), parts).cast("int"))
    outer = outer.withColumn("j", F.explode(F.sequence(F.lit(0), F.ceil(F.col("sets") / block).cast("int") - 1)))
    every = now.withColumn("j", own).withColumn("i", F.explode(F.sequence(F.lit(0), parts - 1)))
    rest = _checked(outer.unionByName(every.select(*outer.columns)), least)
    return inside.unionByName(across).unionByName(stage(rest, "rest"))


def join(docs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, set_key, component_id, component_key) per row of
    ``docs``; set_key tells the row's set apart, component_key is that of the
    smallest doc_id of the component."""
    rows = stage(signatures(docs, words, least), "signatures")
    some = rows.where("n > 0")
    least_id = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    distinct = some.groupBy(*SET).agg(least_id.alias("id"), F.first("first").alias("first"), F.first("bits").alias("bits"))
    sets = stage(distinct.select(*SET, F.col("id.doc_id").alias("doc_id"), F.col("id.text_hash").alias("text_hash"), "first", "bits", F.monotonically_increasing_id().alias("node")), "classes")
    clusters = stage(components(possible_links(sets, least)), "clusters")
    found = components(checked_links(docs, sets, clusters, words, least, block))
    named = stage(found.join(sets.select("node", "doc_id", *SET), "node"), "named")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), *[F.col(c) for c in SET])).alias("head")
    heads = stage(named.groupBy("component").agg(first), "heads")
    member = named.join(heads, "component").select(*SET, F.col("head.doc_id").alias("head_id"), *[F.col(f"head.{c}").alias(f"head_{c}") for c in SET])
    own = sets.select(*SET, F.col("doc_id").alias("own_id"))
    classes = stage(
        own.join(member, SET, "left").select(
            *SET,
            F.when(F.col("head_n").isNull(), F.col("own_id")).otherwise(F.col("head_id")).alias("component_id"),
            *[F.coalesce(F.col(f"head_{c}"), F.col(c)).alias(f"component_{c}") for c in SET],
        ),
        "membership",
    )
    linked_rows = some.select("doc_id", *SET).join(classes, SET)
    empty = rows.where("n = 0").select("doc_id", *SET).select("*", F.col("doc_id").alias("component_id"), *[F.col(c).alias(f"component_{c}") for c in SET])
    return linked_rows.select(*empty.columns).unionByName(empty)


def representatives(docs: DataFrame, words: int = 5, least: tuple[int, int] = (80, 100)) -> DataFrame:
    """The documents with one of each component: its smallest doc_id, and
    every document without shingles. Of rows that repeat the id with equal
    sets, the least row by all columns stays."""
    found = join(docs, words, least)
    head = F.col("doc_id").eqNullSafe(F.col("component_id"))
    for c in SET:
        head = head & (F.col(c) == F.col(f"component_{c}"))
    keeps = stage(found.where(head & (F.col("n") > 0)).groupBy("doc_id", *SET).agg(F.count(F.lit(1)).alias("rows")), "keeps")
    names = docs.columns
    signed = signed_rows(docs, words)
    k, d = keeps.alias("k"), signed.alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
    for c in SET:
        same = same & (F.col(f"d._{c}") == F.col(f"k.{c}"))
    rows = d.where("_n > 0").join(k, same).select("d.*", F.col("k.rows").alias("_rows"))
    columns = [F.col(f"`{c}`") for c in names]
    out = rows.where("_rows = 1").select(*columns).unionByName(signed.where("_n = 0").select(*columns))
    if not keeps.where("rows > 1").isEmpty():
        least_row = rows.where("_rows > 1").groupBy("doc_id", *[f"_{c}" for c in SET]).agg(F.min(F.struct(*columns)).alias("_row"))
        out = out.unionByName(least_row.select("_row.*"))
    return out


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
