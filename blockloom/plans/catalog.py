"""Events from contract ABIs, and labels and parameters for logs."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keccak256_hex
from ..operators.joins import label_join, measured_bytes
from ..operators.lookups import first_implementation
from ..session import stage


def combined_abi(entries: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each contract's own entries plus those of its implementation, under the contract.

    One implementation can stand behind a large share of all contracts, so
    only the ABIs in use take part and the join treats it as a hot key.
    """
    links = first_implementation(pairs)
    used = links.select("implementation_address").distinct()
    behind = entries.withColumnRenamed("address", "implementation_address")
    behind = behind.join(used, "implementation_address", "left_semi")
    inherited = label_join(links, behind, ["implementation_address"])
    return entries.unionByName(inherited.where("entry is not null").select("address", "entry"))


_UNKNOWN = "?"


def _type_text(part: Column, fields: T.DataType) -> Column:
    """Canonical type: a tuple becomes its member types, array suffix kept.

    A missing type and a tuple without members read as ``?``.
    """
    kind = F.coalesce(part["type"], F.lit(_UNKNOWN))
    members = fields["components"].dataType
    if not isinstance(members, T.ArrayType):
        return F.when(kind.startswith("tuple"), _UNKNOWN).otherwise(kind)
    inner = F.transform(part["components"], lambda p: _type_text(p, members.elementType))
    suffix = F.substr(kind, F.lit(len("tuple") + 1))
    nested = F.concat(F.lit("("), F.array_join(inner, ","), F.lit(")"), suffix)
    return F.when(kind.startswith("tuple"), F.coalesce(nested, F.lit(_UNKNOWN))).otherwise(kind)


def _width(part: Column, fields: T.DataType) -> Column:
    """Words a static parameter takes in the data head, NULL for a dynamic one."""
    kind = part["type"]
    sizes = F.regexp_extract_all(kind, F.lit(r"\[([0-9]+)\]"), F.lit(1))
    repeats = F.aggregate(sizes, F.lit(1), lambda total, n: total * n.cast("int"))
    dynamic = kind.contains("[]") | kind.rlike("^(string|bytes)(\\[|$)")
    width = F.when(~dynamic & ~kind.startswith("tuple"), repeats)
    members = fields["components"].dataType
    if not isinstance(members, T.ArrayType):
        return width
    inner = F.transform(part["components"], lambda p: _width(p, members.elementType))
    total = F.aggregate(inner, F.lit(0), lambda a, b: a + b)
    return F.when(~dynamic & kind.startswith("tuple"), total * repeats).otherwise(width)


def event_catalog(entries: DataFrame) -> DataFrame:
    """address, event_name, topic0, event_signature, anonymous, params.

    Row-local: an Arrow batch hashes each of its distinct signatures once.
    Entries with a parameter of unknown type have a NULL signature.
    """
    inputs = entries.schema["entry"].dataType["inputs"].dataType.elementType
    events = entries.where("entry.type = 'event' and entry.name is not null").select(
        "address",
        F.col("entry.name").alias("event_name"),
        F.coalesce("entry.anonymous", F.lit(False)).alias("anonymous"),
        F.transform(
            F.coalesce("entry.inputs", F.array().cast(T.ArrayType(inputs))),
            lambda p: F.struct(
                p["name"].alias("name"),
                _type_text(p, inputs).alias("kind"),
                _width(p, inputs).alias("width"),
                F.coalesce(p["indexed"], F.lit(False)).alias("indexed"),
            ),
        ).alias("params"),
    )
    kinds = F.array_join(F.transform("params", lambda p: p["kind"]), ",")
    signature = F.when(
        ~kinds.contains(_UNKNOWN), F.concat("event_name", F.lit("("), kinds, F.lit(")"))
    )
    return (
        events.withColumn("event_signature", signature)
        .withColumn("topic0", keccak256_hex(F.col("event_signature")))
        .select("address", "event_name", "topic0", "event_signature", "anonymous", "params")
    )


def _placed(params: Column) -> Column:
    """Parameters with a unique name and their place in a log.

    ``at`` counts topics for an indexed parameter, words of the data head for
    another. Unnamed ones are called by position, repeated names get theirs
    appended, so that all survive as JSON keys.
    """
    names = F.transform(
        params,
        lambda p, i: F.when(F.coalesce(p["name"], F.lit("")) != "", p["name"]).otherwise(
            F.concat(F.lit("arg"), i.cast("string"))
        ),
    )

    def place(param: Column, i: Column) -> Column:
        earlier = F.slice(params, F.lit(1), i)
        name = F.get(names, i)
        topic = F.size(F.filter(earlier, lambda p: p["indexed"]))
        head = F.aggregate(
            F.filter(earlier, lambda p: ~p["indexed"]),
            F.lit(0),
            lambda total, p: total + F.coalesce(p["width"], F.lit(1)),
        )
        return F.struct(
            F.when(F.array_position(names, name) == i + 1, name)
            .otherwise(F.concat(name, F.lit("_"), i.cast("string")))
            .alias("name"),
            param["kind"].alias("kind"),
            param["indexed"].alias("indexed"),
            F.when(param["indexed"], topic).otherwise(head).alias("at"),
            F.coalesce(param["width"], F.lit(1)).alias("words"),
        )

    return F.transform(params, place)


#: A log has three topics beside its own at most.
_MOST_INDEXED = 3


def event_labels(catalog: DataFrame) -> DataFrame:
    """One label per contract and topic: the smallest signature if several are known.

    ``layouts`` has the parameters by the number of indexed ones: events of
    one signature can differ in what is indexed, and with it in their layout.
    """
    named = catalog.where("topic0 is not null and not anonymous")
    indexed = F.size(F.filter("params", lambda p: p["indexed"]))
    layouts = [
        F.min(F.when(indexed == n, F.struct("event_signature", _placed(F.col("params")).alias("params"))))
        for n in range(_MOST_INDEXED + 1)
    ]
    label = F.min(F.struct("event_signature", "event_name"))
    grouped = named.groupBy("address", "topic0").agg(
        label.alias("_label"), *[x.alias(f"_layout{n}") for n, x in enumerate(layouts)]
    )
    by_count = F.array(*[F.col(f"_layout{n}.params") for n in range(_MOST_INDEXED + 1)])
    return grouped.select("address", "topic0", F.struct("_label.*", by_count.alias("layouts")).alias("_own"))


def label_events(decoded: DataFrame, catalog: DataFrame, params: bool = False) -> DataFrame:
    """Add ``event_name`` and ``event_signature`` to decoded logs.

    The contract's own ABI decides; for contracts without one, any event
    known under the same topic. Parameters come from the layout with as many
    indexed ones as the log has topics for, and are NULL if none is known.
    Busy contracts and the transfer topic are hot keys, which
    :func:`label_join` can do with.
    """
    own = stage(event_labels(catalog), "labels")
    shared = own.groupBy("topic0").agg(
        F.min(F.struct("_own.event_signature", "_own.event_name")).alias("_label"),
        *[F.min(F.get("_own.layouts", F.lit(n))).alias(f"_layout{n}") for n in range(_MOST_INDEXED + 1)],
    )
    by_count = F.array(*[F.col(f"_layout{n}") for n in range(_MOST_INDEXED + 1)])
    shared = shared.select("topic0", F.struct("_label.*", by_count.alias("layouts")).alias("_shared"))
    size = measured_bytes(own)  # bounds ``shared`` too, which keeps some of its rows
    joined = label_join(decoded, own, ["address", "topic0"], size)
    joined = label_join(joined, shared, ["topic0"], size)
    given = sum((F.col(f"topic{n}").isNotNull().cast("int") for n in range(1, _MOST_INDEXED + 1)), F.lit(0))
    layout = F.coalesce(F.get("_own.layouts", given), F.get("_shared.layouts", given))
    return joined.select(
        *decoded.columns,
        F.coalesce("_own.event_name", "_shared.event_name").alias("event_name"),
        F.coalesce("_own.event_signature", "_shared.event_signature").alias("event_signature"),
        *([layout.alias("_params")] if params else []),
    )


def _prefixed(words: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise("0x", words, "")


def _whole(words: pa.Array, signed: bool) -> pa.Array:
    texts = []
    for word in words.to_pylist():
        number = None if word is None else int(word, 16)
        if signed and number is not None and number >> 255:
            number -= 1 << 256
        texts.append(None if number is None else str(number))
    return pa.array(texts, type=pa.string())


def _values_of_kind(words: pa.Array, kind: str) -> pa.Array:
    """Words of one ABI type as text; composite and hashed values stay hex."""
    if "[" in kind or "(" in kind or kind in ("string", "bytes"):
        return _prefixed(words)
    if kind == "address":
        return _prefixed(pc.utf8_slice_codeunits(words, 24))
    if kind == "bool":
        return pc.if_else(pc.match_substring_regex(words, "[1-9a-f]"), "true", "false")
    if kind.startswith(("uint", "int")):
        return _whole(words, signed=kind.startswith("int"))
    if kind.startswith("bytes"):
        return _prefixed(pc.utf8_slice_codeunits(words, 0, 2 * int(kind.removeprefix("bytes"))))
    return _prefixed(words)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _word_values(words: pa.Array, kinds: pa.Array) -> pa.Array:
    flat, coded = words.flatten(), kinds.flatten().dictionary_encode()
    code = coded.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    parts = [
        _values_of_kind(flat.take(pa.array(order[code[order] == n])), kind)
        for n, kind in enumerate(coded.dictionary.to_pylist())
    ]
    grouped = pa.concat_arrays(parts) if parts else pa.array([], type=pa.string())
    values = grouped.take(pa.array(np.argsort(order, kind="stable")))
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), type=pa.int32())
    return pa.ListArray.from_arrays(offsets, values, mask=words.is_null())


def _is_composite(kind: str) -> bool:
    return kind.endswith("]") or kind.startswith("(")


def _members(kind: str) -> list[str]:
    """Member types of a tuple type."""
    out, level, start = [], 0, 1
    for at, sign in enumerate(kind):
        level += (sign == "(") - (sign == ")")
        if (sign == "," and level == 1) or level == 0:
            out.append(kind[start:at])
            start = at + 1
            if level == 0:
                break
    return [m for m in out if m]


def _array_parts(kind: str) -> tuple[str, int | None]:
    """Item type and length (None: stated in the data) of an array type."""
    item, _, size = kind[:-1].rpartition("[")
    return item, int(size) if size else None


def _head_bytes(kind: str) -> int | None:
    """Bytes a type takes where it stands, None if it stands behind an offset."""
    if kind.endswith("]"):
        item, size = _array_parts(kind)
        each = _head_bytes(item)
        return None if size is None or each is None else size * each
    if kind.startswith("("):
        sizes = [_head_bytes(m) for m in _members(kind)]
        return None if None in sizes else sum(sizes)
    return None if kind in ("string", "bytes") else 32


#: Values that event data may hold for each of its words: offsets may share what they point at.
MOST_SHARED = 64


def _plain_value(word: bytes, kind: str) -> str:
    """What :func:`_values_of_kind` makes of one word."""
    if kind == "address":
        return "0x" + word[12:].hex()
    if kind == "bool":
        return "true" if any(word) else "false"
    if kind.startswith(("uint", "int")):
        return str(int.from_bytes(word, signed=kind.startswith("int")))
    if kind.startswith("bytes"):
        return "0x" + word[: int(kind.removeprefix("bytes"))].hex()
    return "0x" + word.hex()


class _Data:
    """Event data. Offsets that point at each other cannot ask for more values
    than ``MOST_SHARED`` a word."""

    def __init__(self, data: bytes) -> None:
        self.data, self.left = data, MOST_SHARED * (len(data) // 32 + 1)

    def word(self, at: int) -> bytes:
        self.left -= 1
        found = self.data[at : at + 32]
        if len(found) < 32 or self.left < 0:
            raise ValueError("data ends too early")
        return found

    def read(self, kind: str, at: int, base: int, heads: int = 0) -> str | list:
        """The value whose place is ``at``; offsets count from ``base`` and
        point behind its ``heads`` bytes."""
        if _head_bytes(kind) is None:
            offset = int.from_bytes(self.word(at))
            if offset < heads:
                raise ValueError("an offset points at an offset")
            at = base + offset
        if kind.endswith("]"):
            item, size = _array_parts(kind)
            if size is None:
                size, at = int.from_bytes(self.word(at)), at + 32
            if size > len(self.data):
                raise ValueError("more items than bytes")
            return self.row([item] * size, at)
        if kind.startswith("("):
            return self.row(_members(kind), at)
        if kind in ("string", "bytes"):
            size = int.from_bytes(self.word(at))
            content = self.data[at + 32 : at + 32 + size]
            if len(content) < size:
                raise ValueError("data ends too early")
            return "0x" + content.hex()
        return _plain_value(self.word(at), kind)

    def row(self, kinds: list[str], at: int) -> list:
        out, base = [], at
        heads = sum(_head_bytes(kind) or 32 for kind in kinds)
        for kind in kinds:
            out.append(self.read(kind, at, base, heads))
            at += _head_bytes(kind) or 32
        return out


@F.arrow_udf(T.ArrayType(T.StringType()))
def _composite_values(data: pa.Array, kinds: pa.Array, heads: pa.Array) -> pa.Array:
    """Arrays and tuples as JSON arrays of their values' texts, NULL if malformed."""
    out: list[list[str | None] | None] = []
    for text, row, places in zip(data.to_pylist(), kinds.to_pylist(), heads.to_pylist()):
        if text is None or row is None:
            out.append(None)
            continue
        values: list[str | None] = []
        for kind, place in zip(row, places):
            value = None
            if place is not None and kind and _is_composite(kind):
                try:
                    value = json.dumps(_Data(bytes.fromhex(text)).read(kind, 32 * place, 0), separators=(",", ":"))
                except (ValueError, RecursionError):
                    value = None
            values.append(value)
        out.append(values)
    return pa.array(out, type=pa.list_(pa.string()))


def _words_at(data: Column, index: Column, count: Column) -> Column:
    """``count`` words from number ``index`` of hex data; NULL if cut short."""
    words = F.lower(F.substr(data, index * 64 + 1, count * 64))
    return F.when((F.length(words) == count * 64) & words.rlike("^[0-9a-f]*$"), words)


def _position(word: Column) -> Column:
    """A word as a number of hex digits; NULL past what any text can hold."""
    small = F.when(F.ltrim(word, F.lit("0")).rlike("^[0-9a-fA-F]{0,8}$"), F.conv(F.right(word, F.lit(8)), 16, 10))
    return (small.try_cast("bigint") * 2).try_cast("int")


def _dynamic_hex(data: Column, head: Column) -> Column:
    """Content of a bytes or string parameter: offset, then length, then bytes.

    Offsets and lengths beyond the data give NULL.
    """
    start = _position(head)
    size_word = F.substr(data, start + 1, F.lit(64))
    size = F.when(F.length(size_word) == 64, _position(size_word))
    content = F.substr(data, start + 65, size)
    return F.when(F.length(content) == size, F.concat(F.lit("0x"), F.lower(content)))


def decode_params(labelled: DataFrame) -> DataFrame:
    """Add ``decoded_data``: parameter name to value as a JSON object.

    Takes :func:`label_events` rows with ``params=True``. Values of one word
    are decoded by type, byte strings and texts give their content as hex,
    arrays and tuples a JSON array of their members' texts, and hashed
    (indexed) ones stay hex words. What does not fit the data is NULL.
    """
    topics = F.array("topic1", "topic2", "topic3")
    flat = F.substr("data", F.lit(3))
    params = F.col("_params")

    def word(param: Column) -> Column:
        in_topic = F.lower(F.substr(F.get(topics, param["at"]), F.lit(3)))
        return F.when(param["indexed"], in_topic).otherwise(_words_at(flat, param["at"], param["words"]))

    found = labelled.withColumn("_words", F.transform(params, word)).withColumn(
        "_values", _word_values(F.col("_words"), params["kind"])
    )
    # Byte strings and texts lie behind the head, at the offset it states.
    pointed = F.transform(
        params,
        lambda p, i: F.when(
            p["kind"].isin("string", "bytes") & ~p["indexed"], _dynamic_hex(flat, F.get("_words", i))
        ).otherwise(F.get("_values", i)),
    )
    may_point = F.arrays_overlap(params["kind"], F.array(F.lit("string"), F.lit("bytes")))
    found = found.withColumn("_texts", F.when(may_point, pointed).otherwise(F.col("_values")))
    # Arrays and tuples are followed from the head; only rows that have any go there.
    composite = lambda p: ~p["indexed"] & p["kind"].rlike(r"^[(]|\]$")
    has_any = F.coalesce(F.exists(params, composite), F.lit(False))
    heads = F.transform(params, lambda p: F.when(composite(p), p["at"]))
    found = found.withColumn("_taken", _composite_values(F.when(has_any, flat), F.when(has_any, params["kind"]), F.when(has_any, heads)))
    taken = F.transform(params, lambda p, i: F.when(composite(p), F.get("_taken", i)).otherwise(F.get("_texts", i)))
    texts = F.when(has_any, taken).otherwise(F.col("_texts"))
    as_json = F.to_json(F.map_from_arrays(params["name"], texts), {"ignoreNullFields": "false"})
    return found.withColumn("decoded_data", F.when(params.isNotNull(), as_json)).drop(
        "_params", "_words", "_values", "_texts", "_taken"
    )


def described_logs(decoded: DataFrame, catalog: DataFrame) -> DataFrame:
    """Decoded logs with event name, signature and parameters."""
    return decode_params(label_events(decoded, catalog, params=True))


def save_events(catalog: DataFrame, path: str) -> None:
    """The event catalog as Parquet, sorted so that one contract's events lie together."""
    laid = catalog.hint("rebalance", "address").sortWithinPartitions("address", "event_name")
    laid.write.mode("overwrite").parquet(path)
