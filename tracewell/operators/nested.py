"""Deeply nested records as related flat tables, by Merkle subtree identities.

Every object of a record is canonicalised (keys sorted, no blanks, numbers as
written) and hashed bottom-up: in an object's content each object below it
stands as ``{"#": hash}``, so a hash covers its whole subtree.  Identical
objects are stored once; each occurrence is a bridge row that names its parent,
the field it stands in and its ordinal, and every record can be built again
from the two tables.  Exact copies of a record are dropped before it is parsed;
the parse is one Python stage over Arrow batches in which content of an object
leaves a task about once (a bounded memory of hashes already sent).
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.sources.shared import materialize

# Hashes a task remembers as already sent (16 bytes each and set overhead).
SENT_MEMORY = 200_000
# Texts nested deeper than the JSON parser follows are refused by it; what it returns is walked whole.
_DEEPEST = 1_000_000
# Stands before a number, which is kept as it was written; repeated more often than a text itself has it.
_MARK = "\ue000"

_SCHEMA = "is_object boolean, record_id long, root_no int, path string, depth int, field_name string, places string, object_hash binary, parent_hash binary, content string"


@dataclass(frozen=True)
class Layout:
    """Where record objects lie in a body and which of their blocks have inner arrays.

    ``wrappers``: keys under which record objects may be wrapped; ``blocks``:
    the blocks of a record object; ``inner``: array fields of a block's object.
    """

    wrappers: tuple[str, ...]
    blocks: tuple[str, ...]
    inner: tuple[str, ...]


def _no_constant(name: str):
    raise ValueError(name)


_ENCODE = json.JSONEncoder(ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode


@functools.lru_cache(64)
def _decoder(mark: str) -> json.JSONDecoder:
    return json.JSONDecoder(parse_float=mark.__add__, parse_int=mark.__add__, parse_constant=_no_constant)


@functools.lru_cache(64)
def _marked(mark: str) -> re.Pattern:
    return re.compile(f'"{mark}([0-9eE.+-]+)"')


def _load(text: str) -> tuple[object, str]:
    """(JSON value of a text, opened until it is no text any more; mark of its numbers); ValueError if it is no JSON."""
    while True:
        own = text.count(_MARK) + text.count("ue000") + text.count("uE000")
        mark = _MARK * (1 + own)
        value = _decoder(mark).decode(text)
        if not isinstance(value, str) or value.startswith(mark):
            return value, mark
        text = value


def _roots(value, mark: str, layout: Layout) -> Iterator[tuple[object, str]]:
    """(record object, mark of its numbers) in document order; what is no object at such a place is None and keeps its place."""
    if isinstance(value, str) and not value.startswith(mark):
        try:
            value, mark = _load(value)
        except ValueError:
            yield None, mark
            return
    if isinstance(value, list):
        for v in value:
            yield from _roots(v, mark, layout)
    elif isinstance(value, dict):
        wrapped = [] if any(b in value for b in layout.blocks) else [w for w in layout.wrappers if w in value]
        for w in wrapped:
            yield from _roots(value[w], mark, layout)
        if not wrapped:
            yield value, mark
    else:
        yield None, mark


def _canonical(value, mark: str) -> str:
    """JSON with sorted keys, no blanks and numbers as written."""
    text = _ENCODE(value)
    return _marked(mark).sub(r"\1", text) if mark in text else text


def _clean(s: str) -> str:
    """Lone surrogates cannot leave Python; they become replacement characters."""
    return s if s.isascii() else s.encode("utf-8", "replace").decode()


def _hash(content: str) -> bytes:
    return hashlib.blake2b(content.encode("utf-8", "surrogatepass"), digest_size=16).digest()


class _Walk:
    """Occurrences and contents of the objects of one record object."""

    __slots__ = ("found", "contents", "quoted", "number")

    def __init__(self, quoted: dict[str, str], number: str) -> None:
        self.number = number
        self.found: list[tuple] = []
        self.contents: dict[bytes, str] = {}
        self.quoted = quoted

    def seal(self, obj: dict, path: str, depth: int) -> bytes:
        """The hash of an object; occurrences of the objects right below it are added with it as their parent."""
        below: list[tuple] = []
        shallow = obj
        for k, v in obj.items():
            if isinstance(v, dict | list):
                q = self.quoted.get(k)
                if q is None:
                    if len(self.quoted) > SENT_MEMORY:
                        self.quoted.clear()
                    q = self.quoted[k] = f"[{json.dumps(k, ensure_ascii=False)}]"
                marked = self.mark(v, k, path + q, None, depth + 1, below)
                if marked is not v:
                    if shallow is obj:
                        shallow = dict(obj)
                    shallow[k] = marked
        content = _canonical(shallow, self.number)
        h = _hash(content)
        self.contents[h] = content
        for at, d, field, places, child in below:
            self.found.append((at, d, field, places, child, h))
        return h

    def mark(self, v, field: str, at: str, places: str | None, depth: int, below: list):
        """``v`` with the objects in it replaced by their hashes."""
        if isinstance(v, dict):
            h = self.seal(v, at, depth)
            below.append((at, depth, field, places, h))
            return {"#": h.hex()}
        if isinstance(v, list) and any(isinstance(x, dict | list) for x in v):
            outer = "" if places is None else places + "."
            return [self.mark(x, field, f"{at}[{i}]", f"{outer}{i}", depth, below) if isinstance(x, dict | list) else x for i, x in enumerate(v)]
        return v


def _flattener(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(_DEEPEST)
        kinds = (pa.bool_(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string())
        schema = pa.schema([(c.split()[0], t) for c, t in zip(_SCHEMA.split(", "), kinds)])
        sent: set[bytes] = set()
        quoted: dict[str, str] = {}
        for b in batches:
            rows: list[tuple] = []
            for record_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if body is None:
                    continue
                try:
                    roots = list(_roots(*_load(body), layout))
                except (ValueError, RecursionError):
                    continue
                for root_no, (root, number) in enumerate(roots):
                    if root is None:
                        continue
                    walk = _Walk(quoted, number)
                    top = walk.seal(root, "$", 0)
                    rows.append((False, record_id, root_no, "$", 0, None, None, top, None, None))
                    rows += [(False, record_id, root_no, _clean(path), depth, _clean(field), places, h, parent, None) for path, depth, field, places, h, parent in walk.found]
                    for h, content in walk.contents.items():
                        if h not in sent:
                            if len(sent) >= SENT_MEMORY:
                                sent.clear()
                            sent.add(h)
                            rows.append((True, None, None, None, None, None, None, h, None, _clean(content)))
                if len(rows) >= 50_000:
                    yield _batch(rows, schema)
                    rows = []
            yield _batch(rows, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def flatten_objects(records: DataFrame, id_col: str, body_col: str, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """(bridge, objects) of every object in the bodies, from the record objects down, in any field and array at any depth.

    bridge: (record_id, root_no, path, depth, field_name, places, object_hash,
    parent_hash), one row per occurrence; root_no is the place of the record
    object in its body; the record object itself has path ``$``, depth 0 and no
    parent; places are the ordinals in the arrays between the parent's field
    and the object, divided by points, null for a lone object, and stand in the
    path as ``[place]`` after ``["field"]``: a lone object and a list of one
    differ, as their parents' hashes do.  objects: (object_hash, content), one row per distinct object,
    its content canonical JSON in which every object below it stands as
    ``{"#": hash}``.  A null body, a text that is no JSON and values that are
    no objects give nothing; null elements keep their place.  JSON texts inside
    JSON texts are opened however often they are wrapped.  Of a repeated key in
    one object the last value counts.  Exact row copies count once.
    """
    once = records.select(F.col(id_col).cast("long"), F.col(body_col)).where(F.col(body_col).isNotNull()).distinct()
    flat = materialize(once.mapInArrow(_flattener(layout), _SCHEMA), "nested")
    bridge = flat.where(~F.col("is_object")).drop("is_object", "content")
    # The hash decides the content; with both as keys, what a reader asks of the content reaches the scan.
    objects = flat.where("is_object").select("object_hash", "content").distinct()
    return bridge, objects


def block_rows(bridge: DataFrame, layout: Layout) -> DataFrame:
    """The occurrences in the named blocks and in their inner arrays.

    Adds ``block_name`` and ``item_path``: the place in the block (``0`` for a
    lone object), for objects of inner arrays followed by ``.`` and the place
    there.
    """
    rows = bridge.where(F.col("depth").between(1, 2) & ~F.coalesce(F.col("places").contains("."), F.lit(False)))
    own = (F.col("depth") == 1) & F.col("field_name").isin(*layout.blocks)
    inner = (F.col("depth") == 2) & F.col("field_name").isin(*layout.inner) & F.col("places").isNotNull()
    # An inner object's path without its own field and place is its parent's.
    tail = F.length(F.concat(F.lit('[""]'), "field_name", F.lit("[]"), "places"))
    above = F.substring(F.col("path"), F.lit(1), F.length("path") - tail)
    block, place = F.lit(None).cast("string"), F.lit(None).cast("string")
    for b in layout.blocks:
        prefix = f"$[{json.dumps(b)}]"
        rest = F.substring(above, len(prefix) + 1, 20)
        here = above.startswith(prefix) & ~rest.contains("][") & ~rest.contains('"')
        block, place = F.when(here, b).otherwise(block), F.when(here, F.when(rest == "", "0").otherwise(F.translate(rest, "[]", ""))).otherwise(place)
    rows = rows.where(own | inner).withColumns({"block_name": F.when(own, F.col("field_name")).otherwise(block), "item_path": F.when(own, F.coalesce("places", F.lit("0"))).otherwise(F.concat(place, F.lit("."), "places"))})
    return rows.where(F.col("item_path").isNotNull())


def owner_keys(rows: DataFrame, objects: DataFrame, key_of: dict[str, str]) -> DataFrame:
    """Block rows with ``key_value``: a field of the block's object (of the parent for inner objects).

    ``key_of`` names the key field of each block.  The key is the field's text,
    blank if absent or null.
    """
    named = functools.reduce(Column.__or__, [F.col("content").contains(_field(k)) for k in key_of.values()])
    keys = objects.where(named).select(F.col("object_hash").alias("_h"), *[_scalar_text("content", k).alias(f"_k_{b}") for b, k in key_of.items()])
    value = F.lit(None).cast("string")
    for b in key_of:
        value = F.when(F.col("block_name") == b, F.col(f"_k_{b}")).otherwise(value)
    joined = rows.withColumn("_h", F.when(F.col("depth") == 1, F.col("object_hash")).otherwise(F.col("parent_hash"))).join(keys, "_h", "left")
    return joined.select(*rows.columns, F.coalesce(value, F.lit("")).alias("key_value"))


def _field(key: str) -> str:
    return json.dumps(key, ensure_ascii=False) + ":"


def _scalar_text(content: str, key: str) -> Column:
    """A field of canonical JSON as text; only contents that hold the name are parsed."""
    return F.when(F.col(content).contains(_field(key)), F.get_json_object(content, f"$.{key}"))
