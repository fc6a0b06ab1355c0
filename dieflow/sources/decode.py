"""Typed columns from record bodies.

A batch of bodies of one type is decoded field by field for all records at once:
each field reads at a vector of positions and moves that vector on.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from dieflow.sources.frames import HASH, binary_array, frame_batches, gather, record_codes, walk_units
from dieflow.sources.registry import Field, Layout, layout_of, record_types

_NUMPY = {
    "U1": "u1", "U2": "u2", "U4": "u4", "I1": "i1", "I2": "i2", "I4": "i4",
    "R4": "f4", "R8": "f8", "B1": "u1", "C1": "u1",
}
# Tags of generic data elements and their types.
_GENERIC_TAGS = {
    0: "B0", 1: "U1", 2: "U2", 3: "U4", 4: "I1", 5: "I2", 6: "I4", 7: "R4", 8: "R8", 10: "Cn", 11: "Bn", 12: "Dn", 13: "N1",
}


class _Cursor:
    """Read positions of every body in a batch."""

    def __init__(self, bodies: pa.Array, little: np.ndarray):
        offsets = np.frombuffer(bodies.buffers()[1], np.int32)[bodies.offset : bodies.offset + len(bodies) + 1].astype(np.int64)
        values = bodies.buffers()[2]
        self.data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(1, np.uint8)
        self.pos, self.end, self.little = offsets[:-1].copy(), offsets[1:], little

    def _numbers(self, at: np.ndarray, little: np.ndarray, dtype: str) -> np.ndarray:
        width = np.dtype(dtype).itemsize
        raw = self.data[np.minimum(at[:, None] + np.arange(width), len(self.data) - 1)]
        if width > 1:
            raw[~little] = raw[~little][:, ::-1]
        return np.ascontiguousarray(raw).view("<" + dtype).ravel()

    def fixed(self, dtype: str) -> tuple[np.ndarray, np.ndarray]:
        width = np.dtype(dtype).itemsize
        valid = self.pos + width <= self.end
        values = self._numbers(self.pos, self.little, dtype)
        self.pos = np.where(valid, self.pos + width, self.end)
        return values, valid

    def counted(self, per_unit: int, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Length-prefixed bytes: the count, starts, byte lengths and validity."""
        count, valid = self.fixed(prefix)
        count = np.where(valid, count.astype(np.int64), 0)
        length = np.minimum(-(-count // per_unit), self.end - self.pos)
        start = self.pos
        self.pos = start + length
        return count, start, length, valid

    def text(self, wanted: bool) -> pa.Array | None:
        _, start, length, valid = self.counted(1, "u1")
        return _strings(*gather(self.data, start, length), valid) if wanted else None

    def array(self, dtype: str, count: np.ndarray) -> pa.Array:
        width = np.dtype(dtype).itemsize
        count = np.minimum(count, (self.end - self.pos) // width)
        offsets = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(self.pos - width * offsets[:-1], count) + width * np.arange(offsets[-1])
        values = self._numbers(at, np.repeat(self.little, count), dtype)
        self.pos = self.pos + width * count
        return _lists(offsets, pa.array(values), count > 0)

    def nibbles(self, count: np.ndarray) -> pa.Array:
        used = np.minimum((count + 1) // 2, self.end - self.pos)
        count = np.minimum(count, 2 * used)
        offsets = np.concatenate([[0], np.cumsum(count)])
        place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], count)
        packed = self.data[np.repeat(self.pos, count) + place // 2] if len(place) else np.zeros(0, np.uint8)
        self.pos = self.pos + used
        return _lists(offsets, pa.array(np.where(place % 2 == 0, packed >> 4, packed & 15).astype(np.int8)), count > 0)


def _strings(data: np.ndarray, offsets: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Latin-1 bytes as text."""
    high = data >= 0x80
    if high.any():
        # Such a byte becomes two in UTF-8.
        more = np.concatenate([[0], np.cumsum(high)])
        place = np.arange(len(data)) + more[:-1]
        wide = np.empty(len(data) + more[-1], np.uint8)
        wide[place] = np.where(high, 0xC0 | data >> 6, data)
        wide[place[high] + 1] = 0x80 | data[high] & 0x3F
        data, offsets = wide, offsets + more[offsets]
    return binary_array(data, offsets, valid).view(pa.string())


_HEX = np.frombuffer(b"".join(b"%02X" % i for i in range(256)), np.uint8).reshape(256, 2)


def _hex(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return binary_array(_HEX[data].ravel(), 2 * offsets).view(pa.string())


def _lists(offsets: np.ndarray, values: pa.Array, valid: np.ndarray) -> pa.Array:
    mask = pa.array(valid).buffers()[1]
    return pa.Array.from_buffers(
        pa.list_(values.type), len(offsets) - 1, [mask, pa.py_buffer(offsets.astype(np.int32))], children=[values]
    )


def _part(cursor: _Cursor, rows: np.ndarray) -> _Cursor:
    """A cursor over some of the bodies."""
    part = object.__new__(_Cursor)
    part.data, part.pos, part.end, part.little = cursor.data, cursor.pos[rows], cursor.end[rows], cursor.little[rows]
    return part


def _gathered(n: int, rows: list[np.ndarray], values: list[pa.Array]) -> pa.Array:
    """Lists per body from the values found step by step; NULL for none."""
    if not rows:
        return _lists(np.zeros(n + 1, np.int64), values[0].slice(0, 0), np.zeros(n, bool))
    row = np.concatenate(rows)
    sizes = np.bincount(row, minlength=n)
    ordered = pa.concat_arrays(values).take(pa.array(np.argsort(row, kind="stable")))
    return _lists(np.concatenate([[0], np.cumsum(sizes)]), ordered, sizes > 0)


_TAGGED = pa.struct([("tag", pa.string()), ("value", pa.string())])


def _tagged_value(part: _Cursor, tag: str) -> pa.Array:
    """The next value of all bodies of a part, which have the same tag, as text."""
    n = len(part.pos)
    if tag in _NUMPY and tag not in ("B1", "C1"):
        values, valid = part.fixed(_NUMPY[tag])
        return pa.array([str(v) if ok else None for v, ok in zip(values.tolist(), valid.tolist())], pa.string())
    if tag == "Cn":
        _, start, length, _ = part.counted(1, "u1")
        return _strings(*gather(part.data, start, length), np.ones(n, bool))
    if tag in ("Bn", "Dn"):
        _, start, length, _ = part.counted(*((1, "u1") if tag == "Bn" else (8, "u2")))
        return _hex(*gather(part.data, start, length))
    values, valid = part.fixed("u1")
    return pa.array([str(v >> 4) if ok and tag == "N1" else None for v, ok in zip(values.tolist(), valid.tolist())], pa.string())


def _tagged_lists(cursor: _Cursor, count: np.ndarray) -> pa.Array:
    """Tagged values of all bodies: the k-th of every body together, those of one tag at once."""
    rows, values = [], []
    left = np.flatnonzero((count > 0) & (cursor.pos < cursor.end))
    for step in range(1, int(count.max(initial=0)) + 1):
        if not len(left):
            break
        codes = cursor.data[cursor.pos[left]]
        cursor.pos[left] += 1
        for code in np.unique(codes).tolist():
            own = left[codes == code]
            tag = _GENERIC_TAGS.get(code)
            if tag is None:
                text = pa.nulls(len(own), pa.string())
            else:
                part = _part(cursor, own)
                text = _tagged_value(part, tag)
                cursor.pos[own] = part.pos
            rows.append(own)
            values.append(pa.StructArray.from_arrays([pa.repeat(pa.scalar(tag or f"?{code}"), len(own)), text], fields=list(_TAGGED)))
        left = left[(count[left] > step) & (cursor.pos[left] < cursor.end[left])]
    return _gathered(len(count), rows, values or [pa.array([], _TAGGED)])


def _field(cursor: _Cursor, field: Field, counts: dict[str, np.ndarray], wanted: bool) -> pa.Array | None:
    kind = field.kind
    arrow_type = to_arrow_type(field.spark_type)
    if field.count_field:
        count = counts[field.count_field]
        if kind == "Cn":
            return _string_lists(cursor, count)
        if kind == "Vn":
            return _tagged_lists(cursor, count).cast(arrow_type)
        return cursor.nibbles(count) if kind == "N1" else cursor.array(_NUMPY[kind], count).cast(arrow_type)
    if kind == "Cn":
        return cursor.text(wanted)
    if kind == "Bn":
        _, start, length, valid = cursor.counted(1, "u1")
        return binary_array(*gather(cursor.data, start, length), valid) if wanted else None
    if kind == "Dn":
        bits, start, length, valid = cursor.counted(8, "u2")
        if not wanted:
            return None
        children = [pa.array(bits.astype(np.int32)), binary_array(*gather(cursor.data, start, length))]
        return pa.StructArray.from_arrays(children, fields=list(arrow_type), mask=pa.array(~valid))
    values, valid = cursor.fixed(_NUMPY[kind])
    if kind in ("U1", "U2"):
        counts[field.name] = np.where(valid, values.astype(np.int64), 0)
    if kind == "C1":
        keep = (valid & (values != 0)).astype(np.int64)
        return _strings(*gather(values, np.arange(len(values)), keep), valid)
    return pa.array(values, mask=~valid).cast(arrow_type) if wanted else None


def _string_lists(cursor: _Cursor, count: np.ndarray) -> pa.Array:
    """Lists of texts: the k-th text of every body together. Texts past the end are empty."""
    rows, values = [], []
    for step in range(int(count.max(initial=0))):
        live = np.flatnonzero(count > step)
        part = _part(cursor, live)
        _, start, length, _ = part.counted(1, "u1")
        cursor.pos[live] = part.pos
        rows.append(live)
        values.append(_strings(*gather(cursor.data, start, length), np.ones(len(live), bool)))
    return _gathered(len(count), rows, values or [pa.array([], pa.string())])


def decode_bodies(layout: Layout, bodies: pa.Array, little: np.ndarray, wanted: set[str]) -> dict[str, pa.Array]:
    """Decode every wanted field of a batch of bodies of one record type."""
    cursor, counts, out = _Cursor(bodies, little), {}, {}
    last = max((i for i, f in enumerate(layout.fields) if f.name in wanted), default=-1)
    for field in layout.fields[: last + 1]:
        column = _field(cursor, field, counts, field.name in wanted)
        if field.name in wanted:
            out[field.name] = column
    return out


def _little(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("little_endian").fill_null(True).to_numpy(zero_copy_only=False)


def decode_batches(batches: Iterator[pa.RecordBatch], layout: Layout, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    wanted = set(schema.names) - {"path", "record_index"}
    for batch in batches:
        fields = decode_bodies(layout, batch.column("body"), _little(batch), wanted)
        columns = [fields[n] if n in fields else batch.column(n) for n in schema.names]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


_KEYS = [T.StructField("path", T.StringType()), T.StructField("record_index", T.LongType())]


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])


def decode(frames: DataFrame, record_type: str, fields: list[str] | None = None) -> DataFrame:
    """Typed rows of one record type: path, record_index and the (chosen) fields.

    A field past the end of its body is NULL.
    """
    layout = layout_of(record_type)
    schema = T.StructType(_KEYS + layout.schema(fields).fields)
    arrow = _arrow_schema(schema)
    chosen = frames.filter((F.col("rec_typ") == layout.typ) & (F.col("rec_sub") == layout.sub) & F.col("error").isNull())
    return chosen.select("path", "record_index", "little_endian", "body").mapInArrow(
        lambda it: decode_batches(it, layout, arrow), schema
    )


def decode_ptr(frames: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return decode(frames, "PTR", fields)


def decode_mpr(frames: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return decode(frames, "MPR", fields)


def decode_ftr(frames: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return decode(frames, "FTR", fields)


def decode_prr(frames: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return decode(frames, "PRR", fields)


def decode_hbr(frames: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return decode(frames, "HBR", fields)


def decode_sbr(frames: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return decode(frames, "SBR", fields)


def decode_mir(frames: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return decode(frames, "MIR", fields)


def decode_other(frames: DataFrame, record_type: str, fields: list[str] | None = None) -> DataFrame:
    return decode(frames, record_type, fields)


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill fields a short record left out: numbers 0, single characters a space, other text empty."""
    letters = {f.name for name in record_types() for f in layout_of(name).fields if f.kind == "C1"}
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.fillna(0, subset=numeric).fillna(" ", subset=[n for n in text if n in letters]).fillna("", subset=text)


def merged_fields(fields_by_type: dict[str, list[str]]) -> list[T.StructField]:
    """The union of the chosen fields of several types; those of one name must have one type."""
    merged: dict[str, T.StructField] = {}
    for name, fields in fields_by_type.items():
        for f in layout_of(name).schema(fields):
            if merged.setdefault(f.name, f).dataType != f.dataType:
                raise ValueError(f"{f.name} has different types in {list(fields_by_type)}")
    return list(merged.values())


# The type of the row that holds a file's hash.
FILE = "FILE"


def read_records(files: DataFrame, fields_by_type: dict[str, list[str]], hashes: bool = False) -> DataFrame:
    """Walk and decode in one pass over the files.

    One row per record of the chosen types: path, record_index, record_type and
    the union of the chosen fields, NULL where a type has no such field. Fields of
    the same name must have the same type. Raw bodies never leave the Python task.
    ``hashes`` adds a column ``file_hash`` and a row of type FILE for every file that is walked in
    one piece, hashed in the same read.
    """
    layouts = {t: layout_of(t) for t in fields_by_type}
    schema = T.StructType(_KEYS + [T.StructField("record_type", T.StringType()), *merged_fields(fields_by_type), T.StructField("error", T.StringType())])
    if hashes:
        schema = schema.add("file_hash", T.StringType())
    arrow, codes = _arrow_schema(schema), record_codes(fields_by_type)
    chosen = {t: set(fields) for t, fields in fields_by_type.items()}

    def run(batches):
        for batch in frame_batches(batches, codes, hashes):
            yield from typed_batches(batch, layouts, chosen, arrow)

    return walk_units(files).mapInArrow(run, schema)


def typed_batches(batch: pa.RecordBatch, layouts: dict[str, Layout], chosen: dict[str, set[str]], schema: pa.Schema):
    def shaped(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    broken = batch.filter(batch.column("error").is_valid())
    if broken.num_rows:
        yield shaped({n: broken.column(n) for n in ("path", "record_index", "error")}, broken.num_rows)
    good = batch.filter(batch.column("error").is_null())
    if "file_hash" in schema.names:
        files = good.filter(pa.compute.equal(good.column("rec_typ"), HASH))
        if files.num_rows:
            yield shaped({"path": files.column("path"), "record_type": pa.repeat(pa.scalar(FILE), files.num_rows), "file_hash": files.column("body").cast(pa.string())}, files.num_rows)
    kinds = good.column("rec_typ").to_numpy(zero_copy_only=False).astype(np.int32) * 256 + good.column("rec_sub").to_numpy(zero_copy_only=False)
    for name, layout in layouts.items():
        part = good.filter(pa.array(kinds == layout.typ * 256 + layout.sub))
        n = part.num_rows
        if n == 0:
            continue
        columns = decode_bodies(layout, part.column("body"), _little(part), chosen[name])
        yield shaped(columns | {"path": part.column("path"), "record_index": part.column("record_index"), "record_type": pa.repeat(pa.scalar(name), n)}, n)
