"""Test-side encoder: table rows to datalog bytes, driven by the same registry."""
from __future__ import annotations

import struct

from dieflow.sources.registry import layout_of

_STRUCT = {"U1": "B", "U2": "H", "U4": "I", "I1": "b", "I2": "h", "I4": "i", "R4": "f", "R8": "d", "B1": "B"}
_TAGS = {"B0": 0, "U1": 1, "U2": 2, "U4": 3, "I1": 4, "I2": 5, "I4": 6, "R4": 7, "R8": 8, "Cn": 10, "Bn": 11, "Dn": 12, "N1": 13}


def _text(value) -> bytes:
    data = value if isinstance(value, bytes) else (value or "").encode("latin-1")
    return bytes([len(data)]) + data


def _one(kind: str, value, order: str) -> bytes:
    if kind in _STRUCT:
        return struct.pack(order + _STRUCT[kind], value or 0)
    if kind == "C1":
        return (value or " ").encode("latin-1")
    if kind in ("Cn", "Bn"):
        return _text(value)
    if kind == "Dn":
        n_bits, bits = value or (0, b"")
        return struct.pack(order + "H", n_bits) + bits
    if kind == "Vn":
        tag, inner = value
        if tag == "B0":
            return bytes([0, 0])
        if tag == "N1":
            return bytes([13, inner << 4])
        return bytes([_TAGS[tag]]) + _one(tag, inner, order)
    raise ValueError(kind)


def _many(kind: str, values, order: str) -> bytes:
    if kind == "N1":
        padded = list(values) + [0] * (len(values) % 2)
        return bytes(padded[i] << 4 | padded[i + 1] for i in range(0, len(padded), 2))
    return b"".join(_one(kind, v, order) for v in values)


def body(record_type: str, values: dict, little: bool, upto: str | None = None) -> bytes:
    """Body bytes; ``upto`` ends the record early, before that field."""
    order, out = "<" if little else ">", b""
    for field in layout_of(record_type).fields:
        if field.name == upto:
            break
        value = values.get(field.name)
        out += _many(field.kind, value or [], order) if field.count_field else _one(field.kind, value, order)
    return out


def record(record_type: str, values: dict, little: bool = True, upto: str | None = None) -> bytes:
    layout, data = layout_of(record_type), body(record_type, values, little, upto)
    return struct.pack(("<" if little else ">") + "HBB", len(data), layout.typ, layout.sub) + data


def datalog(records: list[tuple[str, dict]], little: bool = True) -> bytes:
    """A file: FAR followed by the given records."""
    far = record("FAR", {"CPU_TYPE": 2 if little else 1, "STDF_VER": 4}, little)
    return far + b"".join(record(t, v, little) for t, v in records)
