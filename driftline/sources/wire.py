"""Manifests in the protobuf wire format, read by field numbers without a compiled schema."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers, names and types of the fields of the two messages.
RESOURCE_FIELDS = {
    1: ("id", "int32"), 2: ("filepath", "string"), 3: ("name", "string"), 4: ("size", "int32"), 5: ("crc", "uint32"),
    6: ("priority", "int32"), 7: ("tagid", "int32s"), 8: ("dependencie", "int32s"), 9: ("state", "int32"), 10: ("md5", "string"),
    11: ("objectName", "string"), 12: ("generation", "uint64"), 13: ("uploadVersionId", "int32"),
}
MANIFEST_FIELDS = {1: ("revision", "int32"), 2: ("assetBundleList", "resources"), 3: ("tagname", "strings"), 4: ("resourceList", "resources"), 5: ("urlFormat", "string")}

_TYPES = {"int32": T.IntegerType(), "uint32": T.LongType(), "uint64": T.DecimalType(20, 0), "string": T.StringType(), "int32s": T.ArrayType(T.IntegerType()), "strings": T.ArrayType(T.StringType())}
RESOURCE = T.StructType([T.StructField(n, _TYPES[t]) for n, t in RESOURCE_FIELDS.values()])
MANIFEST = T.StructType([T.StructField(n, _TYPES.get(t) or T.ArrayType(RESOURCE)) for n, t in MANIFEST_FIELDS.values()])
_EMPTY = {"int32": 0, "uint32": 0, "uint64": 0, "string": ""}


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise ValueError("broken number in a message")
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return value & 0xFFFFFFFFFFFFFFFF, at


def records(data: bytes):
    """(field number, int or bytes) of each record of a message."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind in (1, 2, 5):
            size, at = varint(data, at) if kind == 2 else ((8 if kind == 1 else 4), at)
            if at + size > len(data):
                raise ValueError("a message ends within a record")
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"records of kind {kind} aren't supported")
        yield tag >> 3, value


def int32(value: int) -> int:
    value &= 0xFFFFFFFF
    return value - (1 << 32) if value >> 31 else value


def _numbers(value: int | bytes) -> list[int]:
    """A repeated number: single, or packed."""
    if isinstance(value, int):
        return [int32(value)]
    out, at = [], 0
    while at < len(value):
        number, at = varint(value, at)
        out.append(int32(number))
    return out


def decode(data: bytes, fields: dict[int, tuple[str, str]]) -> dict:
    """A message as a dict of all its fields: absent ones are empty, unknown ones are skipped, of a repeated single field the last counts."""
    out = {name: _EMPTY.get(kind, None) if kind in _EMPTY else [] for name, kind in fields.values()}
    for number, value in records(data):
        if number not in fields:
            continue
        name, kind = fields[number]
        if kind == "int32s":
            out[name] += _numbers(value)
        elif kind == "strings":
            out[name].append(value.decode())
        elif kind == "resources":
            out[name].append(decode(value, RESOURCE_FIELDS))
        elif kind == "string":
            out[name] = value.decode()
        else:
            out[name] = int32(value) if kind == "int32" else value & (0xFFFFFFFF if kind == "uint32" else 0xFFFFFFFFFFFFFFFF)
    if "generation" in out:
        out["generation"] = Decimal(out["generation"])
    return out


@F.udf(MANIFEST)
def decode_manifest(data):
    """A manifest is one row, so that rows needn't be batched; null for null."""
    return None if data is None else decode(bytes(data), MANIFEST_FIELDS)
