"""Label files that describe fixed-width records, as layouts for `binary.records` and as fields of bit strings."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numpy kinds of the labels' data types.
KINDS = {
    "ASCII_REAL": "S",
    "CHARACTER": "S",
    "DATE": "S",
    "TIME": "S",
    "MSB_BIT_STRING": "V",
    "MSB_INTEGER": ">i",
    "MSB_UNSIGNED_INTEGER": ">u",
    "LSB_INTEGER": "<i",
    "LSB_UNSIGNED_INTEGER": "<u",
    "UNSIGNED_INTEGER": ">u",
    "INTEGER": ">i",
    "IEEE_REAL": ">f",
    "PC_REAL": "<f",
}
SIZES = {"i": (1, 2, 4, 8), "u": (1, 2, 4, 8), "f": (4, 8)}


def columns(text: str) -> list[dict]:
    """The COLUMN objects of a label, in order: their entries, and under BITS_ their BIT_COLUMN objects."""
    found, stack = [], []
    for name, value in re.findall(r"^\s*([A-Z_^]+)\s*=\s*(.*?)\s*(?:/\*.*)?$", text, re.M):
        value = value.strip('"')
        if name == "OBJECT":
            stack.append({"OBJECT": value, "BITS_": []})
        elif name == "END_OBJECT":
            if not stack or stack[-1]["OBJECT"] != value:
                raise ValueError(f"END_OBJECT = {value} closes nothing")
            done = stack.pop()
            if value == "COLUMN":
                found.append(done)
            elif value == "BIT_COLUMN" and stack:
                stack[-1]["BITS_"].append(done)
        elif stack:
            stack[-1].setdefault(name, value)
    if stack:
        raise ValueError(f"OBJECT = {stack[-1]['OBJECT']} has no end")
    return found


def layout(text: str, extra: tuple[tuple, ...] = ()) -> list[tuple]:
    """numpy's list of (name, type) of a label's columns and what comes after them. Numbers of odd sizes and bit strings are read as bytes (type V); spare columns get names of their own."""
    out, spare = [], 0
    for c in columns(text):
        name, size, kind = c["NAME"], int(c["BYTES"]), KINDS[c["DATA_TYPE"]]
        if name.startswith("SPARE"):
            name, kind, spare = f"SPARE{spare}", "V", spare + 1
        if kind[-1] in SIZES and size not in SIZES[kind[-1]]:
            kind = "V"
        out.append((name, f"{kind}{size}"))
    return out + list(extra)


def bit_fields(text: str) -> dict[str, list[tuple[str, int, int, bool]]]:
    """Of each bit string: its fields' names, first bits from 0, lengths, and whether they are signed. Gaps between fields are errors; spare ones are left out."""
    out = {}
    for c in columns(text):
        end, fields = 0, []
        for b in c["BITS_"]:
            start, bits = int(b["START_BIT"]) - 1, int(b["BITS"])
            if start != end:
                raise ValueError(f"{c['NAME']}: bits {end} to {start} are in no field")
            end = start + bits
            if not b["NAME"].startswith("SPARE"):
                fields.append((b["NAME"], start, bits, b.get("BIT_DATA_TYPE") in ("MSB_INTEGER", "INTEGER")))
        if fields:
            out[c["NAME"]] = fields
    return out


def bits(packed, start: int, length: int, signed: bool = False) -> Column:
    """A field of a binary column, from bit `start` (from 0, the highest of the first byte), up to 56 bits long."""
    c = F.col(packed) if isinstance(packed, str) else packed
    first, last = start // 8, (start + length - 1) // 8
    value = F.conv(F.hex(F.substring(c, first + 1, last - first + 1)), 16, 10).cast("long")
    value = F.shiftright(value, (last + 1) * 8 - start - length).bitwiseAND(F.lit((1 << length) - 1))
    return F.when(value >= 1 << (length - 1), value - (1 << length)).otherwise(value) if signed else value


def type_bytes(bits_: int) -> int:
    """Bytes of the least whole-number type that holds so many bits."""
    for size in SIZES["i"]:
        if bits_ <= 8 * size:
            return size
    raise ValueError(f"no type of {bits_} bits")
