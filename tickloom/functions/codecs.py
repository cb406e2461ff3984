"""Byte-level functions: book checksums (JVM-side), base58, FNV-1a, LZ4 frames and gzip (Arrow batches)."""

from __future__ import annotations

import gzip
import struct
import zlib
from decimal import Decimal

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, StringType

# The base58 alphabet, the FNV-1a 64 offset and prime.
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
FNV_OFFSET, FNV_PRIME = 0xCBF29CE484222325, 0x100000001B3
#: Bytes that a decoded object may have at most.
OBJECT_CAP = 256 << 20
FRAME_CAP = 64 << 20


def okx_checksum(bids: Column, asks: Column) -> Column:
    """Signed CRC32 over the first 25 ranks, bid before ask in each, ``price:size`` as sent.

    Sides are arrays of struct(price, size), best first, in wire text.
    """
    # Sides stand outside of any lambda: inside, whatever makes them is worked out again for each rank.
    none = F.expr("cast(array() as array<struct<price: string, size: string>>)")
    ranks = F.arrays_zip(*(F.slice(F.coalesce(side, none), 1, 25) for side in (bids, asks)))
    text = lambda level: F.when(level.isNotNull(), F.concat_ws(":", level["price"], level["size"]))
    joined = F.array_join(F.flatten(F.transform(ranks, lambda x: F.array(text(x["0"]), text(x["1"])))), ":")
    crc = F.crc32(joined.cast("binary"))
    return F.when(crc > 2147483647, crc - 4294967296).otherwise(crc)


def kraken_checksum(bids: Column, asks: Column) -> Column:
    """CRC32 over ten asks, then ten bids: the digits of price and size without point and leading zeros."""
    digits = lambda x: F.regexp_replace(F.replace(x, F.lit("."), F.lit("")), "^0+", "")
    side = lambda levels: F.array_join(F.transform(F.slice(levels, 1, 10), lambda x: F.concat(digits(x["price"]), digits(x["size"]))), "")
    return F.crc32(F.concat(side(asks), side(bids)).cast("binary"))


def kraken_crc(bids: list[tuple[str, str]], asks: list[tuple[str, str]]) -> int:
    """The same for one book, best level first."""
    text = "".join(x.replace(".", "").lstrip("0") for level in (*asks[:10], *bids[:10]) for x in level)
    return zlib.crc32(text.encode())


def okx_crc(bids: list[tuple[str, str]], asks: list[tuple[str, str]]) -> int:
    """``okx_checksum`` for one book, best level first."""
    text = ":".join(":".join(side[k]) for k in range(min(25, max(len(bids), len(asks)))) for side in (bids, asks) if k < len(side))
    crc = zlib.crc32(text.encode())
    return crc - (1 << 32) if crc >> 31 else crc


#: The checksum of a book by recipe.
RECIPES = {"kraken": kraken_crc, "okx": okx_crc}


def b58encode(data: bytes) -> str:
    number, out = int.from_bytes(data, "big"), ""
    while number:
        number, k = divmod(number, 58)
        out = ALPHABET[k] + out
    return "1" * (len(data) - len(data.lstrip(b"\0"))) + out


def b58decode(text: str) -> bytes | None:
    number = 0
    for c in text:
        k = ALPHABET.find(c)
        if k < 0:
            return None
        number = number * 58 + k
    body = number.to_bytes((number.bit_length() + 7) // 8, "big")
    return b"\0" * (len(text) - len(text.lstrip("1"))) + body


@pandas_udf(StringType())
def base58(data: pd.Series) -> pd.Series:
    return data.map(lambda x: None if x is None else b58encode(bytes(x)))


@pandas_udf(BinaryType())
def address_bytes(text: pd.Series) -> pd.Series:
    """The 32 bytes of a chain address; null for anything else."""

    def one(x: str | None) -> bytes | None:
        data = b58decode(x) if x else None
        return data if data is not None and len(data) == 32 else None

    return text.map(one)


def fnv1a(data: bytes, state: int = FNV_OFFSET) -> int:
    for b in data:
        state = (state ^ b) * FNV_PRIME & (1 << 64) - 1
    return state


def plain_decimal(x: Decimal) -> str:
    """A decimal's digits without trailing zeros or exponent."""
    text = format(x, "f")
    return text.rstrip("0").rstrip(".") if "." in text else text


def trade_fingerprint(ts_us: int, side: str, price: Decimal, amount: Decimal) -> int:
    return fnv1a(struct.pack("<Q", ts_us) + side.encode() + plain_decimal(price).encode() + plain_decimal(amount).encode())


@pandas_udf(StringType())
def fingerprint(ts_us: pd.Series, side: pd.Series, price: pd.Series, amount: pd.Series) -> pd.Series:
    """The content fingerprint of a print, as 16 hex digits."""
    return pd.Series([f"{trade_fingerprint(*x):016x}" for x in zip(ts_us, side, price, amount, strict=True)])


def content_hash(*columns: Column) -> Column:
    """A JVM-side stand-in where only equality of contents matters."""
    return F.xxhash64(*columns)


def unpacked(data: bytes, codec: str, cap: int) -> bytes:
    """Unpack frames of ``codec`` (any number, concatenated), refusing more than ``cap`` bytes; ValueError where they can't be read."""
    parts, size = [], 0
    try:
        with pa.CompressedInputStream(pa.BufferReader(data), codec) as stream:
            while part := stream.read(min(1 << 20, cap + 1 - size)):
                parts.append(part)
                size += len(part)
                if size > cap:
                    raise ValueError("unpacked data is larger than the cap")
    except OSError as broken:
        raise ValueError(str(broken)) from broken
    return b"".join(parts)


def decode_lz4_frame(data: bytes, cap: int = OBJECT_CAP) -> bytes:
    """Decode LZ4 frames, refusing more than ``cap`` bytes."""
    return unpacked(data, "lz4", cap) if data else b""


def inflate(data: bytes, cap: int = FRAME_CAP) -> bytes:
    """Gunzip a frame, refusing more than ``cap`` bytes."""
    return unpacked(data, "gzip", cap)


def unpacked_object(key: str, data: bytes, cap: int = OBJECT_CAP) -> bytes:
    """An archive object's bytes, by the ending of its key."""
    codec = {"gz": "gzip", "lz4": "lz4"}.get(key.rsplit(".", 1)[-1])
    return unpacked(data, codec, cap) if codec and data else data


def deflate(data: bytes) -> bytes:
    return gzip.compress(data)


@pandas_udf(StringType())
def lz4_text(data: pd.Series) -> pd.Series:
    """The UTF-8 text of LZ4-framed objects; null for what cannot be decoded."""

    def one(x: bytes | None) -> str | None:
        try:
            return None if x is None else decode_lz4_frame(bytes(x)).decode()
        except ValueError:
            return None

    return data.map(one)
