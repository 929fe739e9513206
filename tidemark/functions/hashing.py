"""Keyed hashing without a UDF."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def hmac_sha256_hex(message: Column, key: bytes) -> Column:
    """HMAC-SHA256 as two nested ``sha2`` calls over padded keys.

    The padded keys appear as literals in plans and event logs; where those
    are not access-controlled, join a keyed table instead.
    """
    if not key:
        raise ValueError("a pseudonymisation key is required")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    padded = key.ljust(_BLOCK, b"\0")
    inner_pad = F.lit(bytearray(b ^ 0x36 for b in padded))
    outer_pad = F.lit(bytearray(b ^ 0x5C for b in padded))
    inner = F.unhex(F.sha2(F.concat(inner_pad, F.encode(message.cast("string"), "UTF-8")), 256))
    return F.sha2(F.concat(outer_pad, inner), 256)


def pseudonym(identifier: Column, key: bytes) -> Column:
    """``PSD_`` and the first 16 bytes of the keyed digest, in hex."""
    return F.concat(F.lit("PSD_"), F.substring(hmac_sha256_hex(identifier, key), 1, 32))
