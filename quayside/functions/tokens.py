"""Tokens for sensitive values, built from digest and cipher expressions.

Deterministic tokens keep joins and counts working, so they show which rows hold equal values and
how often. Use ``redact`` where that must not be seen.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

KEY_CONF = "spark.quayside.token.key"
KEY_ENV = "QUAYSIDE_TOKEN_KEY"
_BLOCK = 64


def token_key(spark: SparkSession) -> bytes:
    """The token key, as hex text in the session's settings or in the driver's environment."""
    text = spark.conf.get(KEY_CONF, None) or os.environ.get(KEY_ENV)
    if not text:
        raise ValueError(f"no token key: set {KEY_CONF} or {KEY_ENV} to hex text")
    return bytes.fromhex(text)


def hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    """The inner and outer key block of HMAC-SHA256 (RFC 2104)."""
    block = (hashlib.sha256(key).digest() if len(key) > _BLOCK else key).ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def derive_key(key: bytes, use: str) -> bytes:
    """A 256-bit key for one use, so that tokens and ciphers never share one."""
    return hashlib.sha256(use.encode() + b"\0" + key).digest()


def hmac_token(value: Column, key: bytes) -> Column:
    """HMAC-SHA256 of the value's text as hex; NULL stays NULL."""
    inner, outer = (F.lit(bytearray(pad)) for pad in hmac_pads(key))
    text = F.encode(value.cast("string"), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, text), 256))), 256)


def seal_token(value: Column, key: bytes) -> Column:
    """A token a key holder can open: AES-GCM whose start vector is taken from the value's HMAC.

    Equal values give equal tokens, a changed token does not open, and blocks of long values do
    not show through.
    """
    vector = F.unhex(F.substring(hmac_token(value, derive_key(key, "vector")), 1, 24))
    cipher = F.lit(bytearray(derive_key(key, "cipher")))
    text = F.encode(value.cast("string"), "UTF-8")
    return F.base64(F.aes_encrypt(text, cipher, F.lit("GCM"), F.lit("DEFAULT"), vector))


def open_token(token: Column, key: bytes) -> Column:
    """The value inside a :func:`seal_token` token; NULL for one that this key does not open."""
    cipher = F.lit(bytearray(derive_key(key, "cipher")))
    return F.decode(F.try_aes_decrypt(F.unbase64(token), cipher, F.lit("GCM")), "UTF-8")


def mask(value: Column, keep: int = 4, fill: str = "*") -> Column:
    """Every character but the last ``keep`` replaced."""
    text = value.cast("string")
    hidden = F.greatest(F.length(text) - F.lit(keep), F.lit(0))
    return F.concat(F.repeat(F.lit(fill), hidden), F.right(text, F.lit(keep)))


def redact(value: Column, text: str = "[REDACTED]") -> Column:
    """A fixed text for every value; NULL stays NULL."""
    return F.when(value.isNotNull(), F.lit(text))
