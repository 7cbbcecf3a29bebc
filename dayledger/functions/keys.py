"""Row keys and pseudonyms (FN-17, FN-18, FN-20 / PII-04), all JVM-side."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, DataType, DateType, DecimalType, DoubleType,
                               FloatType, TimestampNTZType, TimestampType)

# Separators and the NULL token of the surrogate-key convention.
EVENT_KEY_SEPARATOR = "|"
SURROGATE_SEPARATOR = "-"
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
HMAC_BLOCK = 64


def key_text(col: Column | str, dtype: DataType | None = None) -> Column:
    """Engine-independent text of a value for hashing.

    Timestamps are formatted explicitly (microseconds), dates as ISO, floats via
    a fixed decimal form, so the same key comes out of any engine.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.date_format(c, TIMESTAMP_TEXT)
    if isinstance(dtype, DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.cast("decimal(38,10)").cast("string")
    if isinstance(dtype, DecimalType):
        return c.cast("string")
    return c.cast("string")


def event_key(*cols: Column) -> Column:
    """FN-17: ``md5(concat_ws('|', ...))``; NULL parts are skipped, as in the source."""
    return F.md5(F.concat_ws(EVENT_KEY_SEPARATOR, *cols))


def surrogate_key(*cols: Column) -> Column:
    """FN-18: md5 over every part, NULL replaced by a token distinct from ''."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(SURROGATE_SEPARATOR))
        parts.append(F.coalesce(c.cast("string"), F.lit(SURROGATE_NULL_TOKEN)))
    return F.md5(F.concat(*parts))


def surrogate_key_of(df, columns: list[str]) -> Column:
    """FN-18 over named columns of ``df`` with engine-independent value text."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return surrogate_key(*[key_text(c, types[c]) for c in columns])


def _hmac_pads(secret: str) -> tuple[bytes, bytes]:
    key = secret.encode("utf-8")
    if len(key) > HMAC_BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(HMAC_BLOCK, b"\x00")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256_hex(value: Column | str, secret: str) -> Column:
    """FN-20 / PII-04: hex HMAC-SHA256 of the value's UTF-8 text under ``secret``.

    The two pads are computed once on the driver and shipped as literals; the
    per-row work is two ``sha2`` calls inside whole-stage codegen.
    """
    v = F.col(value) if isinstance(value, str) else value
    ipad, opad = _hmac_pads(secret)
    ipad_lit = F.lit(bytearray(ipad)).cast(BinaryType())
    opad_lit = F.lit(bytearray(opad)).cast(BinaryType())
    inner = F.unhex(F.sha2(F.concat(ipad_lit, v.cast("string").cast("binary")), 256))
    return F.sha2(F.concat(opad_lit, inner), 256)
