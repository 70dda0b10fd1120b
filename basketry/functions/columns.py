"""Scalar column helpers (F1-F28). All are built-in expressions: they stay in
whole-stage codegen, no Python runs per row."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.schemas import MONEY

# Java BigDecimal(String) grammar: sign, digits with optional point, optional exponent;
# no surrounding whitespace (Spark's own cast would trim it).
DECIMAL_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
LONG_TEXT = r"^[+-]?[0-9]+$"
UUID_TEXT = r"^[0-9a-fA-F]{1,8}-[0-9a-fA-F]{1,4}-[0-9a-fA-F]{1,4}-[0-9a-fA-F]{1,4}-[0-9a-fA-F]{1,12}$"
# documented subset of the bean-validation e-mail rule: local@domain, no spaces
EMAIL_TEXT = r"^[^@\s]+@[^@\s]+$"

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """null, empty or whitespace only."""
    c = col(c)
    return c.isNull() | c.rlike(r"^\s*$")


def blank_to_null(c) -> Column:
    c = col(c)
    return F.when(is_blank(c), F.lit(None).cast("string")).otherwise(c)


def parse_price(c) -> Column:
    """text -> DECIMAL(19,4); blank or malformed (padded included) -> 0."""
    c = col(c)
    parsed = F.when(c.rlike(DECIMAL_TEXT), c.try_cast(MONEY))
    return F.coalesce(F.when(is_blank(c), F.lit(0).cast(MONEY)).otherwise(parsed), F.lit(0).cast(MONEY))


def parse_long(c) -> Column:
    """Java Long.parseLong semantics -> null when not a long."""
    c = col(c)
    return F.when(c.rlike(LONG_TEXT), c.try_cast("bigint"))


def parse_uuid(c) -> Column:
    """UUID text -> canonical lower-case form, null when malformed."""
    c = col(c)
    parts = F.split(c, "-")
    widths = [8, 4, 4, 4, 12]
    canon = F.concat_ws("-", *[F.lpad(F.lower(F.element_at(parts, i + 1)), w, "0")
                               for i, w in enumerate(widths)])
    return F.when(c.rlike(UUID_TEXT) & (F.length(c) <= 36), canon)


def sha256_hex(c) -> Column:
    """SHA-256 of the UTF-8 text, lower-case hex."""
    return F.sha2(col(c), 256)


def _hmac_pads(secret: str, block: int, digest) -> tuple[bytes, bytes]:
    key = secret.encode("utf-8")
    if len(key) > block:
        key = digest(key).digest()
    key = key.ljust(block, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_b64(msg, secret: str, bits: int = 256) -> Column:
    """F16: base64(HMAC-SHA256/512(secret, msg)) with sha2/unhex/concat only.

    The pads are constants, so Catalyst folds them; no UDF is involved.
    """
    block, digest = (64, hashlib.sha256) if bits == 256 else (128, hashlib.sha512)
    ipad, opad = _hmac_pads(secret, block, digest)
    m = col(msg).cast("binary")
    inner = F.unhex(F.sha2(F.concat(F.lit(ipad), m), bits))
    outer = F.unhex(F.sha2(F.concat(F.lit(opad), inner), bits))
    return F.regexp_replace(F.base64(outer), r"[\r\n]", "")


def qr_sign(payload, secret: str) -> Column:
    """F16 sign: 'hmac:' + base64(HMAC-SHA256)."""
    return F.concat(F.lit("hmac:"), hmac_b64(payload, secret, 256))


def qr_verify(payload, signature, secret: str) -> Column:
    """F16 verify: recompute and compare; other prefixes are false."""
    sig = col(signature)
    return F.coalesce(sig.startswith("hmac:") & (sig == qr_sign(payload, secret)), F.lit(False))


def b64url_to_text(c) -> Column:
    """JWT segment -> text (base64url, no padding)."""
    s = F.translate(col(c), "-_", "+/")
    padded = F.concat(s, F.when(F.length(s) % 4 == 2, F.lit("=="))
                      .when(F.length(s) % 4 == 3, F.lit("=")).otherwise(F.lit("")))
    return F.try_to_binary(padded, F.lit("base64")).cast("string")


def b64url(bin_b64: Column) -> Column:
    """standard base64 text -> base64url without padding."""
    return F.regexp_replace(F.translate(bin_b64, "+/", "-_"), "=+$", "")


def epoch_micros(ts) -> Column:
    """Microseconds since 1970 of a UTC wall-clock timestamp.

    Built from the date and the time-of-day fields, which do not depend on the
    session time zone for TIMESTAMP_NTZ (a plain difference of timestamps is
    taken through the session zone and shifts across daylight-saving days)."""
    t = col(ts).cast("timestamp_ntz")
    day_us = F.unix_date(F.to_date(t)).cast("bigint") * F.lit(86_400_000_000)
    tod_us = (F.hour(t).cast("bigint") * F.lit(3_600_000_000) + F.minute(t).cast("bigint") * F.lit(60_000_000)
              + (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint"))
    return day_us + tod_us


def epoch_millis(ts) -> Column:
    """instant -> epoch milliseconds."""
    return F.floor(epoch_micros(ts) / 1000).cast("bigint")


def iso_instant(ts) -> Column:
    """instant -> ISO-8601 text with 0, 3 or 6 fraction digits (Java style),
    formatted from the date/time fields so the session time zone plays no part."""
    t = col(ts).cast("timestamp_ntz")
    us = F.pmod(epoch_micros(t), F.lit(1_000_000))
    base = F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", F.year(t), F.month(t), F.dayofmonth(t),
                           F.hour(t), F.minute(t), F.floor(F.extract(F.lit("SECOND"), t)).cast("int"))
    frac = (F.when(us == 0, F.lit(""))
            .when(us % 1000 == 0, F.concat(F.lit("."), F.lpad((us / 1000).cast("bigint").cast("string"), 3, "0")))
            .otherwise(F.concat(F.lit("."), F.lpad(us.cast("string"), 6, "0"))))
    return F.concat(base, frac, F.lit("Z"))


def email_ok(c) -> Column:
    """documented subset of the e-mail format rule."""
    return col(c).rlike(EMAIL_TEXT)


def length_between(c, lo: int, hi: int) -> Column:
    """character length bounds."""
    n = F.char_length(col(c))
    return (n >= lo) & (n <= hi)
