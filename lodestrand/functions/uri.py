"""Identity columns: C++ names, global URIs, signature hashes, identity keys and point ids. Catalyst expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space (those of Unicode's White_Space and U+001C..U+001F).
WS = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Formats of signature hashes, and the UUID namespace (DNS) of point ids.
SIG_PATTERN = "^sig_[0-9a-f]{8,40}$"
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space at both ends."""
    return F.regexp_replace(_c(c), rf"\A{WS}+|{WS}+\z", "")


def collapse(c: Column | str) -> Column:
    """Every run of white space becomes one space, none at the ends."""
    return strip(F.regexp_replace(_c(c), f"{WS}+", " "))


def _where_odd(c: Column, change) -> Column:
    """Apply ``change`` only to texts with a character other than printable ASCII without blanks; the rest has none to change."""
    return F.when(c.rlike(r"[^\x21-\x7e]"), change(c)).otherwise(c)


def tight_scopes(c: Column | str) -> Column:
    """Remove white space around ``::`` and at the ends."""
    return _where_odd(_c(c), lambda x: strip(F.regexp_replace(x, f"{WS}*::{WS}*", "::")))


def cpp_name(c: Column | str) -> Column:
    """Normal form of a C++ name: no blanks around ``::`` or before a destructor's ``~``, single blanks elsewhere."""
    return _where_odd(_c(c), lambda x: collapse(F.regexp_replace(strip(F.regexp_replace(x, f"{WS}*::{WS}*", "::")), f"::{WS}*~", "::~")))


def signature_hash(signature: Column | str, length: int = 12) -> Column:
    """``sig_`` and the first hex digits (8 to 40) of SHA-1 over the collapsed text."""
    n = max(8, min(40, length))
    text = collapse(signature)
    text = F.when(text == "", "<empty-signature>").otherwise(text)
    return F.concat(F.lit("sig_"), F.substring(F.sha1(text.cast("binary")), 1, n))


def global_uri(repo, path, kind, name, signature=None) -> Column:
    """``repo::file::type::name``; the signature is appended for functions only."""
    base = F.concat_ws("::", _c(repo), _c(path), _c(kind), cpp_name(name))
    if signature is None:
        return base
    s = _c(signature)
    return F.when((_c(kind) == "Function") & s.isNotNull() & (s != ""), F.concat_ws("::", base, s)).otherwise(base)


def parse_uri(uri: Column | str) -> Column:
    """Struct of repo, file_path, entity_type, entity_name and signature; null when there are fewer than four parts."""
    parts = F.split(_c(uri), "::", -1)
    n = F.size(parts)
    last = F.element_at(parts, -1)
    signed = (parts[2] == "Function") & (n >= 5) & last.rlike(SIG_PATTERN)
    return F.when(
        n >= 4,
        F.struct(
            parts[0].alias("repo"),
            parts[1].alias("file_path"),
            parts[2].alias("entity_type"),
            F.array_join(F.slice(parts, 4, n - 3 - signed.cast("int")), "::").alias("entity_name"),
            F.when(signed, last).alias("signature"),
        ),
    )


def identity_key(uri: Column | str, sig: Column | str) -> Column:
    """The URI with its signature, unless there is none or the URI ends in it; a malformed URI stands for itself."""
    u, s = _c(uri), _c(sig)
    short = F.size(F.split(u, "::", -1)) < 4
    return F.when(short | s.isNull() | (s == "") | u.endswith(F.concat(F.lit("::"), s)), u).otherwise(F.concat_ws("::", u, s))


def point_id(key: Column | str) -> Column:
    """Name-based UUID (version 5, DNS namespace) of an identity key."""
    h = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), _c(key).cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )
