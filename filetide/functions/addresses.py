"""Canonical text of IP addresses, with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filetide.functions.columns import let

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUP = r"[0-9a-f]{1,4}"
_SIDE = rf"(?:{_GROUP}(?::{_GROUP})*)?"
_MAPPED = ":0:0:0:0:0:ffff:"


def _hex_pair(dotted: Column) -> Column:
    octets = [F.get(F.split(dotted, r"\."), F.lit(i)).try_cast("int") for i in range(4)]
    return F.lower(F.concat_ws(
        ":", F.hex(octets[0] * 256 + octets[1]), F.hex(octets[2] * 256 + octets[3])))


def _dotted(groups: Column) -> Column:
    numbers = [F.conv(F.get(groups, F.lit(i)), 16, 10).try_cast("int") for i in (7, 8)]
    octets = [part for n in numbers for part in (F.shiftright(n, 8), n.bitwiseAND(F.lit(255)))]
    return F.concat_ws(".", *[o.cast("string") for o in octets])


def _count_groups(side: Column) -> Column:
    colons = F.length(side) - F.length(F.regexp_replace(side, ":", ""))
    return F.when(side == "", 0).otherwise(colons + 1)


def _expand(hexed: Column) -> Column:
    """``:g:g:g:g:g:g:g:g:`` with every group present, or NULL when the text is no address."""
    full = F.when(hexed.rlike(rf"^(?:{_GROUP}:){{7}}{_GROUP}$"), F.concat(F.lit(":"), hexed, F.lit(":")))
    left = F.substring_index(hexed, "::", 1)
    right = F.substring_index(hexed, "::", -1)
    missing = F.lit(8) - _count_groups(left) - _count_groups(right)
    gap = F.when(hexed.rlike(rf"^{_SIDE}::{_SIDE}$") & (missing >= 1), F.concat(
        F.lit(":"), F.when(left == "", "").otherwise(F.concat(left, F.lit(":"))),
        F.repeat(F.lit("0:"), missing),
        F.when(right == "", "").otherwise(F.concat(right, F.lit(":")))))
    return F.coalesce(full, gap)


# The longest run is tried first, and a lazy prefix finds its first place; a single zero stays.
_ZERO_RUN = "^(?:" + "|".join(rf"(.*?)(?::0){{{n}}}(?=:)" for n in range(8, 1, -1)) + ")"
_BEFORE_RUN = "".join(f"${n}" for n in range(1, 8)) + ":"


def _compress(groups: Column) -> Column:
    """Shorten the first of the longest runs of zero groups."""
    return F.regexp_replace(F.regexp_replace(groups, _ZERO_RUN, _BEFORE_RUN), r"^:(?!:)|(?<!:):$", "")


def _format(groups: Column) -> Column:
    return F.when(
        groups.startswith(_MAPPED), F.concat(F.lit("::ffff:"), _dotted(F.split(groups, ":")))
    ).otherwise(_compress(groups))


def _hex_only(lowered: Column) -> Column:
    """A dotted tail rewritten as the two groups it stands for."""
    return let(
        F.regexp_extract(lowered, rf":({_V4})$", 1),
        lambda tail: F.when(tail == "", lowered).otherwise(
            F.concat(F.regexp_replace(lowered, rf"{_V4}$", ""), _hex_pair(tail))))


def canonical_ip(text: Column) -> Column:
    """IPv6 text; IPv4 becomes ``::ffff:a.b.c.d``; empty, scoped or malformed becomes ``::``."""
    groups = let(
        _hex_only(F.lower(text)),
        lambda hexed: F.regexp_replace(_expand(hexed), ":0+(?=[0-9a-f])", ":"))
    parsed = let(groups, lambda g: F.when(g.isNotNull(), _format(g)).otherwise(F.lit("::")))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", F.lit("::"))
        .when(text.rlike(rf"^{_V4}$"), F.concat(F.lit("::ffff:"), text))
        .otherwise(parsed)
    )
