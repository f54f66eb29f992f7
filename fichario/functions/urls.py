"""URL functions: host (G8), relative links, unsafe addresses."""

from __future__ import annotations

import ipaddress
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario import constants as K

_STRAY_PERCENT = "%(?![0-9A-Fa-f]{2})"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def scheme(url: Column) -> Column:
    """Lower-case scheme, empty when the URL has none."""
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def authority(url: Column) -> Column:
    """Text between ``//`` and the path, query or fragment."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def hostname(url: Column) -> Column:
    """Lower-case host without credentials and port; NULL when missing."""
    place = F.regexp_replace(authority(url), "^.*@", "")
    bracketed = F.regexp_extract(place, r"^\[([^\]]*)\]", 1)
    host = F.when(place.startswith("["), bracketed).otherwise(F.substring_index(place, ":", 1))
    return F.nullif(F.lower(host), F.lit(""))


def site_host(url: Column) -> Column:
    """Host with one leading ``www.`` removed."""
    return F.regexp_replace(hostname(url), r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query_value(url: Column, *names: str) -> Column:
    """First non-empty value of the first query parameter named, percent-decoded; else NULL."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    values = [
        F.nullif(F.regexp_extract(query, f"(?:^|&){name}=([^&]+)", 1), F.lit("")) for name in names
    ]
    value = F.coalesce(*values)
    # Decoded twice, as links are often encoded twice; a plus sign means a space only the first
    # time, and a stray percent sign stands for itself.
    once = F.url_decode(F.regexp_replace(value, _STRAY_PERCENT, "%25"))
    kept_plus = F.replace(once, F.lit("+"), F.lit("%2B"))
    return F.url_decode(F.regexp_replace(kept_plus, _STRAY_PERCENT, "%25"))


def resolve_href(href: Column, base: Column) -> Column:
    """Make root-relative and protocol-relative links absolute; others stay as they are."""
    base_scheme = F.concat(scheme(base), F.lit(":"))
    return (
        F.when(base.isNull() | (scheme(base) == ""), href)
        .when(href.startswith("//"), F.concat(base_scheme, href))
        .when(href.startswith("/"), F.concat(base_scheme, F.lit("//"), authority(base), href))
        .otherwise(href)
    )


def _ipv4_part(text: Column) -> Column:
    """One address part in decimal, octal (leading 0) or hexadecimal (0x) notation."""
    return (
        F.when(text.rlike("^0[xX][0-9a-fA-F]{1,8}$"), F.conv(F.substr(text, F.lit(3)), 16, 10))
        .when(text.rlike("^0[0-7]{1,11}$"), F.conv(text, 8, 10))
        .when(text.rlike("^[0-9]{1,10}$"), text)
        .try_cast("bigint")
    )


def _ipv4_parts(host: Column) -> Column:
    """The dot-separated parts of a host as numbers; a part that is no number is NULL."""
    return F.transform(F.split(host, r"\."), _ipv4_part)


def ipv4_number(parts: Column) -> Column:
    """IPv4 number of one to four parts (the last part fills what is left), else NULL."""
    value = F.lit(None).cast("bigint")
    for size in (1, 2, 3, 4):
        numbers = [F.get(parts, F.lit(i)) for i in range(size)]
        heads = [n * (256 ** (3 - i)) for i, n in enumerate(numbers[:-1])]
        total = reduce(lambda a, b: a + b, heads, numbers[-1])
        in_range = numbers[-1] < 256 ** (5 - size)
        for n in numbers[:-1]:
            in_range = in_range & (n < 256)
        value = F.when((F.size(parts) == size) & in_range, total).otherwise(value)
    return value


def ipv4_text(number: Column) -> Column:
    parts = [F.shiftright(number, s).bitwiseAND(F.lit(255).cast("bigint")) for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *[p.cast("string") for p in parts])


def is_blocked_ipv4(number: Column) -> Column:
    blocked = F.lit(False)
    for block in map(ipaddress.ip_network, K.BLOCKED_IPV4):
        low, high = int(block.network_address), int(block.broadcast_address)
        blocked = blocked | number.between(F.lit(low), F.lit(high))
    public = [int(ipaddress.ip_address(a)) for a in K.PUBLIC_IPV4]
    return F.coalesce(blocked & ~number.isin(*public), F.lit(False))


def is_blocked_ipv6(host: Column) -> Column:
    """Loopback, unspecified, unique-local, link-local, multicast, documentation and mapped."""
    return host.rlike(
        r"^(?:::1?|0*(?::0*)*:0*1?|f[cd][0-9a-f]{0,2}:.*|fe[89ab][0-9a-f]?:.*|ff[0-9a-f]{0,2}:.*"
        r"|2001:0?db8:.*|::ffff:.*|0*:0*:0*:0*:0*:ffff:.*)$"
    )


def flag_unsafe(rows: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``unsafe_reason``: why a URL must not be fetched, NULL when nothing is found.

    Literal rules only (names are not resolved). The steps are columns of their own, so the host
    is taken apart once per URL.
    """
    steps = rows.withColumn("_host", hostname(F.col(url)))
    steps = steps.withColumn("_parts", _ipv4_parts(F.col("_host")))
    steps = steps.withColumn("_number", ipv4_number(F.col("_parts")))
    host, number = F.col("_host"), F.col("_number")
    credentials = F.regexp_extract(authority(F.col(url)), r"^(.*)@", 1)
    reason = (
        F.when(~scheme(F.col(url)).isin("http", "https"), F.lit("scheme_invalido"))
        .when(credentials.rlike("[^:]"), F.lit("credenciais_na_url"))
        .when(host.isNull(), F.lit("host_ausente"))
        .when(host.isin("localhost", "127.0.0.1", "0.0.0.0"), F.lit("localhost"))
        .when(is_blocked_ipv4(number), F.concat(F.lit("ip_bloqueado:"), ipv4_text(number)))
        .when(
            F.contains(host, F.lit(":")) & is_blocked_ipv6(host),
            F.concat(F.lit("ip_bloqueado:"), host),
        )
    )
    return steps.withColumn("unsafe_reason", reason).drop("_host", "_parts", "_number")
