"""Scalar expressions over untrusted text, dates and URLs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import INT32_MAX, RANKED

# The shape of a host name, of a strict IPv4 address, and the never routable ranges.
HOST = r"^(?:[a-z0-9_]|[^\x00-\x7f])(?:[a-z0-9_-]|[^\x00-\x7f]){0,62}(?:\.(?:[a-z0-9_]|[^\x00-\x7f])(?:[a-z0-9_-]|[^\x00-\x7f]){0,62})+$"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
NONROUTABLE_IPV4 = r"^(?:0|127|22[4-9]|2[3-5][0-9])\.|^169\.254\."
#: Of the eight groups without leading zeros: ::/127, fe80::/10, ff00::/8, ::ffff:0.0.0.0/104 and ::ffff:127.0.0.0/104.
NONROUTABLE_IPV6 = "^(?:(?:0:){7}[01]$|fe[89ab][0-9a-f]:|ff[0-9a-f]{2}:|(?:0:){5}ffff:(?:[0-9a-f]{1,2}|7f[0-9a-f]{2}):)"


def clean(column: Column) -> Column:
    """Lower case without spaces around and dots behind; null becomes empty."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(column, F.lit("")))), r"\.+$", "")


def search_value(node_type: str, value: str) -> str:
    """A value to look up, as it is stored: spaces cut, and for hosts and addresses lower case without dots behind."""
    value = value.strip()
    return value.lower().rstrip(".") if node_type in RANKED else value


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def _groups(v: Column) -> Column:
    """The eight groups of an IPv6 address in lower case, without leading zeros; null if it is none."""
    dotted = F.regexp_extract(v, r":([0-9.]+)$", 1)
    octet = lambda i: F.split(dotted, r"\.")[i].cast("int")
    pair = lambda i: F.lower(F.hex(octet(i) * 256 + octet(i + 1)))
    plain = F.when(~v.contains("."), v).when(dotted.rlike(IPV4), F.concat(F.regexp_replace(v, r"[0-9.]+$", ""), pair(0), F.lit(":"), pair(2)))
    none = F.array().cast("array<string>")
    side = lambda text: F.when(text == "", none).otherwise(F.split(text, ":"))
    filled = lambda g: F.flatten(F.transform(g, lambda x: F.when(x == "*", F.array_repeat(F.lit("0"), (9 - F.size(g)).cast("int"))).otherwise(F.array(x))))
    joined = _let(F.split(plain, "::"), lambda h: F.when(F.size(h) == 1, F.split(h[0], ":")).when(F.size(h) == 2, _let(F.concat(side(F.get(h, F.lit(0))), F.array(F.lit("*")), side(F.get(h, F.lit(1)))), lambda g: F.when(F.size(g) <= 8, filled(g)))))
    good = lambda g: (F.size(g) == 8) & F.forall(g, lambda x: x.rlike("^[0-9a-f]{1,4}$"))
    return _let(joined, lambda g: F.when(good(g), F.transform(g, lambda x: F.regexp_replace(x, "^0+(?=.)", ""))))


def _written_ipv6(s: Column) -> Column:
    """Canonical form of eight joined groups: the first longest run of zeros is cut, a mapped IPv4 address is dotted."""
    last = lambda i: F.conv(F.split(s, ":")[i], 16, 10).cast("int")
    byte = lambda i: F.concat_ws(".", F.shiftright(last(i), 8).cast("string"), (last(i) % 256).cast("string"))
    out = F.when(s.startswith("0:0:0:0:0:ffff:"), F.concat(F.lit("::ffff:"), byte(6), F.lit("."), byte(7)))
    for k in range(8, 1, -1):
        run = f"(?:^|:)0(?::0){{{k - 1}}}(?:$|:)"
        out = out.when(s.rlike(run), F.regexp_replace(s, f"^(.*?){run}(.*)$", "$1::$2"))
    return out.otherwise(s)


def ipv6(v: Column) -> Column:
    """struct(kind, value) of an IPv6 address in lower case: ip or x_nonroutable, and its canonical form; null for other texts."""
    kind = lambda s: F.when(s.rlike(NONROUTABLE_IPV6), "x_nonroutable").otherwise("ip")
    own = lambda s: F.when(s.isNotNull(), F.struct(kind(s).alias("kind"), _written_ipv6(s).alias("value")))
    return _let(F.array_join(_groups(v), ":"), own)


def classify(column: Column, routable_only: bool = True) -> Column:
    """struct(kind, value) of a raw value.

    kind is fqdn, ip, x_nonroutable, x_wildcard, x_invalid or empty, by the value's shape; routable addresses are
    in canonical form. With routable_only false, unroutable addresses are of kind ip too. All of it stays in the
    JVM; values without a colon never reach the rules of IPv6.
    """
    v = clean(column)
    bare = F.when(F.lit(routable_only) & v.rlike(NONROUTABLE_IPV4), F.lit("x_nonroutable")).otherwise(F.lit("ip"))
    six = F.when(v.contains(":"), ipv6(v))
    host = (F.octet_length(v) <= 253) & v.rlike(HOST) & ~v.rlike(r"\.[0-9]+$")
    kind = (
        F.when(v == "", F.lit(""))
        .when(v.rlike(IPV4), bare)
        .when(v.startswith("*."), F.lit("x_wildcard"))
        .when(host, F.lit("fqdn"))
        .otherwise(F.lit("x_invalid"))
    )
    plain = F.struct(kind.alias("kind"), v.alias("value"))
    if not routable_only:
        return _let(six, lambda x: F.when(x.isNotNull(), F.struct(F.lit("ip").alias("kind"), x["value"].alias("value"))).otherwise(plain))
    return _let(six, lambda x: F.when(x.isNotNull(), F.struct(x["kind"].alias("kind"), F.when(x["kind"] == "ip", x["value"]).otherwise(v).alias("value"))).otherwise(plain))


def host_kind(column: Column) -> Column:
    """kind of a value without a colon, in the JVM only."""
    v = clean(column)
    return (
        F.when(v == "", "")
        .when(v.rlike(IPV4), F.when(v.rlike(NONROUTABLE_IPV4), "x_nonroutable").otherwise("ip"))
        .when(v.startswith("*."), "x_wildcard")
        .when((F.octet_length(v) <= 253) & v.rlike(HOST) & ~v.rlike(r"\.[0-9]+$"), "fqdn")
        .otherwise("x_invalid")
    )


#: ISO dates and times as programs and databases write them: with T or a space, any fraction, Z or an offset.
_ISO = r"^(\d{4}-\d{2}-\d{2})(?:[Tt ](\d{2}:\d{2})(:\d{2})?(?:[.,]\d+)? *(Z|z|UTC|[+-]\d{2}:?\d{2}|[+-]\d{2})?)?$"
#: Other accepted date texts, tried in this order.
DATE_FORMATS = ("yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "yyyyMMdd'T'HHmmss")


#: The date text that databases write most, told by one pattern.
_PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}$"


def seconds(column: Column) -> Column:
    """Unix seconds of a date text or of whole seconds as text; null if neither (zero dates included).

    Times without a zone are UTC; a fraction of a second is cut off. The text is looked at once, and the other forms
    only where it isn't a plain date and time, since a row may have several dates.
    """

    def found(text: Column) -> Column:
        return F.when(text.rlike(_PLAIN), F.unix_timestamp(F.concat(text, F.lit("Z")).try_cast("timestamp"))).otherwise(_any_seconds(text))

    return _let(_let(F.trim(column), found), lambda n: F.when(n > 0, n))


def _any_seconds(text: Column) -> Column:
    number = F.when(text.rlike("^[0-9]{5,10}$"), text.try_cast("bigint"))
    part = lambda i: F.regexp_extract(text, _ISO, i)
    time = F.concat(F.when(part(2) == "", "00:00").otherwise(part(2)), F.when(part(3) == "", ":00").otherwise(part(3)))
    offset = F.regexp_replace(F.regexp_replace(part(4), r"^([+-]\d{2}):?(\d{2})$", "$1:$2"), r"^([+-]\d{2})$", "$1:00")
    zone = F.when(offset.rlike("^[+-]"), offset).otherwise("Z")
    iso = F.when(text.rlike(_ISO), F.concat(part(1), F.lit("T"), time, zone).try_cast("timestamp"))
    utc = lambda f: F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(f + " XXX"))
    return F.coalesce(number, F.unix_timestamp(F.coalesce(iso, *[utc(f) for f in DATE_FORMATS])))


def or_zero(column: Column, kind: str = "bigint") -> Column:
    return F.coalesce(column.try_cast(kind), F.lit(0).cast(kind))


def is_integer(column: Column) -> Column:
    return column.rlike("^-*[0-9]+$")


def uuid(column: Column) -> Column:
    return F.lower(F.trim(F.coalesce(column, F.lit(""))))


def int32(column: Column) -> Column:
    return F.least(column, F.lit(INT32_MAX)).cast("int")


def saturday(column: Column) -> Column:
    """The Saturday that ends a date's week of Sunday to Saturday."""
    return F.date_add(F.to_date(column), 7 - F.dayofweek(column))


def retained(week: Column, today: Column, days: int = 730) -> Column:
    """Whether ranks of a week's Saturday are still kept today."""
    return F.date_add(week, days) > today


def reversed_labels(column: Column) -> Column:
    """com.example.www as www.example.com."""
    return F.array_join(F.reverse(F.split(column, r"\.")), ".")


def slice_of(column: Column, n: int) -> Column:
    """Number of a value's hash slice, 0 to n - 1; the same in any engine with md5."""
    return F.conv(F.substring(F.md5(column.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % n


def url_host(column: Column) -> Column:
    return F.regexp_extract(column, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)


def like_pattern(pattern: str) -> str:
    """A pattern in which only % is a wildcard, for LIKE."""
    return pattern.replace("\\", "\\\\").replace("_", "\\_")
