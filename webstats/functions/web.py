"""Column expressions for URLs, user agents, IPs, status codes and calendars.

All of these are built-in Spark expressions (JVM side, whole-stage codegen);
none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webstats.functions.numeric import _c

# RFC 3986 appendix B: groups 2 scheme, 4 authority, 5 path, 7 query, 9 fragment.
URL_RE = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"


def url_scheme(url) -> Column:
    return F.regexp_extract(_c(url), URL_RE, 2)


def url_authority(url) -> Column:
    return F.regexp_extract(_c(url), URL_RE, 4)


def url_path_raw(url) -> Column:
    return F.regexp_extract(_c(url), URL_RE, 5)


def url_query(url) -> Column:
    """F-07: query string of a URL, NULL when empty."""
    return F.nullif(F.regexp_extract(_c(url), URL_RE, 7), F.lit(""))


def extract_page(url) -> Column:
    """F-04: path component; NULL / empty URL or empty path -> '/'."""
    u = _c(url)
    return F.when(u.isNull() | (u == ""), F.lit("/")).otherwise(
        F.coalesce(F.nullif(url_path_raw(u), F.lit("")), F.lit("/")))


def page_section(path) -> Column:
    """First non-empty path segment, or 'home'."""
    stripped = F.regexp_replace(_c(path), r"^/+|/+$", "")
    return F.when(stripped == "", F.lit("home")).otherwise(F.split_part(stripped, F.lit("/"), F.lit(1)))


def url_parts(url) -> Column:
    """F-05: struct(url_path, url_domain, page_section)."""
    path = F.coalesce(F.nullif(url_path_raw(url), F.lit("")), F.lit("/"))
    return F.struct(path.alias("url_path"), url_authority(url).alias("url_domain"),
                    page_section(path).alias("page_section"))


def _decode(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def query_params(url) -> Column:
    """F-03: decoded query parameters as map<key, array<value>>; blank values dropped."""
    q = F.regexp_extract(_c(url), URL_RE, 7)
    pairs = F.filter(F.split(q, "&"), lambda p: p.rlike("^[^=]*=.+"))
    kv = F.transform(pairs, lambda p: F.struct(
        _decode(F.substring_index(p, "=", 1)).alias("k"),
        _decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("v")))
    keys = F.array_distinct(F.transform(kv, lambda x: x["k"]))
    vals = F.transform(keys, lambda k: F.transform(F.filter(kv, lambda x: x["k"] == k), lambda x: x["v"]))
    return F.map_from_arrays(keys, vals)


def parse_url(url) -> Column:
    """F-02: struct(domain, path, query_params)."""
    path = F.coalesce(F.nullif(url_path_raw(url), F.lit("")), F.lit("/"))
    return F.struct(url_authority(url).alias("domain"), path.alias("path"),
                    query_params(url).alias("query_params"))


def clean_url(url) -> Column:
    """F-06: trim; lower-case scheme and host; strip trailing '/'."""
    u = F.trim(_c(url))
    scheme, auth = url_scheme(u), F.regexp_extract(u, URL_RE, 3)
    rest = F.regexp_replace(u, r"^([^:/?#]+:)?(//[^/?#]*)?", "")
    head = F.concat(F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(F.lit("")),
                    F.lower(auth))
    return F.regexp_replace(F.concat(head, rest), "/+$", "")


def has_scheme_and_host(url) -> Column:
    return (url_scheme(url) != "") & (url_authority(url) != "")


# ---- user agents -------------------------------------------------------------

def ua_browser_os(ua) -> Column:
    """F-08: struct(browser, os) with the helper's case-sensitive rule order."""
    u = F.coalesce(_c(ua), F.lit(""))
    has = u.contains
    browser = (F.when(has("Edg/") | has("Edge/"), "Edge").when(has("OPR/") | has("Opera"), "Opera")
               .when(has("Chrome/"), "Chrome").when(has("Firefox/"), "Firefox")
               .when(has("Safari/"), "Safari").otherwise("Other"))
    os_name = (F.when(has("Windows"), "Windows").when(has("Mac OS X"), "macOS")
               .when(has("Linux"), "Linux").when(has("Android"), "Android")
               .when(has("iPhone") | has("iPad"), "iOS").otherwise("Other"))
    return F.struct(browser.alias("browser"), os_name.alias("os"))


def _il(u: Column, s: str) -> Column:
    return u.ilike(f"%{s}%")


def ua_browser(ua) -> Column:
    """F-13 (view version): browser by case-insensitive match."""
    u = _c(ua)
    return (F.when(_il(u, "Edg/"), "Edge").when(_il(u, "Chrome/"), "Chrome")
            .when(_il(u, "Firefox/"), "Firefox")
            .when(_il(u, "Safari/") & ~_il(u, "Chrome/"), "Safari").otherwise("Other"))


def ua_os(ua) -> Column:
    u = _c(ua)
    return (F.when(_il(u, "Windows"), "Windows").when(_il(u, "Macintosh"), "macOS")
            .when(_il(u, "Linux") & ~_il(u, "Android"), "Linux").when(_il(u, "Android"), "Android")
            .when(_il(u, "iPhone") | _il(u, "iPad"), "iOS").otherwise("Other"))


def ua_device(ua) -> Column:
    u = _c(ua)
    return (F.when(_il(u, "Mobile") | _il(u, "Android") | _il(u, "iPhone"), "mobile")
            .when(_il(u, "Tablet") | _il(u, "iPad"), "tablet").otherwise("desktop"))


# ---- server-log fields -------------------------------------------------------

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9])"
IPV4_RE = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
IPV4_TAIL_RE = rf"^(.*:)({_OCTET}(?:\.{_OCTET}){{3}})$"


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hex_groups(text: Column) -> Column:
    return F.filter(F.split(text, ":"), lambda g: g != "")


def _ipv4_as_groups(quad: Column) -> Column:
    """The last four octets as two hexadecimal groups."""
    octet = lambda o, i: F.get(o, F.lit(i)).cast("int")     # noqa: E731
    pair = lambda o, i: F.lower(F.hex(octet(o, i) * 256 + octet(o, i + 1)))     # noqa: E731
    return _bound(F.split(quad, "[.]"), lambda o: F.concat(pair(o, 0), F.lit(":"), pair(o, 2)))


def _shortened(joined: Column) -> Column:
    """Groups between colons (one at each end) with the longest run of zeros as ``::``; the first of equal runs."""
    best = F.lit(None).cast("string")
    for k in range(2, 9):
        run = ":" + "0:" * k
        best = F.when(F.contains(joined, F.lit(run)), F.regexp_replace(joined, f"^(.*?){run}", "$1::")).otherwise(best)
    return F.regexp_replace(F.regexp_replace(F.coalesce(best, joined), "^:(?!:)", ""), "(?<!:):$", "")


def _normal_groups(groups: Column) -> Column:
    """Eight groups as text; IPv4-mapped addresses with a dotted tail."""
    two = F.transform(F.slice(groups, 7, 2), lambda g: F.conv(g, 16, 10).cast("int"))
    dotted = F.concat_ws(".", F.flatten(F.transform(two, lambda g: F.array((g / 256).cast("int").cast("string"), (g % 256).cast("string")))))
    mapped = F.array_join(F.slice(groups, 1, 6), ":") == "0:0:0:0:0:ffff"
    joined = F.concat(F.lit(":"), F.array_join(groups, ":"), F.lit(":"))
    return F.when(mapped, F.concat(F.lit("::ffff:"), dotted)).otherwise(_bound(joined, _shortened))


def _normal_text(text: Column) -> Column:
    """The normal form of lower-case hexadecimal groups; NULL if they are no address."""
    def of(sides: Column) -> Column:
        short = F.size(sides) == 2
        left = _hex_groups(F.get(sides, F.lit(0)))
        right = F.when(short, _hex_groups(F.get(sides, F.lit(1)))).otherwise(F.array().cast("array<string>"))
        n = F.size(left) + F.size(right)
        zeros = F.array_repeat(F.lit("0"), F.when(short, 8 - n).otherwise(0))
        groups = F.transform(F.concat(left, zeros, right), lambda g: F.regexp_replace(g, "^0+(?=.)", ""))
        return F.when(F.when(short, n <= 7).otherwise(n == 8), _bound(groups, _normal_groups))
    # single colons only between groups; without "::" there are eight of them, with it at most seven
    form = "^(([0-9a-f]{1,4}:)*[0-9a-f]{1,4})?(::(([0-9a-f]{1,4}:)*[0-9a-f]{1,4})?)?$"
    return F.when(text.rlike(form), _bound(F.split(text, "::"), of))


def ipv6_normal(ip) -> Column:
    """The normal form of an IPv6 address, NULL if it is none.

    Eight groups without leading zeros in lower case, the longest run of two or more zero groups (the first of equal
    ones) written ``::``. Accepted are ``::`` for one or more groups, a dotted IPv4 tail and a zone (``%eth0``), which stays.
    """
    whole = _c(ip)
    zone = F.regexp_extract(whole, r"^[^%]*(%[^%]+)$", 1)
    text = F.lower(F.when(zone != "", F.regexp_extract(whole, "^([^%]*)%", 1)).otherwise(whole))

    def of(t: Column) -> Column:
        quad = F.regexp_extract(t, IPV4_TAIL_RE, 2)
        plain = F.when(quad != "", F.concat(F.regexp_extract(t, IPV4_TAIL_RE, 1), _ipv4_as_groups(quad))).otherwise(t)
        return _bound(plain, _normal_text)
    return F.concat(_bound(text, of), zone)


def parse_ip(ip) -> Column:
    """F-09: trimmed IPv4 text or IPv6 normal form, NULL when invalid or missing."""
    t = F.trim(_c(ip).cast("string"))
    return F.when(t.rlike(IPV4_RE), t).when(F.contains(t, F.lit(":")), ipv6_normal(t)).otherwise(F.lit(None).cast("string"))


def parse_timestamp(ts) -> Column:
    """F-10: ISO / date-only text -> timestamp; bad -> NULL."""
    return F.coalesce(F.try_to_timestamp(F.trim(_c(ts).cast("string"))),
                      F.try_to_timestamp(F.trim(_c(ts).cast("string")), F.lit("yyyy-MM-dd'T'HH:mm:ss")))


def status_category(code) -> Column:
    """F-11."""
    c = F.trim(_c(code).cast("string")).try_cast("int")
    return (F.when((c >= 200) & (c < 300), "2xx Success").when((c >= 300) & (c < 400), "3xx Redirect")
            .when((c >= 400) & (c < 500), "4xx Client Error").when((c >= 500) & (c < 600), "5xx Server Error")
            .otherwise("Unknown"))


def response_kb(size) -> Column:
    """F-12: bytes -> KB with 2 digits; bad -> 0.0. Python round() is half-even."""
    v = F.trim(_c(size).cast("string")).try_cast("double")
    return F.coalesce(F.bround(v / 1024, 2), F.lit(0.0))


# ---- calendar ----------------------------------------------------------------

def date_id(d) -> Column:
    """F-01: date -> int YYYYMMDD."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def iso_dow(d) -> Column:
    return F.weekday(_c(d)) + 1


def pg_dow(d) -> Column:
    """EXTRACT(DOW): 0=Sunday .. 6=Saturday."""
    return F.dayofweek(_c(d)) - 1


def padded_name(d, pattern: str) -> Column:
    """TO_CHAR(d, 'Month' / 'Day'): English name blank-padded to 9 characters."""
    return F.rpad(F.date_format(_c(d), pattern), 9, " ")


__all__ = [n for n in dir() if not n.startswith("_")]
