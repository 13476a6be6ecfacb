"""IPv6 normal forms against the standard library on generated addresses, valid and not."""

import ipaddress

import numpy as np
from conftest import col_values
from pyspark.sql import functions as F

from webstats.functions.web import parse_ip


def plain(text):
    try:
        ip = ipaddress.ip_address(text.strip())
    except ValueError:
        return None
    # older versions of the library write IPv4-mapped addresses with hexadecimal groups
    mapped = getattr(ip, "ipv4_mapped", None)
    return f"::ffff:{mapped}" + (f"%{ip.scope_id}" if ip.scope_id else "") if mapped else str(ip)


def written(rng):
    """An address in one of its many spellings: zeros left out or not, leading zeros, upper case, a dotted tail."""
    groups = [int(rng.choice([0, 0, 0, 1, 15, 0xabcd, rng.integers(0, 1 << 16)])) for _ in range(8)]
    tail = rng.random() < 0.3
    parts = [f"{g:{rng.choice(['x', '04x', 'X'])}}" for g in groups]
    if tail:
        parts[6:] = [f"{groups[6] >> 8}.{groups[6] & 255}.{groups[7] >> 8}.{groups[7] & 255}"]
    zeros = [i for i, g in enumerate(groups[:len(parts) - tail]) if g == 0]
    if zeros and rng.random() < 0.7:
        first = int(rng.choice(zeros))
        last = first
        while last + 1 in zeros and rng.random() < 0.8:
            last += 1
        return ":".join(parts[:first]) + "::" + ":".join(parts[last + 1:])
    return ":".join(parts)


def test_normal_forms(spark):
    rng = np.random.default_rng(8)
    good = [written(rng) for _ in range(3_000)]
    fixed = ["::", "::1", "1::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:0:0:4:0:0:7:8", "0:0:1:0:0:0:1:0", "fe80::1%eth0", "::ffff:1.2.3.4",
             "64:ff9b::192.0.2.33", " 2001:DB8::00A ", "10.0.0.1", "1:2:3:4:5:6:1.2.3.4", "0:0:0:0:0:FFFF:c000:0221", "::fffe:1.2.3.4", "::ffff:0:0"]
    bad = ["", ":", ":::", "1", "1:2", "::1::", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7:8::", "::1:2:3:4:5:6:7:8", "g::", "12345::", ":1:2:3:4:5:6:7:8",
           "1:2:3:4:5:6:7:8:", "::256.1.1.1", "::1.2.3", "1.2.3.4::", "::01.2.3.4", "1::2::3", "fe80::1%", "1:2:3:4:5:6:7:1.2.3.4", "0x1::", "::1 2", "1:::2"]
    cut = [t[:int(rng.integers(0, len(t)))] + str(rng.choice([":", "", "0", "::", "."])) + t[int(rng.integers(0, len(t))):] for t in good[:1_500]]
    texts = good + fixed + bad + cut
    got = col_values(spark, parse_ip(F.col("v")), texts)
    wrong = [(t, g, plain(t)) for t, g in zip(texts, got) if g != plain(t)]
    assert not wrong, wrong[:5]
    assert all(g is not None for g in got[:len(good)])


def test_missing_addresses(spark):
    assert col_values(spark, parse_ip(F.col("v")), [None, "unknown"]) == [None, None]
