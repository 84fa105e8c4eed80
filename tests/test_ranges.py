"""Nested and crossing ranges of both families against a plain scan; address keys; as-of join."""

import ipaddress
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clickflow.functions.ipkeys import decimal_key, ip_key, ipv6_key, v4_number
from clickflow.operators import geo
from clickflow.operators import ranges as rg
from clickflow.operators.asof import asof_join
from clickflow.plans.iplocate import run_ip_locations
from clickflow.session import work_path
from conftest import plan_text, rows, srt

FIELDS = ["country_short", "country_long", "region", "city"]
TEXT = "ip_from string, ip_to string, country_short string, country_long string, region string, city string"
MAPPED = 0xFFFF << 32


def key_of(text):
    """128-bit number of an address by the standard library, None for other text."""
    try:
        a = ipaddress.ip_address(text)
    except ValueError:
        return None
    return int(a) if a.version == 6 else MAPPED + int(a)


def narrowest(n, ranges):
    held = [r for r in ranges if n is not None and r[0] <= n <= r[1]]
    return min(held, key=lambda r: (r[1] - r[0], r[0], r[2:])) if held else None


ODD_TEXT = ["::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "2001:DB8::a", "::ffff:1.2.3.4", "::1.2.3.4",
            "1:2:3:4:5:6:1.2.3.4", "fe80::1%eth0", "1:2:::3", ":1::2", "1::2::3", "1:2:3", "1:2:3:4:5:6:7:8:9", "12345::", "g::1", "::1.2.3",
            "::300.1.1.1", "1.2.3.4", "01.2.3.4", "1.2.3.4.5", "", " ::1", "::1 ", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", None, ":", ":::"]


def test_address_keys_agree_with_the_standard_library(spark):
    rnd = random.Random(4)
    texts = ODD_TEXT + [str(ipaddress.IPv6Address(rnd.getrandbits(128))) for _ in range(50)] \
        + [ipaddress.IPv6Address(rnd.getrandbits(64)).exploded for _ in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    got = {r["ip"]: None if r["k"] is None else int.from_bytes(r["k"], "big") for r in df.select("ip", ip_key("ip").alias("k")).collect()}
    assert got == {t: key_of(t) if t and "%" not in t else None for t in texts}
    four = df.select(v4_number(ip_key("ip")).alias("n"), ipv6_key("ip").alias("six")).where("six IS NULL AND n IS NOT NULL").collect()
    assert [r["n"] for r in four] == [16909060]


def test_decimal_keys(spark):
    numbers = [0, 1, 2 ** 32 - 1, 2 ** 32, 10 ** 9, 2 ** 64 + 5, MAPPED, 2 ** 128 - 1, 2 ** 128, 10 ** 39 - 1]
    df = spark.createDataFrame([(str(n),) for n in numbers] + [("",), ("1.5",), ("-1",), (None,), ("00012",)], "t string")
    got = [None if r["k"] is None else int.from_bytes(r["k"], "big") for r in df.select(decimal_key("t").alias("k")).collect()]
    assert got == [n if n < 2 ** 128 else None for n in numbers] + [None] * 4 + [12]


def random_ranges(rnd, n, top):
    """Ranges of all sizes: nested, crossing, equal, points, and one over everything."""
    out = [(0, top, "all", None, "r", "c")]
    for i in range(n):
        a = rnd.randrange(top)
        b = min(top, a + rnd.choice([0, 3, top // 1000, top // 20, top // 3]))
        out.append((a, b, f"c{i}", f"C{i}", None if i % 3 else "r", "c"))
        if i % 5 == 0:
            out.append((a, b, f"b{i}", f"C{i}", "r", "c"))
    return out


@pytest.mark.parametrize("rows_per_bin", [10_000, 7, 1])
def test_pieces_equal_a_plain_scan(spark, rows_per_bin):
    top = 5000
    found = random_ranges(random.Random(rows_per_bin), 60, top)
    df = spark.createDataFrame([(str(a), str(b), *f) for a, b, *f in found], TEXT)
    pieces = [(int.from_bytes(p["lo"], "big"), int.from_bytes(p["hi"], "big"), *[p[c] for c in FIELDS])
              for p in rg.disjoint_pieces(df, FIELDS, rows_per_bin).collect()]
    pieces.sort()
    assert all(a[1] < b[0] for a, b in zip(pieces, pieces[1:]))

    def least(n):
        held = [r for r in found if r[0] <= n <= r[1]]
        return min(held, key=lambda r: (r[1] - r[0], r[0], [(x is not None, x or "") for x in r[2:]]))[2:]
    told = {}
    for lo, hi, *f in pieces:
        told.update(dict.fromkeys(range(lo, hi + 1), tuple(f)))
    assert told == {n: least(n) for n in range(top + 1)}


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 200), st.integers(0, 200))
def test_dyadic_nodes_make_up_the_bins(a, b):
    first, last = min(a, b), max(a, b)
    made = [x for level, index in rg.dyadic(first, last) for x in range(index << level, (index + 1) << level)]
    assert made == list(range(first, last + 1)) and len(rg.dyadic(first, last)) <= 2 * 9


def test_wide_ranges_do_not_multiply(spark):
    """Ranges over nearly all bins give a few rows each, not one per bin."""
    top = 2 ** 40
    found = [(i, top - i, f"w{i}", "", "", "") for i in range(200)] + [(i * 10 ** 9, i * 10 ** 9 + 5, f"p{i}", "", "", "") for i in range(400)]
    df = spark.createDataFrame([(str(a), str(b), *f) for a, b, *f in found], TEXT)
    keyed = rg._keyed(df, FIELDS).groupBy("lo", "hi").agg(F.min("f").alias("f")).select("lo", "hi", F.to_json("f").alias("f"))
    bins = 60
    held = rg._binned(keyed, bins)
    assert held.count() <= 2 * len(found) + bins
    assert held.groupBy("bin").count().agg(F.max("count")).first()[0] <= 400


def test_mixed_lookup_equals_a_plain_scan(spark):
    rnd = random.Random(8)
    base6 = 0x20010DB8 << 96
    found = [(MAPPED + a, MAPPED + b, *f) for a, b, *f in random_ranges(rnd, 30, 2 ** 32 - 1)]
    found += [(base6 + a, base6 + b, *f) for a, b, *f in random_ranges(rnd, 30, 2 ** 96 - 1)]
    texts = [str(ipaddress.IPv4Address(rnd.getrandbits(32))) for _ in range(150)]
    texts += [str(ipaddress.IPv6Address(base6 + rnd.getrandbits(96))) for _ in range(150)] + [f"::ffff:{t}" for t in texts[:20]]
    texts += [str(ipaddress.IPv6Address(r[k])) for r in found[40:] for k in (0, 1) if r[0] >= base6] + ODD_TEXT + ["2001:db9::1"]
    texts = list(dict.fromkeys(texts))
    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    ranges = spark.createDataFrame([(str(a) if i % 2 else str(ipaddress.IPv6Address(a)), str(b), *f) for i, (a, b, *f) in enumerate(found)], TEXT)

    def told(t):
        n = key_of(t) if t and "%" not in t else None
        if n is None:
            return (None,) * 4 if not t else ("INVALID IP ADDRESS",) * 4
        held = [r for r in found if r[0] <= n <= r[1]]
        return min(held, key=lambda r: (r[1] - r[0], r[0], [(x is not None, x or "") for x in r[2:]]))[2:] if held else (None,) * 4
    assert rows(geo.locate_ips(df, ranges)) == srt((t, *told(t)) for t in texts)


def test_hot_prefix_is_cut_into_partitions(spark):
    """Most IPv6 addresses under one prefix: no partition of the lookup holds more than its share."""
    ips = spark.range(4000).select(F.concat(F.lit("2001:db8::"), F.format_string("%x", "id")).alias("ip"))
    keyed = ips.withColumn("key", ipv6_key("ip"))
    from clickflow.operators.asof import dealt_by_range
    dealt = dealt_by_range(keyed, {"at": F.col("key")}, "t-hot", 16)
    assert dealt.groupBy("_part").count().agg(F.max("count")).first()[0] <= 3 * 4000 // 16
    ranges = spark.createDataFrame([("2001:db8::", "2001:db8::7ff", "lo", "", "", ""), ("2001:db8::", "2001:db8:ffff::", "all", "", "", "")], TEXT)
    got = geo.locate_ips(ips, ranges).groupBy("country_short").count()
    assert dict(rows(got)) == {"lo": 2048, "all": 1952}


def test_bad_ranges_are_listed_and_fail_the_job(spark):
    df = spark.createDataFrame([(-1, 5, "a", "", "", ""), (7, 3, "b", "", "", ""), (0, 2 ** 32, "c", "", "", ""), (None, 4, "d", "", "", ""),
                                (0, 99, "ok", "x", "", "")], TEXT.replace("ip_from string, ip_to string", "ip_from bigint, ip_to bigint"))
    assert sorted(r["country_short"] for r in rg.bad_ranges(df).collect()) == ["a", "b", "c", "d"]
    raw = spark.createDataFrame([("0.0.0.1",)], "ip string")
    with pytest.raises(ValueError, match="bad ends"):
        run_ip_locations(spark, raw, df, work_path(spark, "t-bad"))
    empty = df.limit(0)
    assert rows(geo.locate_ips(raw, empty)) == [("0.0.0.1", None, None, None, None)]


def test_nested_ranges_no_longer_fail_the_job(spark):
    df = spark.createDataFrame([(0, 99, "wide", "Wide", "r", "c"), (10, 20, "in", "In", "r", "c")],
                               TEXT.replace("ip_from string, ip_to string", "ip_from bigint, ip_to bigint"))
    out = work_path(spark, "t-nested")
    run_ip_locations(spark, spark.createDataFrame([("0.0.0.1",), ("0.0.0.15",), ("0.0.0.21",)], "ip string"), df, out)
    assert rows(spark.read.parquet(out), "ip", "country_short") == [("0.0.0.1", "wide"), ("0.0.0.15", "in"), ("0.0.0.21", "wide")]


@pytest.mark.parametrize("parts", [1, 5])
def test_asof_join_equals_a_plain_scan(spark, parts):
    rnd = random.Random(parts)
    # key 0 holds most rows, so it spans several partitions
    keys = [0] * 8 + [1, 2, None]
    marks = [(rnd.choice(keys), rnd.choice([None, *range(100)]), i) for i in range(120)] + [(0, 50, 500), (0, 50, 501)]
    points = [(i, rnd.choice(keys + [7]), rnd.choice([None, *range(110)])) for i in range(300)]
    m = spark.createDataFrame(marks, "k int, t int, v int")
    p = spark.createDataFrame(points, "id int, k int, t int")

    def told(k, t):
        held = [(a, v) for b, a, v in marks if b == k and a is not None and t is not None and k is not None and a <= t]
        return max(held)[1] if held else None
    got = asof_join(p, m.withColumnRenamed("t", "at"), ["k"], "t", "at", "v", num_partitions=parts)
    assert rows(got) == srt((i, k, t, told(k, t)) for i, k, t in points)
    assert "CartesianProduct" not in plan_text(got) and "NestedLoop" not in plan_text(got)
    none = asof_join(p, m.limit(0).withColumnRenamed("t", "at"), ["k"], "t", "at", "v")
    assert none.where("mark IS NOT NULL").count() == 0 and none.count() == 300
