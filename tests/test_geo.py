"""IP range lookup vs brute force, address syntax, distinct counts, plan shape."""

import random

from hypothesis import given, settings, strategies as st

from clickflow.operators import geo
from conftest import plan_text, rows

RSCHEMA = "ip_from bigint, ip_to bigint, country_short string, country_long string, region string, city string"


def to_ip(n: int) -> str:
    return ".".join(str((n >> s) & 255) for s in (24, 16, 8, 0))


def brute(ips, ranges):
    out = []
    for ip in ips:
        hit = None
        parts = ip.split(".") if ip else []
        ok = len(parts) == 4 and all(p.isdigit() and str(int(p)) == p and int(p) <= 255 for p in parts)
        if ok:
            n = sum(int(p) << s for p, s in zip(parts, (24, 16, 8, 0)))
            for r in ranges:
                if r[0] <= n <= r[1]:
                    hit = r
            out.append((ip,) + (tuple(hit[2:]) if hit else (None,) * 4))
        elif ip is None or ip == "":
            out.append((ip, None, None, None, None))
        else:
            out.append((ip,) + ("INVALID IP ADDRESS",) * 4)
    return sorted(out, key=lambda t: tuple("" if v is None else str(v) for v in t))


def make_ranges(rnd, n):
    """n non-overlapping ranges with gaps, mixing tiny and /8-sized ones."""
    cuts = sorted(rnd.sample(range(0, 2 ** 32 - 1), 2 * n))
    out = []
    for i in range(n):
        a, b = cuts[2 * i], cuts[2 * i + 1]
        out.append((a, b, f"C{i}", f"Country {i}", f"R{i}", f"City{i}"))
    return out


def test_locate_matches_brute_force(spark):
    rnd = random.Random(3)
    ranges = make_ranges(rnd, 40)
    ips = [to_ip(rnd.randrange(2 ** 32)) for _ in range(300)]
    ips += [to_ip(r[0]) for r in ranges] + [to_ip(r[1]) for r in ranges] + [to_ip(r[1] + 1) for r in ranges]
    ips += ["999.1.1.1", "01.2.3.4", "not-an-ip", "", None, "::1", "2001:db8::1", " 1.2.3.4"]
    ips = list(dict.fromkeys(ips))
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    rdf = spark.createDataFrame(ranges, RSCHEMA)
    got = rows(geo.locate_ips(df, rdf))
    exp = brute(ips, ranges)
    # IPv6 text is not invalid: it simply has no IPv4 range
    exp = [(e[0], None, None, None, None) if e[0] in ("::1", "2001:db8::1") else e for e in exp]
    exp = sorted(exp, key=lambda t: tuple("" if v is None else str(v) for v in t))
    assert got == exp


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1), min_size=1, max_size=40), st.integers(1, 12), st.integers(0, 10 ** 6))
def test_locate_property(spark, points, nranges, seed):
    rnd = random.Random(seed)
    ranges = make_ranges(rnd, nranges)
    ips = list(dict.fromkeys(to_ip(p) for p in points))
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    got = rows(geo.locate_ips(df, spark.createDataFrame(ranges, RSCHEMA)))
    assert got == brute(ips, ranges)


def test_locate_plan_has_no_pairs(spark):
    df = spark.createDataFrame([("1.2.3.4",)], "ip string")
    rdf = spark.createDataFrame([(0, 100, "a", "b", "c", "d")], RSCHEMA)
    text = plan_text(geo.locate_ips(geo.unique_ips(df), rdf))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "Window" in text


def test_count_ips_null_group(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("",), (None,)], "ip string")
    r = geo.count_ips(df).first()
    assert (r["distinct_ips"], r["distinct_ips_non_null"]) == (3, 2)
    assert geo.unique_ips(df).count() == 3


def test_parse_ipv4(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("255.255.255.255",), ("256.1.1.1",), ("1.2.3",), ("a.b.c.d",)],
                               "ip string")
    got = dict(rows(geo.parse_ipv4(df), "ip", "ip_number"))
    assert got == {"1.2.3.4": 16909060, "255.255.255.255": 4294967295, "256.1.1.1": None, "1.2.3": None,
                   "a.b.c.d": None}


def test_csv_range_source_and_missing_file(spark, tmp_path):
    import pytest
    from clickflow.sources.tables import read_ip_ranges
    p = tmp_path / "ranges.csv"
    p.write_text("0,255,US,United States,CA,LA\n256,511,-,-,-,-\n")
    r = read_ip_ranges(spark, str(p), fmt="csv")
    assert [f.name for f in r.schema.fields] == ["ip_from", "ip_to", "country_short", "country_long", "region", "city"]
    df = spark.createDataFrame([("0.0.0.7",), ("0.0.1.1",)], "ip string")
    assert rows(geo.locate_ips(df, r), "ip", "country_short") == [("0.0.0.7", "US"), ("0.0.1.1", "-")]
    with pytest.raises(FileNotFoundError):
        read_ip_ranges(spark, str(tmp_path / "absent.csv"), fmt="csv")



def test_overlapping_ranges_detected(spark):
    ok = spark.createDataFrame([(0, 99, "a", "b", "c", "d"), (100, 70000, "a", "b", "c", "d"),
                                (70001, 200000, "a", "b", "c", "d")], RSCHEMA)
    assert geo.overlapping_ranges(ok).count() == 0
    bad = spark.createDataFrame([(0, 99, "a", "b", "c", "d"), (50, 70000, "a", "b", "c", "d"),
                                 (69000, 69500, "a", "b", "c", "d")], RSCHEMA)
    got = {(r["ip_from"], r["prev_from"]) for r in geo.overlapping_ranges(bad).collect()}
    assert got == {(50, 0), (69000, 50)}


def test_fixture_ranges_are_disjoint(spark):
    from clickflow.sources import fixtures as fx
    from conftest import SF_SMALL
    assert geo.overlapping_ranges(fx.ip_ranges(spark, SF_SMALL)).count() == 0
