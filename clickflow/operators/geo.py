"""IP geolocation: distinct addresses, range lookup, normalise/validate.

Ranges that nest or cross are flattened first (``operators.ranges``: the narrowest wins), and
IPv6 addresses are looked up by 128-bit keys in partitions that follow the data
(``operators.asof``). IPv4 range lookup as an as-of join per /16 bin (no pair generation):
  * each range is cut at /16 bin borders: one "range start" row per bin it covers, at
    max(ip_from, bin start) -- at most (#ranges + 65,536) rows for non-overlapping ranges;
  * each distinct IPv4 address is one row in its bin; text that is not IPv4 goes to a
    hashed negative bin where no range starts (it finds no range);
  * per bin, ordered by position (range starts before addresses at equal position), the
    last range start at or before an address is the only range that can hold it;
    it holds it when the address is <= ip_to.
A bin holds at most 65,536 distinct addresses, so no window partition can grow with the
data; the shuffle is keyed by bin over deduplicated addresses only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.config import INVALID_ADDRESS_TEXT
from clickflow.functions.ipkeys import V4_FIRST, V4_LAST, bytes_of, ipv6_key, v4_number
from clickflow.functions.ipv4 import ipv4_to_long
from clickflow.functions.text import is_blank
from clickflow.operators.asof import asof_join
from clickflow.operators.ranges import disjoint_pieces
from clickflow.session import work_path

LOCATION_COLS = ("country_short", "country_long", "region", "city")
BIN_BITS = 16


def unique_ips(df: DataFrame, ip_col: str = "ip") -> DataFrame:
    """Distinct addresses (null is one group). Hash aggregate with map-side combine, so a
    hot address costs one row per task before the shuffle."""
    return df.select(F.col(ip_col).alias("ip")).distinct()


def count_ips(df: DataFrame, ip_col: str = "ip") -> DataFrame:
    """distinct_ips counts the null group; distinct_ips_non_null does not."""
    return unique_ips(df, ip_col).agg(F.count(F.lit(1)).alias("distinct_ips"),
                                      F.count("ip").alias("distinct_ips_non_null"))


def parse_ipv4(df: DataFrame, ip_col: str = "ip") -> DataFrame:
    return df.withColumn("ip_number", ipv4_to_long(ip_col)).withColumn("is_ipv4", F.col("ip_number").isNotNull())


def range_starts(ranges: DataFrame) -> DataFrame:
    """One row per (range, /16 bin it covers): bin, position, range fields."""
    r = ranges.where(F.col("ip_from").isNotNull() & F.col("ip_to").isNotNull() & (F.col("ip_from") <= F.col("ip_to")))
    b = F.explode(F.sequence(F.shiftright("ip_from", BIN_BITS), F.shiftright("ip_to", BIN_BITS)))
    return (r.select("*", b.alias("_bin"))
            .select("_bin", F.greatest(F.col("ip_from"), F.shiftleft("_bin", BIN_BITS)).alias("_pos"),
                    F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("ip"),
                    F.struct("ip_to", *LOCATION_COLS).alias("_r")))


def _v4_pieces(pieces: DataFrame) -> DataFrame:
    """The part of disjoint pieces inside the IPv4 space, ends as numbers."""
    low, high = bytes_of(V4_FIRST), bytes_of(V4_LAST)
    inside = pieces.where((F.col("hi") >= low) & (F.col("lo") <= high))
    return inside.select(v4_number(F.greatest("lo", low)).alias("ip_from"), v4_number(F.least("hi", high)).alias("ip_to"), *LOCATION_COLS)


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Pairs of ranges that overlap (the as-of lookup assumes none). Checked per /16 bin
    on the cut ranges: within a bin, a range starting at or before the end of the range
    before it overlaps it. Every overlap shows up in some bin, and each bin is bounded
    like the lookup's. Returns (ip_from, ip_to, prev_from, prev_to), one row per overlap
    found per bin (an overlap spanning several bins appears once per bin)."""
    r = ranges.where(F.col("ip_from").isNotNull() & F.col("ip_to").isNotNull() & (F.col("ip_from") <= F.col("ip_to")))
    b = F.explode(F.sequence(F.shiftright("ip_from", BIN_BITS), F.shiftright("ip_to", BIN_BITS)))
    cut = r.select("ip_from", "ip_to", b.alias("_bin")).withColumn(
        "_pos", F.greatest(F.col("ip_from"), F.shiftleft("_bin", BIN_BITS)))
    w = Window.partitionBy("_bin").orderBy("_pos", "ip_from", "ip_to")
    prev_to = F.max("ip_to").over(w.rowsBetween(Window.unboundedPreceding, -1))
    prev_from = F.lag("ip_from").over(w)
    return (cut.withColumn("prev_to", prev_to).withColumn("prev_from", prev_from)
            .where(F.col("prev_to") >= F.col("_pos"))
            .select("ip_from", "ip_to", "prev_from", "prev_to"))


def locate_ips(ips: DataFrame, ranges: DataFrame, ip_col: str = "ip") -> DataFrame:
    """Location fields for each row of ``ips`` (usually distinct addresses).

    * valid IPv4 or IPv6: fields of the range holding it (of several the narrowest, see
      ``operators.ranges``), null when no range does;
    * null or blank text: null fields;
    * anything else: every field is the invalid-address text.

    ``ranges`` with integer ends are IPv4 numbers. Ends in text are 128-bit numbers (IPv4 at its
    mapped place) or addresses, and only they can hold IPv6 addresses.

    Ranges that overlap are flattened first (integer ends are tested for that by one small
    aggregate, text ends are always swept). IPv4 addresses and all other text then take one path (one scan, one
    exchange): text that is not IPv4 is spread over negative bins by hash, where no range starts, so it finds
    no range and cannot pile up in a single window partition. IPv6 addresses look their piece up
    in partitions ranged by key (``asof_join``), which follow the data: a prefix with most of
    the addresses is cut into as many partitions as it needs."""
    if isinstance(ranges.schema["ip_from"].dataType, T.IntegralType):
        inside = ranges.where((F.col("ip_from") >= 0) & (F.col("ip_to") < 1 << 32))
        apart = overlapping_ranges(inside).limit(1).count() == 0
        return _locate_v4(ips, inside if apart else _v4_pieces(disjoint_pieces(ranges, list(LOCATION_COLS))), ip_col)
    pieces = disjoint_pieces(ranges, list(LOCATION_COLS))
    # read twice: once per family
    path = work_path(ips.sparkSession, "range-pieces")
    pieces.write.parquet(path)
    pieces = ips.sparkSession.read.schema(pieces.schema).parquet(path)
    keyed = ips.select(F.col(ip_col).alias("ip"), ipv6_key(F.col(ip_col)).alias("_key"))
    mapped = v4_number(F.col("_key"))
    wide = F.col("_key").isNotNull() & mapped.isNull()
    small = _locate_v4(keyed.where(~wide), _v4_pieces(pieces), "ip", mapped)
    marks = pieces.select("lo", F.struct("hi", *LOCATION_COLS).alias("piece"))
    found = asof_join(keyed.where(wide), marks, [], "_key", "lo", "piece", out="_hit")
    held = F.col("_hit.hi") >= F.col("_key")
    return small.unionByName(found.select("ip", *[F.when(held, F.col(f"_hit.{c}")).alias(c) for c in LOCATION_COLS]))


def _locate_v4(ips: DataFrame, ranges: DataFrame, ip_col: str, mapped: Column | None = None) -> DataFrame:
    """The IPv4 lookup over disjoint ranges; ``mapped`` gives the IPv4 number of mapped IPv6 text."""
    n = ipv4_to_long(F.col(ip_col))
    n = n if mapped is None else F.coalesce(n, mapped)
    hashed_bin = -F.lit(1) - F.pmod(F.xxhash64(F.col(ip_col)), F.lit(1 << BIN_BITS))
    points = ips.select(
        F.when(n.isNotNull(), F.shiftright(n, BIN_BITS)).otherwise(hashed_bin).alias("_bin"),
        F.coalesce(n, F.lit(-1).cast("bigint")).alias("_pos"),
        F.lit(1).alias("_kind"),
        F.col(ip_col).alias("ip"),
    )
    starts = range_starts(ranges)
    points = points.withColumn("_r", F.lit(None).cast(starts.schema["_r"].dataType))
    w = (Window.partitionBy("_bin").orderBy("_pos", "_kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    located = (starts.unionByName(points)
               .withColumn("_hit", F.last("_r", ignorenulls=True).over(w))
               .where(F.col("_kind") == 1))
    valid = F.col("_bin") >= 0
    inside = valid & (F.col("_hit.ip_to") >= F.col("_pos"))
    bad = ~valid & ~(is_blank("ip") | ipv6_key(F.col("ip")).isNotNull())
    return located.select("ip", *[F.when(bad, F.lit(INVALID_ADDRESS_TEXT)).when(inside, F.col(f"_hit.{c}")).alias(c)
                                  for c in LOCATION_COLS])
