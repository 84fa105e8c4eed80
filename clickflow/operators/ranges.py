"""Ranges that may nest, cross or repeat, flattened into disjoint pieces.

Of the ranges that hold an address the narrowest wins; equally wide ones go by the lower
start, equal ranges by the least fields. ``disjoint_pieces`` applies that once to the ranges, so
that a lookup only has to find the piece at or before an address.

The sweep runs per bin over the sorted ends with the open ranges in a heap. Bin borders
come from the data (range partitions of the starts), so bins hold about equal numbers of ranges. A
range gives one row to the bin of its start and one to that of its end; the bins it covers whole
get it through dyadic nodes (about 2 log2(bins) per range), where only the narrowest range per node is
kept: a bin's open state is the narrowest over the nodes above it. Work is near linear in the
ranges however wide they are. Ranges with one start share a bin (CIDR blocks: 129 at most)."""

from __future__ import annotations

import bisect
import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.ipkeys import decimal_key, ip_key, ipv4_key
from clickflow.operators.asof import dealt_by_range

#: Ranges per bin of the sweep.
SWEEP_ROWS = 100_000
_TOP = (1 << 128) - 1


def _keyed(ranges: DataFrame, fields: list[str]) -> DataFrame:
    """(lo, hi, f): both ends as keys (null if they are none) and the fields as a struct. Integer ends are
    IPv4 numbers; text is a 128-bit number in digits or an address."""

    def key(name: str):
        c = F.col(name)
        kind = ranges.schema[name].dataType
        if isinstance(kind, T.IntegralType):
            return ipv4_key(c.cast("long"))
        text = F.trim(c.cast("string"))
        return F.coalesce(decimal_key(text), ip_key(text))

    return ranges.select(key("ip_from").alias("lo"), key("ip_to").alias("hi"), F.struct(*fields).alias("f"))


def bad_ranges(ranges: DataFrame) -> DataFrame:
    """The rows of ``ranges`` whose ends are missing, no address or number, outside the address space, or
    the wrong way round."""
    k = _keyed(ranges, [c for c in ranges.columns])
    return k.where(F.col("lo").isNull() | F.col("hi").isNull() | (F.col("lo") > F.col("hi"))).select("f.*")


def sweep(rows: list[tuple[int, int, int, int, object]]) -> list[tuple[int, int, object]]:
    """Disjoint (lo, hi, value) of rows (lo, hi, start, end, value): at each place the row with the
    narrowest original range start..end wins, then the lower start."""
    rows = sorted(rows, key=lambda r: r[0])
    cuts = sorted({r[0] for r in rows} | {r[1] + 1 for r in rows})
    out: list[tuple[int, int, object]] = []
    heap: list[tuple[int, int, int]] = []
    at, last = 0, -1
    for n, place in enumerate(cuts[:-1]):
        while at < len(rows) and rows[at][0] <= place:
            heapq.heappush(heap, (rows[at][3] - rows[at][2], rows[at][2], at))
            at += 1
        while heap and rows[heap[0][2]][1] < place:
            heapq.heappop(heap)
        if not heap:
            last = -1
            continue
        won, end = heap[0][2], cuts[n + 1] - 1
        if won == last and out[-1][1] == place - 1:
            out[-1] = (out[-1][0], end, out[-1][2])
        else:
            out.append((place, end, rows[won][4]))
        last = won
    return out


def dyadic(first: int, last: int) -> list[tuple[int, int]]:
    """The least number of nodes (level, index), each 2^level bins, that make up first..last."""
    out = []
    while first <= last:
        level = (first & -first).bit_length() - 1 if first else last.bit_length()
        while first + (1 << level) - 1 > last:
            level -= 1
        out.append((level, first >> level))
        first += 1 << level
    return out


def _int(key: bytes) -> int:
    return int.from_bytes(key, "big")


def _key(n: int) -> bytes:
    return n.to_bytes(16, "big")


def _swept(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = [(_int(a), _int(b), _int(c), _int(d), f) for a, b, c, d, f in pdf[["lo", "hi", "start", "end", "f"]].itertuples(index=False)]
    made = sweep(rows)
    return pd.DataFrame({"lo": [_key(m[0]) for m in made], "hi": [_key(m[1]) for m in made], "f": [m[2] for m in made]})


def disjoint_pieces(ranges: DataFrame, fields: list[str], rows_per_bin: int = SWEEP_ROWS) -> DataFrame:
    """(lo, hi, *fields): disjoint pieces of ``ranges`` (ip_from, ip_to inclusive, fields), ends as
    16-byte keys, the narrowest range winning everywhere. Rows of ``bad_ranges`` take no part."""
    k = _keyed(ranges, fields)
    k = k.where(F.col("lo").isNotNull() & F.col("hi").isNotNull() & (F.col("lo") <= F.col("hi")))
    one = k.groupBy("lo", "hi").agg(F.min("f").alias("f"))
    kind = one.schema["f"].dataType.simpleString()
    made = f"lo binary, hi binary, f {kind}"
    # the fields travel as JSON text: equal for equal structs, nulls kept
    packed = one.select("lo", "hi", F.to_json("f", {"ignoreNullFields": "false"}).alias("f"))
    bins = -(-packed.count() // rows_per_bin)
    text = "lo binary, hi binary, f string"
    if bins <= 1:
        alone = packed.select("lo", "hi", F.col("lo").alias("start"), F.col("hi").alias("end"), "f")
        pieces = alone.groupBy().applyInPandas(_swept, text)
    else:
        pieces = _binned(packed, bins).groupBy("bin").applyInPandas(_swept, text)
    return pieces.select("lo", "hi", F.from_json("f", kind).alias("f")).select("lo", "hi", "f.*")


def _binned(packed: DataFrame, bins: int) -> DataFrame:
    """(bin, lo, hi, start, end, f): what each bin has to sweep."""
    dealt = dealt_by_range(packed, {"lo": F.col("lo"), "hi": F.col("hi")}, "range-bins", bins)
    # one border per bin; the first bin begins at 0
    starts = sorted(_int(bytes(r["lo"])) for r in dealt.groupBy("_part").agg(F.min("lo").alias("lo")).collect())
    borders = packed.sparkSession.sparkContext.broadcast(sorted({0, *starts[1:]}))

    def split(batches):
        at = borders.value
        for pdf in batches:
            out = []
            for lo_key, hi_key, f in pdf[["lo", "hi", "f"]].itertuples(index=False):
                lo, hi = _int(lo_key), _int(hi_key)
                a, b = bisect.bisect_right(at, lo) - 1, bisect.bisect_right(at, hi) - 1
                width = _key(hi - lo)
                if a == b:
                    out.append((-1, a, lo_key, hi_key, lo_key, hi_key, width, f))
                    continue
                out.append((-1, a, lo_key, _key(at[a + 1] - 1), lo_key, hi_key, width, f))
                out.append((-1, b, _key(at[b]), hi_key, lo_key, hi_key, width, f))
                out += [(level, index, lo_key, hi_key, lo_key, hi_key, width, f) for level, index in dyadic(a + 1, b - 1)]
            yield pd.DataFrame(out, columns=["level", "bin", "lo", "hi", "start", "end", "width", "f"])

    kind = "level int, bin long, lo binary, hi binary, start binary, end binary, width binary, f string"
    rows = dealt.select("lo", "hi", "f").mapInPandas(split, kind)
    # the narrowest range per node, then per bin the narrowest over the nodes above it
    least = F.min(F.struct("width", "start", "end", "f"))
    nodes = rows.where("level >= 0").groupBy("level", "bin").agg(least.alias("w"))
    each = nodes.select(F.expr("explode(sequence(shiftleft(bin, level), shiftleft(bin + 1, level) - 1)) AS bin"), "w")
    open_ = each.groupBy("bin").agg(F.min("w").alias("w"))

    def cover(batches):
        at = borders.value
        for pdf in batches:
            ends = [_key(at[b + 1] - 1 if b + 1 < len(at) else _TOP) for b in pdf["bin"]]
            yield pdf.assign(lo=[_key(at[b]) for b in pdf["bin"]], hi=ends)[["bin", "lo", "hi", "start", "end", "f"]]

    whole = open_.select("bin", "w.start", "w.end", "w.f").mapInPandas(cover, "bin long, lo binary, hi binary, start binary, end binary, f string")
    return rows.where("level < 0").select("bin", "lo", "hi", "start", "end", "f").unionByName(whole)
