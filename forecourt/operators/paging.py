"""Row numbers over a whole table, and the pages cut by them, without one big task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from forecourt.functions.workspace import cut_lineage

_PARTITION_BITS = 33  # monotonically_increasing_id: partition number above, row number below
_SAMPLE_PER_BOUND = 64
_MAX_ROUNDS = 12  # more than any table needs; what is left after them is sorted


def with_row_number(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Number the rows 1, 2, 3, … in the given order, as ``row_no`` beside ``total_records``.

    Rows are range-partitioned and sorted inside each partition; a row's number
    is its place there plus the rows in all lower partitions. The placed rows are
    written once, so that counts and rows come from the same partitioning. Only
    one count per partition meets in a single task. ``order`` should be unique.
    """
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__place", place)
    )
    placed = cut_lineage(placed)
    part = F.shiftright("__place", _PARTITION_BITS)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    lower = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("__size").over(lower), F.lit(0))
    total = F.sum("__size").over(Window.partitionBy())
    offsets = sizes.select("__part", below.alias("__below"), total.alias("total_records"))
    within = F.col("__place") - F.shiftleft(part, _PARTITION_BITS)
    return (
        placed.withColumn("__part", part)
        .join(offsets, "__part")
        .withColumn("row_no", F.col("__below") + within + 1)
        .select(*df.columns, "row_no", "total_records")
    )


def page_number(row_no: Column, size: int) -> Column:
    return (F.floor((row_no - 1) / size) + 1).cast("bigint")


def _comparable(df: DataFrame, name: str) -> Column:
    """A column in a form that survives the way through the driver: times as microseconds."""
    is_time = df.schema[name].dataType.typeName() == "timestamp"
    return F.unix_micros(name) if is_time else F.col(name)


def _row_hash(df: DataFrame) -> Column:
    """Hash of a whole row, maps by their entries; maps inside other columns do not take part."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return F.xxhash64(
        *[
            F.map_entries(c) if kind.startswith("map<") else F.col(c)
            for c, kind in kinds.items()
            if "map<" not in kind[1:]
        ]
    )


def _bound(keyed: DataFrame, values: Row) -> Column:
    """A key as a literal of the key's own type."""
    fields = keyed.schema["__key"].dataType.fields
    return F.struct(
        *[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, values, strict=True)]
    )


def _between(keyed: DataFrame, lead: str | None, low: Row | None, high: Row | None) -> DataFrame:
    """Rows strictly between two keys; ``lead``, the key's first column, reaches the scan."""
    key = F.col("__key")
    if low is not None:
        keyed = keyed.filter(key > _bound(keyed, low))
        if lead and low[0] is not None:
            keyed = keyed.filter(F.col(lead) >= F.lit(low[0]))
    if high is not None:
        keyed = keyed.filter(key < _bound(keyed, high))
        if lead:
            missing = F.col(lead).isNull()
            upper = missing if high[0] is None else missing | (F.col(lead) <= F.lit(high[0]))
            keyed = keyed.filter(upper)
    return keyed


def _places(
    df: DataFrame,
    levels: list[list[Column]],
    lead: str | None,
    first: int,
    last: int,
    count: int,
    sort_at_most: int,
    bounds: int,
) -> list[DataFrame]:
    """Frames that together hold the rows at the places from ``first`` up to ``last``.

    Rows are in the order of the first level's columns, ties in that of the next
    level; ties of the last level are equal rows, any of which will do.
    """
    if first >= last:
        return []
    if (first, last) == (0, count):
        return [df]
    if not levels:
        return [df.limit(last - first)]
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(levels[0])])
    keyed = df.select("*", key.alias("__key"))
    here = F.col("__key")
    low = high = None
    below, left = 0, count  # rows up to and with ``low``; rows between ``low`` and ``high``
    at_low = at_high = 0
    enough = sort_at_most + 2 * (last - first)  # beyond it most rows lie outside the page
    for _ in range(_MAX_ROUNDS):
        if left <= enough or below >= last or first >= below + left:
            break
        inner = _between(keyed, lead, low, high)
        sample = inner.select("__key").orderBy(F.rand()).limit(bounds * _SAMPLE_PER_BOUND)
        drawn = [r[0] for r in sample.distinct().sort("__key").collect()]
        step = -(-len(drawn) // bounds)
        cuts = drawn[step // 2 :: step]
        cut_list = F.array(*[_bound(keyed, c) for c in cuts])
        stretch = F.size(F.filter(cut_list, lambda c: c <= here)).alias("stretch")
        counted = inner.groupBy(stretch, F.array_contains(cut_list, here).alias("same")).count()
        sizes = {(r["stretch"], r["same"]): r["count"] for r in counted.collect()}
        start, end = below, below + left
        start += sizes.get((0, False), 0)
        for i, cut in enumerate(cuts, 1):
            same = sizes.get((i, True), 0)
            if start <= first:
                low, below, at_low = cut, start + same, same
            elif start + same >= last:
                high, end, at_high = cut, start, same
                break
            start += same + sizes.get((i, False), 0)
        left = end - below

    def ties(cut: Row, start: int, same: int) -> list[DataFrame]:
        equal = keyed.filter(here == _bound(keyed, cut)).drop("__key")
        begin, stop = max(first - start, 0), min(last - start, same)
        return _places(equal, levels[1:], None, begin, stop, same, sort_at_most, bounds)

    pieces = [] if low is None else ties(low, below - at_low, at_low)
    skip, upto = max(first - below, 0), min(last - below, left)
    if upto > skip:
        inner = _between(keyed, lead, low, high)
        if (skip, upto) != (0, left):
            inner = inner.orderBy(here, *[k for level in levels[1:] for k in level])
            inner = inner.offset(skip).limit(upto - skip)
        pieces.append(inner.drop("__key"))
    return pieces if high is None else pieces + ties(high, below + left, at_high)


def page_slice(
    df: DataFrame,
    order: Sequence[str],
    page: int,
    size: int,
    sort_at_most: int = 100_000,
    bounds: int = 32,
) -> DataFrame:
    """The rows of one page, with total records and pages; deep pages cost no more.

    The page is found by order statistics: ``bounds`` keys from a random sample
    are counted against all rows, and only the stretch that holds the page is
    looked at again, until no more than ``sort_at_most`` rows and two pages are left
    to be sorted. A round reads the columns of ``order`` only and cuts the stretch to
    about a thirtieth; nothing is written, and only sampled keys and counts reach
    the driver. The counts are exact, so the sample decides how many rounds are
    needed and never what is returned.

    NULLs come first. Rows that tie in ``order`` are ordered by a hash of the row,
    so pages neither overlap nor leave rows out; the rows of a key that fills a
    third of the table are narrowed by that hash in the same way, and equal rows
    are taken without being sorted. ``order`` names columns of plain types. The
    frame must give the same rows each time it is read. Pages beyond the end, and
    pages of an empty table, are empty.
    """
    if page < 1 or size < 1:
        raise ValueError("pages and sizes start at 1")
    keys = [_comparable(df, c) for c in order]
    lead = order[0] if df.schema[order[0]].dataType.typeName() != "timestamp" else None
    total = df.count()
    first, last = (page - 1) * size, min(page * size, total)
    levels = [keys, [_row_hash(df)]]
    pieces = _places(df, levels, lead, first, last, total, sort_at_most, bounds)
    rows = reduce(DataFrame.unionAll, pieces) if pieces else df.limit(0)
    return rows.select(
        *df.columns,
        F.lit(total).cast("bigint").alias("total_records"),
        F.lit(-(-total // size)).cast("bigint").alias("total_pages"),
    )


def paged_envelopes(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """One JSON text per page: ``{page, page_size, total_records, total_pages, data}``.

    Beside ``page`` and ``raw_json`` there is ``n_records``, the records on the page.

    A page holds at most ``size`` records, so no group grows with the data.
    """
    numbered = with_row_number(df, order)
    record = F.struct(*df.columns)
    pages = numbered.groupBy(page_number(F.col("row_no"), size).alias("page")).agg(
        F.max("total_records").alias("total_records"),
        F.sort_array(F.collect_list(F.struct("row_no", record.alias("record")))).alias("rows"),
    )
    envelope = F.struct(
        "page",
        F.lit(size).alias("page_size"),
        "total_records",
        F.ceil(F.col("total_records") / size).alias("total_pages"),
        F.col("rows.record").alias("data"),
    )
    return pages.select(
        "page",
        F.to_json(envelope, {"ignoreNullFields": "false"}).alias("raw_json"),
        F.size("rows").cast("bigint").alias("n_records"),
    )
