"""Running values along each contact's activity log.

A log is totally ordered by ``(activity_date, branch, seq)``. A *scan* is one
value per row that depends on the rows before it (or on the days ahead of it):
running sums, sums within so many days, the previous value, the last known
value, and so on. ``with_scans`` adds any number of them.

Two ways to run them, with equal results:

* Normally the rows of a contact sit in one task. All scans become window
  functions over one hash partitioning and one sort. Only frames that grow
  from the start of the partition are used, because Spark extends those row by
  row; a sliding frame would be re-summed for every row. A sum within ``t``
  days is therefore the running sum minus the sum of everything older, and a
  sum ahead is the running sum ``t`` days on minus the running sum so far.

* A contact with too many rows for one task (see ``touchpath.operators.skew``)
  arrives with a ``chunk`` column. Its rows are cut into cells ``(contact, day,
  chunk)`` of bounded size; scans run inside the cells, each cell is reduced to
  one summary row, the summaries are scanned per contact, and what a cell
  inherits from its predecessors is joined back. A contact has at most one
  cell per calendar day and chunk border, so no task ever sees a whole log.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType
from pyspark.sql.window import Window, WindowSpec

KEY = "contact_id"
DAY = "activity_date"
CHUNK = "chunk"
POSITION = ("branch", "seq")  # order inside one day
CELL = (KEY, DAY, CHUNK)

_START, _HERE = Window.unboundedPreceding, Window.currentRow


@dataclass(frozen=True)
class Scan:
    """One scan; made by the functions below."""

    kind: str
    value: Column | None = None
    days: int | None = None


def running_sum(value: Column) -> Scan:
    """Sum of all rows up to and including this one."""
    return Scan("running_sum", value)


def sum_within(value: Column, days: int) -> Scan:
    """Sum of this and earlier rows at most ``days`` days old (later rows of the same day excluded)."""
    return Scan("sum_within", value, days)


def sum_ahead(value: Column, days: int) -> Scan:
    """Sum of this and later rows at most ``days`` days ahead (earlier rows of the same day excluded)."""
    return Scan("sum_ahead", value, days)


def previous(value: Column) -> Scan:
    """Value of the row before."""
    return Scan("previous", value)


def last_before(value: Column) -> Scan:
    """Last non-null value strictly before this row."""
    return Scan("last_before", value)


def last_upto(value: Column) -> Scan:
    """Last non-null value up to and including this row."""
    return Scan("last_upto", value)


def bits_before(bit: Column) -> Scan:
    """Set of bits (powers of two) met strictly before this row, as a bit mask."""
    return Scan("bits_before", bit)


def list_upto(value: Column) -> Scan:
    """Non-null values so far, in order. For short lists only: the caller bounds them."""
    return Scan("list_upto", value)


def is_first() -> Scan:
    return Scan("is_first")


def is_last() -> Scan:
    return Scan("is_last")


def is_last_of_day() -> Scan:
    """Whether no later row has the same day."""
    return Scan("is_last_of_day")


def with_scans(rows: DataFrame, scans: dict[str, Scan]) -> DataFrame:
    """``rows`` plus one column per scan."""
    if CHUNK in rows.columns:
        return _by_cells(rows, scans)
    return _by_contact(rows, scans)


# --- rows of a contact in one task -------------------------------------------


def _by_contact(rows: DataFrame, scans: dict[str, Scan]) -> DataFrame:
    order = Window.partitionBy(KEY).orderBy(DAY, *POSITION)
    # a value that several scans sum over other spans is kept, and summed so far, once
    source = {name: f"_x_{_first_use(scans, scan.value)}" for name, scan in scans.items() if scan.days is not None}
    ranged = {column: scans[column.removeprefix("_x_")].value for column in source.values()}
    rows = rows.withColumns(ranged) if ranged else rows
    uses = Counter(source[name] for name, scan in scans.items() if scan.kind == "sum_within")
    upto = order.rowsBetween(_START, _HERE)
    totals = {f"_t{column}": _zero(F.sum(column).over(upto)) for column, times in uses.items() if times > 1}
    rows = rows.withColumns(totals) if totals else rows
    found = {}
    for name, scan in scans.items():
        total = f"_t{source.get(name)}"
        shared = scan.kind == "sum_within" and total in totals
        found[name] = F.col(total) - _older(source[name], scan.days) if shared else _whole(scan, source.get(name), order)
    return rows.withColumns(found).drop(*ranged, *totals)


def _first_use(scans: dict[str, Scan], value: Column) -> str:
    return next(name for name, scan in scans.items() if scan.days is not None and scan.value is value)


def _days_sum(column: str, until: str) -> Column:
    """Sum over the days up to ``until``. Serves on the sort of the rows; as SQL, because
    only there a frame over dates takes whole days."""
    return _zero(
        F.expr(
            f"sum(`{column}`) OVER (PARTITION BY {KEY} ORDER BY {DAY} RANGE BETWEEN UNBOUNDED PRECEDING AND {until})"
        )
    )


def _older(column: str, days: int) -> Column:
    return _days_sum(column, f"{days + 1} PRECEDING")


def _reached(column: str, days: int) -> Column:
    return _days_sum(column, f"{days} FOLLOWING")


def _whole(scan: Scan, ranged: str | None, order: WindowSpec) -> Column:
    upto = order.rowsBetween(_START, _HERE)
    before = order.rowsBetween(_START, -1)
    x = scan.value if scan.days is None else F.col(ranged)
    match scan.kind:
        case "running_sum":
            return _zero(F.sum(x).over(upto))
        case "sum_within":
            return _zero(F.sum(x).over(upto)) - _older(ranged, scan.days)
        case "sum_ahead":
            return _reached(ranged, scan.days) - _zero(F.sum(x).over(before))
        case "previous":
            return F.lag(x).over(order)
        case "last_before":
            return F.last(x, ignorenulls=True).over(before)
        case "last_upto":
            return F.last(x, ignorenulls=True).over(upto)
        case "bits_before":
            return _zero(F.bit_or(x).over(before))
        case "list_upto":
            return F.collect_list(x).over(upto)
        case "is_first":
            return F.lag(F.lit(1)).over(order).isNull()
        case "is_last":
            return F.lead(F.lit(1)).over(order).isNull()
        case "is_last_of_day":
            return F.coalesce(F.lead(DAY).over(order) != F.col(DAY), F.lit(True))
    raise ValueError(scan.kind)


def _zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


# --- rows of a contact cut into cells ----------------------------------------


def _by_cells(rows: DataFrame, scans: dict[str, Scan]) -> DataFrame:
    kept = rows.columns
    # sums of sums are wider than sums: they get the types they have in one task
    sums = {name: scan for name, scan in scans.items() if scan.kind in ("running_sum", "sum_within", "sum_ahead")}
    kinds = {field.name: field.dataType for field in _by_contact(rows, sums).schema}
    valued = {name: scan for name, scan in scans.items() if scan.value is not None}
    rows = rows.withColumns({f"_x_{name}": scan.value for name, scan in valued.items()})

    summaries = [F.count("*").alias("_n")]
    summaries += [_summary(scan, F.col(f"_x_{name}")).alias(f"_s_{name}") for name, scan in valued.items()]
    cells = rows.groupBy(*CELL).agg(*summaries)

    order = Window.partitionBy(KEY).orderBy(DAY, CHUNK)
    inherited = cells.select(
        *CELL, *[_inherit(scan, f"_s_{name}", order).alias(f"_c_{name}") for name, scan in scans.items()]
    )

    local_order = Window.partitionBy(*CELL).orderBy(*POSITION)
    local = rows.withColumns(
        {f"_l_{name}": _local(scan, F.col(f"_x_{name}"), local_order) for name, scan in scans.items()}
    )
    joined = local.join(inherited, list(CELL), "left")
    result = joined.select(
        *kept,
        *[
            _typed(_combine(scan, F.col(f"_l_{name}"), F.col(f"_c_{name}"), F.col(f"_x_{name}")), kinds.get(name)).alias(name)
            for name, scan in scans.items()
        ],
    )
    # later scans read this result twice; a written copy keeps the work linear
    return result.checkpoint()


def _typed(value: Column, kind: DataType | None) -> Column:
    return value if kind is None else value.cast(kind)


def _summary(scan: Scan, x: Column) -> Column:
    place = F.struct(*POSITION)
    match scan.kind:
        case "running_sum" | "sum_within" | "sum_ahead":
            return F.sum(x)
        case "previous":
            return F.max_by(F.struct(x.alias("v")), place)
        case "last_before" | "last_upto":
            return F.max_by(x, F.when(x.isNotNull(), place))
        case "bits_before":
            return F.bit_or(x)
        case "list_upto":
            marked = F.collect_list(F.when(x.isNotNull(), F.struct(*POSITION, x.alias("v"))))
            return F.transform(F.array_sort(marked), lambda item: item["v"])
    raise ValueError(scan.kind)


def _inherit(scan: Scan, summary: str, order: WindowSpec) -> Column:
    before = order.rowsBetween(_START, -1)
    s = F.col(summary)
    match scan.kind:
        case "running_sum":
            return _zero(F.sum(s).over(before))
        case "sum_within":
            return _zero(F.sum(s).over(before)) - _older(summary, scan.days)
        case "sum_ahead":
            return _reached(summary, scan.days) - _zero(F.sum(s).over(before))
        case "previous":
            return F.lag(s).over(order)
        case "last_before" | "last_upto":
            return F.last(s, ignorenulls=True).over(before)
        case "bits_before":
            return _zero(F.bit_or(s).over(before))
        case "list_upto":
            return F.flatten(F.collect_list(s).over(before))
        case "is_first":
            return F.lag(F.lit(1)).over(order).isNull()
        case "is_last":
            return F.lead(F.lit(1)).over(order).isNull()
        case "is_last_of_day":
            return F.coalesce(F.lead(DAY).over(order) != F.col(DAY), F.lit(True))
    raise ValueError(scan.kind)


def _local(scan: Scan, x: Column, order: WindowSpec) -> Column:
    upto = order.rowsBetween(_START, _HERE)
    before = order.rowsBetween(_START, -1)
    match scan.kind:
        case "running_sum" | "sum_within":
            return _zero(F.sum(x).over(upto))
        case "sum_ahead":
            return _zero(F.sum(x).over(before))
        case "previous":
            return F.lag(F.struct(x.alias("v"))).over(order)
        case "last_before":
            return F.last(x, ignorenulls=True).over(before)
        case "last_upto":
            return F.last(x, ignorenulls=True).over(upto)
        case "bits_before":
            return _zero(F.bit_or(x).over(before))
        case "list_upto":
            return F.collect_list(x).over(upto)
        case "is_first":
            return F.lag(F.lit(1)).over(order).isNull()
        case "is_last" | "is_last_of_day":
            return F.lead(F.lit(1)).over(order).isNull()
    raise ValueError(scan.kind)


def _combine(scan: Scan, local: Column, inherited: Column, x: Column) -> Column:
    match scan.kind:
        case "running_sum" | "sum_within":
            return inherited + local
        case "sum_ahead":
            return inherited - local
        case "previous":
            return F.coalesce(local, inherited)["v"]
        case "last_before" | "last_upto":
            return F.coalesce(local, inherited)
        case "bits_before":
            return inherited.bitwiseOR(local)
        case "list_upto":
            return F.concat(inherited, local)
        case "is_first" | "is_last" | "is_last_of_day":
            return local & inherited
    raise ValueError(scan.kind)
