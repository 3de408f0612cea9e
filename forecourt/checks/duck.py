"""Oracle text: the lens views and output columns in DuckDB's SQL."""

from __future__ import annotations

from forecourt.checks.compare import NULLABLE_NUMBERS
from forecourt.lens import LINE_KEYS, LINE_NEWEST_FIRST, SOURCE_TABLES, VIEWS, view_inputs
from forecourt.schemas import AUDIT_COLUMNS, column_types

_NEWEST = ", ".join(f"{c} DESC NULLS LAST" for c in LINE_NEWEST_FIRST)

# Views by name; VIEWS of the lens are added below, model views by the check modules.
SQL_VIEWS: dict[str, tuple[list[str], str]] = {
    "lines": (
        [],
        f"""SELECT * EXCLUDE (version_no) FROM (
            SELECT *, row_number() OVER (PARTITION BY {", ".join(LINE_KEYS)}
                                         ORDER BY {_NEWEST}) AS version_no
            FROM lineitem) WHERE version_no = 1""",
    ),
    "part_regions": (
        [],
        "SELECT part.*, n AS region_no FROM part, range(5) AS numbers(n)",
    ),
}


def _duck(text: str) -> str:
    return (
        text.replace("TIMESTAMP_NTZ", "TIMESTAMP")
        .replace("{listing_no}", "json_extract_string(props, '$.k')")
        .replace("{", "")
        .replace("}", "")
    )


for _name, _text in VIEWS.items():
    SQL_VIEWS[_name] = (
        [i for i in view_inputs(_name) if i not in SOURCE_TABLES],
        _duck(_text),
    )


def with_views(body: str, *names: str) -> str:
    """``WITH`` clause holding the named views and all they need, before the body."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in SQL_VIEWS[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    clauses = ",\n".join(f"{n} AS MATERIALIZED ({SQL_VIEWS[n][1]})" for n in ordered)
    return f"WITH {clauses}\n{body}"


def plain_column(name: str, kind: str) -> str:
    """One output column in the form in which both engines are compared."""
    if kind.startswith("decimal") or name in NULLABLE_NUMBERS:
        return f"CAST({name} AS DOUBLE) AS {name}"
    if kind == "int":
        return f"CAST({name} AS BIGINT) AS {name}"
    if kind in ("date", "boolean"):
        return f"CAST({name} AS VARCHAR) AS {name}"
    if kind.startswith("timestamp"):
        return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"
    return name


def table_output(table: str, source: str, *views: str, skip: tuple[str, ...] = ()) -> str:
    """SELECT of a table's data columns from a view, in comparable form."""
    hidden = {*AUDIT_COLUMNS, *skip}
    columns = ", ".join(
        plain_column(n, k) for n, k in column_types(table).items() if n not in hidden
    )
    return with_views(f"SELECT {columns} FROM {source}", *(views or (source,)))


def half_up(numerator: str, denominator: str, scale: int) -> str:
    """``numerator / denominator`` rounded half-up, for whole numbers >= 0; NULL over 0."""
    top = f"(2 * CAST({numerator} AS HUGEINT) * {10**scale} + ({denominator}))"
    return (
        f"CASE WHEN ({denominator}) <> 0 THEN CAST({top} // (2 * ({denominator})) AS DOUBLE)"
        f" / {10**scale} END"
    )
