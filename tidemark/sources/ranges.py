"""Read ranges of even depth: bounds of a key between which a source holds equally many rows.

The source counts its keys in cells and only cells in which a bound falls are counted again, more
finely. A skewed key so gets narrow ranges where it is dense. Each step is one aggregate query over
the key column (an index is enough for it) and returns a number of rows that is bounded by cells
and shares, never by the table.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os.path
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Row
from pyspark.sql import types as T

from tidemark.functions.values import is_moment

#: Cells that a range of numbers or moments is counted in, and characters that a text range adds.
CELLS = 512
CHARACTERS = 2

# How each server names a double, and writes a moment as a number that grows with it.
_DOUBLE = {"postgres": "double precision", "mysql": "double", "sqlserver": "float"}
_MOMENT = {
    "postgres": "cast(extract(epoch from {0}) as double precision)",
    "mysql": "cast(timestampdiff(MICROSECOND, timestamp '1970-01-01 00:00:00', {0}) as double)",
    "sqlserver": "cast(datediff_big(millisecond, '1970-01-01', {0}) as float)",
}


@dataclass(frozen=True)
class Cell:
    """Neighbouring keys and their rows; ``length`` is the prefix that texts were counted by."""

    low: object
    high: object
    low_place: float
    high_place: float
    rows: int
    length: int = 0

    def divisible(self) -> bool:
        if isinstance(self.low, str):
            return self.low != self.high and self.length < max(len(self.low), len(self.high))
        return self.low_place < self.high_place and math.isfinite(_steps(self))


def _steps(cell: Cell) -> float:
    half = cell.high_place / 2 - cell.low_place / 2  # the ends may lie further apart than a double
    return CELLS / half if half else math.inf


def literal(connector: str, value: object) -> str:
    """A key value as the source writes it; moments are cut to milliseconds, as servers read them."""
    if isinstance(value, str):
        text = value.replace("'", "''")
        if connector == "mysql":
            text = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"N'{text}'" if connector == "sqlserver" else f"'{text}'"
    if isinstance(value, datetime.datetime):
        return f"'{value.replace(tzinfo=None).isoformat(' ', 'milliseconds')}'"
    if isinstance(value, datetime.date):
        return f"'{value.isoformat()}'"
    return f"{decimal.Decimal(str(value)):f}"


class KeyRanges:
    """Bounds of one key column of a source, found by queries that ``fetch`` runs.

    ``name`` is the quoted column, ``table`` a qualified table and ``where`` a condition or "".
    ``tolerance`` is how far a bound may be off, in parts of a share: 0 gives for bound i the
    smallest key that at least i shares of the rows come before, whatever the table's cells.
    """

    def __init__(
        self,
        fetch: Callable[[str], list[Row]],
        connector: str,
        table: str,
        name: str,
        kind: T.DataType,
        where: str = "",
        tolerance: float = 0.05,
    ):
        self.fetch = fetch
        self.connector = connector
        self.name = name
        self.text = isinstance(kind, T.StringType)
        if self.text:
            place = "0"
        elif is_moment(kind):
            place = _MOMENT[connector].format(name)
        else:
            place = f"cast({name} as {_DOUBLE[connector]})"
        self.keys = f"(SELECT {name} AS k, {place} AS place FROM {table}{where}) AS keyed"
        self.tolerance = tolerance

    def whole(self) -> tuple[Cell | None, int]:
        """All keys as one cell, None where none can be compared, and the number of null keys."""
        row = self.fetch(
            "SELECT COUNT(k) AS held, COUNT(*) AS total, MIN(k) AS low, MAX(k) AS high, "
            f"MIN(place) AS low_place, MAX(place) AS high_place FROM {self.keys}"
        )[0]
        held, total, low, high, *places = row
        if not held:
            return None, total
        ends = [float(p) for p in places]
        if not all(map(math.isfinite, ends)):
            return None, total - held
        return Cell(low, high, *ends, held), total - held

    def _divided(self, spans: Sequence[Cell]) -> list[list[Cell]]:
        """The cells inside each span, in order."""
        inside, cells, lengths = [], [], []
        for span in spans:
            if self.text:
                low, high = literal(self.connector, span.low), literal(self.connector, span.high)
                common = len(os.path.commonprefix([span.low, span.high]))
                lengths.append(max(common, span.length) + CHARACTERS)
                inside.append(f"k >= {low} AND k <= {high}")
                cells.append(f"LEFT(k, {lengths[-1]})")
            else:
                lengths.append(0)
                inside.append(f"place >= {span.low_place:.17e} AND place <= {span.high_place:.17e}")
                half = f"(place * 0.5e0 - ({span.low_place / 2:.17e}))"
                cells.append(f"FLOOR({half} * {_steps(span):.17e})")

        def choose(results: Sequence[object]) -> str:
            when = (f"WHEN {c} THEN {r}" for c, r in zip(inside, results, strict=True))
            return f"CASE {' '.join(when)} END"

        found = self.fetch(
            "SELECT span, COUNT(*) AS held, MIN(k) AS low, MAX(k) AS high, "
            "MIN(place) AS low_place, MAX(place) AS high_place FROM "
            f"(SELECT k, place, {choose(range(len(spans)))} AS span, {choose(cells)} AS cell "
            f"FROM {self.keys}) AS counted WHERE span IS NOT NULL GROUP BY span, cell"
        )
        parts: list[list[Cell]] = [[] for _ in spans]
        for number, held, low, high, low_place, high_place in found:
            parts[number].append(
                Cell(low, high, float(low_place), float(high_place), held, lengths[number])
            )
        for part in parts:
            part.sort(key=lambda cell: cell.low if self.text else cell.low_place)
        return parts

    def bounds(self, shares: int) -> tuple[list, bool]:
        """Ascending keys at which a new share begins, and whether null keys are more than a share.

        Fewer than ``shares - 1`` where single keys hold more rows than a share; none where no
        key can be compared.
        """
        whole, nulls = self.whole()
        if whole is None:
            return [], False
        cells, total = [whole], whole.rows
        while True:
            before, at, open_cells = 0, 1, []
            for number, cell in enumerate(cells):
                after = before + cell.rows
                while at < shares and at * total <= before * shares:
                    at += 1
                crossed = at < shares and at * total < after * shares
                if crossed and cell.divisible() and cell.rows * shares > self.tolerance * total:
                    open_cells.append(number)
                before = after
            if not open_cells:
                break
            parts = dict(zip(open_cells, self._divided([cells[n] for n in open_cells]), strict=True))
            cells = [c for n, cell in enumerate(cells) for c in parts.get(n) or [cell]]
            # Rows may have come or gone since the count before.
            total = sum(cell.rows for cell in cells)
        edges, before, at = [], 0, 1
        for cell in cells:
            if at < shares and at * total <= before * shares:
                edges.append(cell.low)
                while at < shares and at * total <= before * shares:
                    at += 1
            before += cell.rows
        many = nulls * shares > total
        return (self._in_order(edges) if self.text and edges else edges), many

    def _in_order(self, edges: list[str]) -> list[str]:
        """Texts in the column's own order, in which the source compares them."""
        texts = ", ".join(literal(self.connector, edge) for edge in edges)
        found = self.fetch(
            "SELECT k, ROW_NUMBER() OVER (ORDER BY k) AS place FROM "
            f"(SELECT DISTINCT k FROM {self.keys} WHERE k IN ({texts})) AS edges"
        )
        return [row[0] for row in sorted(found, key=lambda row: row[1])]

    def predicates(self, shares: int) -> list[str]:
        """Conditions of which every row fulfils exactly one, also rows that come later.

        Null keys are a share of their own where they are more than one share of the rest.
        """
        edges, many_nulls = self.bounds(shares)
        marks = list(dict.fromkeys(literal(self.connector, edge) for edge in edges))
        if not marks:
            return ["1 = 1"]
        first = f"{self.name} < {marks[0]}"
        inner = [f"{self.name} >= {a} AND {self.name} < {b}" for a, b in zip(marks, marks[1:])]
        rest = [*inner, f"{self.name} >= {marks[-1]}"]
        absent = f"{self.name} IS NULL"
        return [absent, first, *rest] if many_nulls else [f"({first} OR {absent})", *rest]
