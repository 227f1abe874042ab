"""Merge of two frames: full outer join on the keys, incoming values first.

A key in both sides takes each incoming value that is not null and keeps the
old value otherwise. Other rows of either side pass through. Null keys match
nothing. Repeated keys multiply, as in any join.

A full outer join sends every row of one key to one task and adaptive execution
cannot split it. So rows with a null key are kept out of it (they go straight to
the result, with no shuffle), and the rows of keys that have many are dealt over
the cells of a grid: one part of the old rows and one of the incoming rows each.

Incoming rows known to be few take another way: they are broadcast, the old side
is only streamed past them and never shuffled, and skew does not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F

from tablesync.catalog import quote
from tablesync.spec import SpecError


@dataclass(frozen=True)
class KeySkew:
    """What a merge is told of the keys of its two sides.

    ``hot`` is what ``hot_keys`` found in the very rows that are merged, kept as a
    table; ``broadcast_hot`` says that it was measured and is small.
    """

    null_keys: bool = True
    hot: DataFrame | None = None
    broadcast_hot: bool = False


# Expressions over many columns are written as text: it takes one call to the JVM
# where a Column takes several per column. ``names`` are quoted where need be.


def _any_null(names: Sequence[str]) -> str:
    return "(" + " OR ".join(f"{n} IS NULL" for n in names) + ")"


#: Cells of the sketch that a first look for hot keys counts rows in.
SKETCH_CELLS = 1 << 14


def _tagged(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The keys of both sides' rows as h0, h1, ..., and which side they are from."""
    held = [f"h{i}" for i in range(len(keys))]

    def side(df: DataFrame, incoming: str) -> DataFrame:
        return df.selectExpr(*[f"{quote(k)} AS {h}" for k, h in zip(keys, held)], f"{incoming} AS incoming")

    return side(old, "false").unionAll(side(new, "true")), held


def _counted(rows: DataFrame, by: Sequence[str], least: int) -> DataFrame:
    sides = [F.count_if(F.expr("NOT incoming")).alias("old_rows"), F.count_if("incoming").alias("new_rows")]
    return rows.groupBy(*by).agg(*sides).withColumn("hot", F.expr(f"greatest(old_rows, new_rows) >= {least}"))


def count_hot_keys(
    old: DataFrame, new: DataFrame, keys: Sequence[str], hot_key_rows: int, seen: Observation
) -> DataFrame | None:
    """``hot_keys`` for sides that may have none: None if a count-min sketch shows that.

    The sketch has one row of cells, kept as rows: each key's rows are counted in the cell of
    its hash, so a cell never has fewer than any of its keys. Tasks count before they shuffle,
    at most a row a cell; no key is shuffled. Only keys of hot cells are then counted exactly.
    Where rows are too many for the cells, a second look takes as many as they need.
    """
    cells = SKETCH_CELLS
    while True:
        both, held = _tagged(old, new, keys)
        both = both.observe(seen, F.count_if(F.expr(_any_null(held))).alias("null_keys"))
        cell = f"pmod(xxhash64({', '.join(held)}), {cells}) AS cell"
        sketch = _counted(both.where(f"NOT {_any_null(held)}").selectExpr(cell, "incoming"), ["cell"], hot_key_rows)
        found = sketch.agg(F.count_if("hot").alias("hot"), F.sum(F.expr("old_rows + new_rows")).alias("rows")).first()
        if not found["hot"]:
            return None
        wanted = 8 * found["rows"] // hot_key_rows
        if found["hot"] * 8 <= cells or cells >= wanted:
            break
        cells, seen = 1 << wanted.bit_length(), Observation()
    suspects = _counted(
        _tagged(old, new, keys)[0].where(f"NOT {_any_null(held)}").selectExpr(cell, "incoming"), ["cell"], hot_key_rows
    ).where("hot").select("cell")
    return hot_keys(old, new, keys, hot_key_rows, suspects=(cell, suspects))


def hot_keys(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    hot_key_rows: int,
    seen: Observation | None = None,
    suspects: tuple[str, DataFrame] | None = None,
) -> DataFrame:
    """The keys that ``hot_key_rows`` rows or more of a side have, counted exactly.

    Columns: the key as h0, h1, ...; ``old_parts`` and ``new_parts``, how many parts of
    about ``hot_key_rows`` rows each side's rows make, at least one; ``paired``, whether
    both sides have the key. Reads the key columns of all rows once; tasks count before
    they shuffle. There are at most as many hot keys as parts of the two sides. ``seen``
    takes the number of rows with a null key as ``null_keys``. ``suspects``, an expression
    and its values, tells which keys can be hot; others are not counted.
    """
    both, held = _tagged(old, new, keys)
    if seen:
        both = both.observe(seen, F.count_if(F.expr(_any_null(held))).alias("null_keys"))
    both = both.where(f"NOT {_any_null(held)}")
    if suspects:
        cell, values = suspects
        both = both.selectExpr("*", cell).join(values, "cell", "left_semi").select(*held, "incoming")
    return (
        _counted(both, held, hot_key_rows)
        .where("hot")
        .selectExpr(
            *held,
            *[f"greatest(1, (CAST({s}_rows AS BIGINT) + {hot_key_rows - 1}) div {hot_key_rows}) AS {s}_parts" for s in ("old", "new")],
            "old_rows > 0 AND new_rows > 0 AS paired",
        )
    )


def check_unique(df: DataFrame, keys: Sequence[str], side: str) -> None:
    """Refuse repeated keys. Rows with a null key match nothing and may repeat."""
    names = [quote(k) for k in keys]
    repeated = (
        df.where(f"NOT {_any_null(names)}")
        .groupBy(*names)
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > 1)
        .first()
    )
    if repeated is not None:
        shown = ", ".join(f"{k}={repeated[i]!r}" for i, k in enumerate(keys))
        raise SpecError(f"{side} rows repeat the merge key {shown} ({repeated['row_count']} rows)")


class _Merge:
    """Names both sides apart by position, so that any column name is safe."""

    def __init__(self, columns: Sequence[str], keys: Sequence[str]):
        self.columns = [quote(c) for c in columns]
        self.keys = [list(columns).index(k) for k in keys]

    def side(self, df: DataFrame, prefix: str) -> DataFrame:
        return df.selectExpr(*[f"{c} AS {prefix}{i}" for i, c in enumerate(self.columns)])

    def names(self, prefix: str) -> list[str]:
        return [f"{prefix}{i}" for i in self.keys]

    def on(self, left: str = "o", right: str = "n") -> str:
        return " AND ".join(f"{left}{i} = {right}{i}" for i in self.keys)

    def picked(self, joined: DataFrame, *more: str) -> DataFrame:
        """The incoming value, or the old one where the incoming value is null."""
        chosen = [f"coalesce(n{i}, o{i}) AS {c}" for i, c in enumerate(self.columns)]
        return joined.selectExpr(*chosen, *more)

    def plain(self, df: DataFrame, prefix: str) -> DataFrame:
        return df.selectExpr(*[f"{prefix}{i} AS {c}" for i, c in enumerate(self.columns)])

    def dealt(self, side: DataFrame, prefix: str, skew: KeySkew) -> DataFrame:
        """The rows of a side with the cell they meet the other side's rows in.

        A row of a hot key is in the part of the task that reads it, which is stable
        when a task is run again and also parts equal rows, and is copied to that
        part's cell with each part of the other side. All other rows are in cell 0.
        """
        hot = F.broadcast(skew.hot) if skew.broadcast_hot else skew.hot
        on = " AND ".join(f"{name} = h{i}" for i, name in enumerate(self.names(prefix)))
        own, across = ("old_parts", "new_parts") if prefix == "o" else ("new_parts", "old_parts")
        part, others, width = f"pmod(task, coalesce({own}, 1))", f"coalesce({across}, 1)", "coalesce(new_parts, 1)"
        if prefix == "o":
            cells = f"sequence({part} * {width}, {part} * {width} + {others} - 1)"
        else:
            cells = f"sequence({part}, {part} + ({others} - 1) * {width}, {width})"
        return (
            side.selectExpr("*", "CAST(spark_partition_id() AS BIGINT) AS task")
            .join(hot, F.expr(on), "left_outer")
            .selectExpr(*side.columns, f"coalesce(paired, false) AS {prefix}_paired", f"explode({cells}) AS {prefix}_cell")
        )

    def outer(self, left: DataFrame, right: DataFrame, skew: KeySkew) -> DataFrame:
        """Full outer join of rows without null keys."""
        if skew.hot is None:
            return self.picked(left.join(right, F.expr(self.on()), "full_outer"))
        left, right = self.dealt(left, "o", skew), self.dealt(right, "n", skew)
        joined = left.join(right, F.expr(f"{self.on()} AND o_cell = n_cell"), "full_outer")
        # A key that both sides have has all its matches in cells with rows of both;
        # what a cell leaves without a match there is a copy.
        copy = "coalesce(o_paired, n_paired) AND (o_cell IS NULL OR n_cell IS NULL)"
        return self.picked(joined.where(f"NOT ({copy})"))


def _checked(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> _Merge:
    if not keys:
        raise SpecError("merge needs keys")
    if set(old.columns) != set(new.columns):
        raise SpecError(
            f"columns differ: only old {sorted(set(old.columns) - set(new.columns))}, "
            f"only incoming {sorted(set(new.columns) - set(old.columns))}"
        )
    return _Merge(old.columns, keys)


def merge_few(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge incoming rows that are few enough to broadcast; the caller has checked.

    The old side is read twice, once in full and once for its keys alone, to tell
    which incoming rows are new. Its rows stay in the tasks that read them.
    """
    merge = _checked(old, new, keys)
    left, right = merge.side(old, "o"), merge.side(new, "n")
    updated = merge.picked(left.join(F.broadcast(right), F.expr(merge.on()), "left_outer"))
    # At most one row per incoming key.
    present = (
        left.select(*merge.names("o"))
        .join(F.broadcast(right.select(*merge.names("n"))), F.expr(merge.on()), "left_semi")
        .distinct()
    )
    inserted = right.join(F.broadcast(present), F.expr(merge.on("n", "o")), "left_anti")
    return updated.unionAll(merge.plain(inserted, "n"))


def merge_matched(old: DataFrame, new: DataFrame, keys: Sequence[str], carried: str) -> DataFrame:
    """The merged rows of keys found in both sides, with one more old column."""
    merge = _checked(old.drop(carried), new, keys)
    left = old.selectExpr(*[f"{c} AS o{i}" for i, c in enumerate(merge.columns)], carried)
    return merge.picked(left.join(merge.side(new, "n"), F.expr(merge.on())), carried)


def merge_frames(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    skew: KeySkew = KeySkew(),
    apart: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Merge ``new`` into ``old``. Both have the same columns.

    Each side is read once, and once more for its null keys if there may be any.
    ``skew`` does not change the result, as long as it tells the truth of these rows.
    ``apart`` is applied to the rows with a null key, which the join has not moved.
    """
    merge = _checked(old, new, keys)
    left, right = merge.side(old, "o"), merge.side(new, "n")
    branches: list[DataFrame] = []

    if skew.null_keys:
        for side, prefix in ((left, "o"), (right, "n")):
            branches.append(merge.plain(side.where(_any_null(merge.names(prefix))), prefix))
        left = left.where(f"NOT {_any_null(merge.names('o'))}")
        right = right.where(f"NOT {_any_null(merge.names('n'))}")

    if branches and apart:
        branches = [apart(reduce(DataFrame.unionAll, branches))]
    return reduce(DataFrame.unionAll, branches, merge.outer(left, right, skew))
