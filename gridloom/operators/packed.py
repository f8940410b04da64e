"""Training rows of all horizons, packed: one row for the horizons of an hour whose inputs differ in little.

Of the inputs only ``horizon`` and the trailing day (as it stood at the origin) change from
one horizon to the next inside a band; the others stand once in a packed row, beside the arrays
_h, _m and _s of the horizons and of the two trailing values. Sums of products, predictions and errors
are taken from the arrays by numpy, so rows are multiplied by the horizons only where a result needs
them (``unpacked``), and neither stored nor shuffled after.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import gram

ARRAYS = ("_h", "_m", "_s")
#: Horizons are unpacked for so many numbers of inputs at a time.
HELD = 1 << 22


def is_packed(df: DataFrame) -> bool:
    return "_h" in df.columns


def runs(horizons: Sequence[int], bands: Sequence[tuple[str, int, int]]) -> list[list[int]]:
    """Horizons in groups of one band and one side of 24 hours."""
    out: dict[tuple, list[int]] = {}
    for h in horizons:
        band = next((name for name, first, last in bands if first <= h <= last), None)
        out.setdefault((band, h > 24), []).append(h)
    return list(out.values())


def varying(target: str) -> dict[str, str]:
    """The inputs that a packed row holds as arrays."""
    return {"horizon": "_h", f"{target}_roll_24h_mean": "_m", f"{target}_roll_24h_std": "_s"}


def unpacked(df: DataFrame, target: str, also: Sequence[str] = ()) -> DataFrame:
    """One row a horizon, with the inputs as columns; ``also`` names further arrays of horizons."""
    names = {v: k for k, v in varying(target).items()} | {c: c for c in also}
    plain = [c for c in df.columns if c not in names]
    arrays = [c for c in df.columns if c in names]
    return df.select(*plain, F.inline(F.arrays_zip(*arrays))).select(*plain, *(F.col(c).alias(names[c]) for c in arrays))


def frame(table: pa.Table, target: str, names: Sequence[str]) -> pd.DataFrame:
    """The columns ``names`` of packed rows as a pandas table of one row a horizon."""
    arrays, flat = varying(target), table.combine_chunks()
    of = pa.array(np.repeat(np.arange(flat.num_rows), flat.column("_h").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)))
    inside = {c: flat.column(arrays[c]).combine_chunks().flatten() for c in names if c in arrays}
    return pa.table([inside[c] if c in inside else flat.column(c).take(of) for c in names], names=list(names)).to_pandas()


class Layout:
    """Where the inputs of a model stand: those of a whole packed row, and those in its arrays."""

    def __init__(self, target: str, features: Sequence[str], missing: Sequence[str]) -> None:
        inside = varying(target)
        self.plain = [f for f in features if f not in inside]
        self.arrays = [inside[f] for f in features if f in inside]
        at = {f: 1 + i for i, f in enumerate(features)} | {f"?{f}": 1 + len(features) + i for i, f in enumerate(missing)}
        self.holes = [self.plain.index(f) for f in missing if f not in inside]
        self.array_holes = [self.arrays.index(inside[f]) for f in missing if f in inside]
        # columns of [1, plain, holes of plain, arrays, holes of arrays] in the order of the model's inputs
        moved = [0, *(at[f] for f in self.plain), *(at[f"?{f}"] for f in missing if f not in inside), *(at[f] for f in features if f in inside), *(at[f"?{f}"] for f in missing if f in inside)]
        self.fixed, self.size = 1 + len(self.plain) + len(self.holes), len(moved)
        self.moved, self.order = np.array(moved), np.argsort(moved)

    def columns(self) -> list:
        return [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(self.plain)] + [F.col(c) for c in dict.fromkeys(["_h", *self.arrays])]

    def parts(self, columns: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the columns of ``columns()``: (rows, fixed), the inputs in arrays as (all horizons, rest), and where each row's begin."""
        flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        n = len(flat[-1])
        fixed = gram.inputs(flat[: len(self.plain)], self.holes) if self.plain else np.ones((n, 1))
        named = dict(zip(dict.fromkeys(["_h", *self.arrays]), flat[len(self.plain) :], strict=True))
        sizes = named["_h"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        inside = [named[c].flatten() for c in self.arrays]
        rest = [c.fill_null(0).to_numpy(zero_copy_only=False) for c in inside] + [inside[i].is_null().to_numpy(zero_copy_only=False) for i in self.array_holes]
        many = np.column_stack(rest).astype(np.float64) if rest else np.zeros((int(sizes.sum()), 0))
        return fixed, many, np.concatenate(([0], np.cumsum(sizes)))

    def whole(self, columns: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        """All rows unpacked, inputs in the model's order, and the packed row that each is from."""
        fixed, many, begin = self.parts(columns)
        of = np.repeat(np.arange(len(fixed)), np.diff(begin))
        return np.hstack([fixed[of], many])[:, self.order], of


def blocks(rows: DataFrame, keys: Sequence[str], target: str, features: Sequence[str], missing: Sequence[str]) -> DataFrame:
    """What ``gram.blocks`` gives of the unpacked rows, from sums over the horizons of each packed row."""
    keys = list(keys)
    layout = Layout(target, features, missing)
    upper = np.triu_indices(layout.size)
    schema = T.StructType([rows.schema[k] for k in keys] + T.StructType.fromDDL(gram.BLOCK).fields)
    names = schema.names
    flat = rows.select(*keys, F.col(target).cast("double").alias("_y"), *layout.columns())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        types: list[pa.DataType] = []

        def out() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in held], kind) for i, kind in enumerate(types)]
            n, yy, xx, xy = zip(*held.values(), strict=True)
            made = [pa.array(n, pa.int64()), pa.array(yy, pa.float64())]
            made += [pa.array([m[np.ix_(layout.order, layout.order)][upper] for m in xx], pa.list_(pa.float64())), pa.array([m[layout.order] for m in xy], pa.list_(pa.float64()))]
            held.clear()
            return pa.RecordBatch.from_arrays([*columns, *made], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            types = [c.type for c in batch.columns[: len(keys)]]
            y = batch.column(len(keys)).to_numpy(zero_copy_only=False)
            fixed, many, begin = layout.parts(batch.columns[len(keys) + 1 :])
            each = np.diff(begin)
            sums = np.add.reduceat(np.vstack([many, np.zeros((1, many.shape[1]))]), begin[:-1], axis=0) if many.shape[1] else many[: len(y)].reshape(len(y), 0)
            sums[each == 0] = 0.0
            order, edges, groups = gram.grouped(batch, len(keys))
            for key, a, b in zip(groups, edges, [*edges[1:], batch.num_rows], strict=True):
                own = order[a:b]
                w, f, s, v = each[own].astype(np.float64), fixed[own], sums[own], y[own]
                inner = many[np.repeat(begin[own], each[own]) + _counts(each[own])]
                cross = f.T @ s
                new = [int(w.sum()), float(w @ (v * v)), np.block([[(f.T * w) @ f, cross], [cross.T, inner.T @ inner]]), np.concatenate([(v * w) @ f, v @ s])]
                held[key] = [p + q for p, q in zip(held[key], new, strict=True)] if key in held else new
            if len(held) > gram.HELD:
                yield out()
        if held:
            yield out()

    return flat.mapInArrow(run, schema)


def _counts(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... of each run of ``sizes``."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def dotted(rows: DataFrame, target: str, features: Sequence[str], missing: Sequence[str], models: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """Packed rows (their columns ``keep``) with each column of coefficients in ``models`` replaced by an array: its product with the inputs at each horizon, null without coefficients."""
    layout, models = Layout(target, features, missing), list(models)
    kept = [c for c in (keep or rows.columns) if c not in models]
    flat = rows.select(*kept, *(F.col(m) for m in models), F.struct(*layout.columns()).alias("_in"))
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(m, T.ArrayType(T.DoubleType())) for m in models])
    size, names = layout.size, schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, HELD // (48 * size))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                fixed, many, begin = layout.parts(part.column(len(kept) + len(models)).flatten())
                of = np.repeat(np.arange(part.num_rows), np.diff(begin))
                made = []
                for i in range(len(models)):
                    column = part.column(len(kept) + i)
                    there = column.is_valid().to_numpy(zero_copy_only=False)
                    c = np.zeros((part.num_rows, size))
                    c[there] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                    c = c[:, layout.moved]
                    told = (fixed * c[:, : layout.fixed]).sum(axis=1)[of] + (many * c[of, layout.fixed :]).sum(axis=1)
                    made.append(pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(told, mask=~there[of])))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *made], names=names)

    return flat.mapInArrow(run, schema)
