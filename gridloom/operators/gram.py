"""Sums of products for least squares, as mergeable blocks.

A block holds n, the sum of squares of the target, and the sums of products of the
inputs with each other (the upper triangle) and with the target, as arrays. Tasks make
one block a group from whatever rows they see; blocks of disjoint rows add up. So
fitting costs one pass, an update adds two tables, and models as of many moments
are running sums over the blocks between them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Groups whose blocks a task holds before it hands them on.
HELD = 256
BLOCK = "n long, yy double, xx array<double>, xy array<double>"


def _schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([df.schema[k] for k in keys] + T.StructType.fromDDL(BLOCK).fields)


def inputs(columns: Sequence[pa.Array], missing: Sequence[int]) -> np.ndarray:
    """Rows of 1, the inputs with 0 for null, and an indicator of null for those at ``missing``."""
    flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    filled = [c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in flat]
    holes = [flat[i].is_null().to_numpy(zero_copy_only=False) for i in missing]
    n = len(filled[0]) if filled else 0
    return np.column_stack([np.ones(n), *filled, *holes]).astype(np.float64)


def grouped(batch: pa.RecordBatch, keys: int) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """An order in which equal values of the first ``keys`` columns stand together, where each group begins in it, and the groups' values."""
    code = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns[:keys]:
        own = column.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        code = np.unique(code * (own.max() + 1) + own, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], np.diff(code[order]) != 0)))
    first = pa.array(order[edges])
    return order, edges, list(zip(*(c.take(first).to_pylist() for c in batch.columns[:keys]), strict=True)) if keys else [()] * len(edges)


def blocks(rows: DataFrame, keys: Sequence[str], target: str, features: Sequence[str], missing: Sequence[str]) -> DataFrame:
    """keys and BLOCK: a block of each group of ``keys`` from each task that has rows of it. Rows need a target."""
    keys, holes = list(keys), [list(features).index(f) for f in missing]
    upper = np.triu_indices(1 + len(features) + len(holes))
    schema = _schema(rows, keys)
    names = schema.names
    flat = rows.select(*keys, F.col(target).cast("double").alias("_y"), *(F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        types: list[pa.DataType] = []

        def out() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in held], kind) for i, kind in enumerate(types)]
            n, yy, xx, xy = zip(*held.values(), strict=True)
            made = [pa.array(n, pa.int64()), pa.array(yy, pa.float64()), pa.array([m[upper] for m in xx], pa.list_(pa.float64())), pa.array(list(xy), pa.list_(pa.float64()))]
            held.clear()
            return pa.RecordBatch.from_arrays([*columns, *made], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            types = [c.type for c in batch.columns[: len(keys)]]
            order, edges, groups = grouped(batch, len(keys))
            y = batch.column(len(keys)).to_numpy(zero_copy_only=False)[order]
            x = inputs(batch.columns[len(keys) + 1 :], holes)[order] if features else np.ones((batch.num_rows, 1))
            for key, a, b in zip(groups, edges, [*edges[1:], batch.num_rows], strict=True):
                part, own = x[a:b], y[a:b]
                new = [b - a, own @ own, part.T @ part, own @ part]
                held[key] = [p + q for p, q in zip(held[key], new, strict=True)] if key in held else new
            if len(held) > HELD:
                yield out()
        if held:
            yield out()

    return flat.mapInArrow(run, schema)


def reweighted(rows: DataFrame, keys: Sequence[str], target: str, features: Sequence[str], missing: Sequence[str], coefficients: str, power: float, layout=None) -> DataFrame:
    """Blocks of the working least squares of a log-link model with variance mean^power, at each row's ``coefficients``.

    n is the sum of weights, to the nearest whole number from 1 on; only ratios of the sums matter.
    ``layout``: that of packed rows.
    """
    keys, holes = list(keys), [list(features).index(f) for f in missing]
    upper = np.triu_indices(1 + len(features) + len(holes))
    schema = _schema(rows, keys)
    names = schema.names
    flat = rows.select(*keys, F.col(target).cast("double").alias("_y"), F.col(coefficients).alias("_b"), *(layout.columns() if layout else [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = len(keys)
            if not batch.num_rows:
                continue
            order, edges, _ = grouped(batch, at)
            batch = batch.take(pa.array(order))
            y = batch.column(at).to_numpy(zero_copy_only=False)
            if layout:
                # sums over the horizons of each packed row meet what its horizons share
                fixed, many, begin = layout.parts(batch.columns[at + 2 :])
                bounds = np.array([*edges, batch.num_rows])
            else:
                x = inputs(batch.columns[at + 2 :], holes) if features else np.ones((batch.num_rows, 1))
                bounds = np.array([*edges, batch.num_rows])
            made = []
            for first, a, z in zip(edges.tolist(), bounds[:-1], bounds[1:], strict=True):
                b = np.asarray(batch.column(at + 1)[first].as_py())
                if layout:
                    made.append(_packed_sums(fixed[a:z], many[begin[a] : begin[z]], np.diff(begin[a : z + 1]), y[a:z], b, power, layout, upper))
                    continue
                part, seen = x[a:z], y[a:z]
                eta = np.clip(part @ b, -30.0, 30.0)
                mean = np.exp(eta)
                weight, z = mean ** (2 - power), eta + (seen - mean) / mean
                made.append((max(1, round(float(weight.sum()))), float(weight @ (z * z)), ((part.T * weight) @ part)[upper], part.T @ (weight * z)))
            first = pa.array(edges)
            arrays = [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.float64()), *(pa.array([m[i] for m in made], pa.list_(pa.float64())) for i in (2, 3))]
            yield pa.RecordBatch.from_arrays([*(c.take(first) for c in batch.columns[:at]), *arrays], names=names)

    return flat.mapInArrow(run, schema)


def _packed_sums(fixed: np.ndarray, many: np.ndarray, sizes: np.ndarray, y: np.ndarray, b: np.ndarray, power: float, layout, upper: tuple) -> tuple:
    """A block of ``reweighted`` of the packed rows of a group: inputs that horizons share, those of each horizon, and how many each row has."""
    of, n = np.repeat(np.arange(len(fixed)), sizes), len(fixed)
    moved = b[layout.moved]
    eta = np.clip((fixed @ moved[: layout.fixed])[of] + many @ moved[layout.fixed :], -30.0, 30.0)
    mean = np.exp(eta)
    weight, z = mean ** (2 - power), eta + (y[of] - mean) / mean
    heavy = many * weight[:, None]
    row = lambda v: np.bincount(of, v, n)
    cross = fixed.T @ np.column_stack([row(c) for c in heavy.T]) if many.shape[1] else np.zeros((layout.fixed, 0))
    xx = np.block([[(fixed.T * row(weight)) @ fixed, cross], [cross.T, heavy.T @ many]])
    xy = np.concatenate([fixed.T @ row(weight * z), heavy.T @ z])
    return max(1, round(float(weight.sum()))), float(weight @ (z * z)), xx[np.ix_(layout.order, layout.order)][upper], xy[layout.order]


def merged(parts: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """One block a group: the sum of its parts, array by array. A task makes few parts of a group, so few meet."""
    add = lambda c, w: F.aggregate(F.collect_list(c), F.array_repeat(F.lit(0.0), w), lambda s, v: F.zip_with(s, v, lambda a, b: a + b)).alias(c)
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("yy").alias("yy"), add("xx", size * (size + 1) // 2), add("xy", size))


def running(parts: DataFrame, by: Sequence[str], time: str, at: DataFrame) -> DataFrame:
    """Blocks of stretches of time (by, time) -> the block of all rows up to each moment of ``at`` (by, time), if there are any.

    Prefix sums in numpy; a group has a block or a few a moment, however many rows they are made of.
    """
    keys = list(by)
    asked = at.select(*keys, time, F.lit(True).alias("_asked")).distinct()
    both = parts.select(*keys, time, "n", "yy", "xx", "xy", F.lit(False).alias("_asked")).unionByName(asked, allowMissingColumns=True)
    schema = _schema(parts, [*keys, time])
    names = schema.names

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pa.compute.sort_indices(table, sort_keys=[(time, "ascending"), ("_asked", "ascending")]))
        wanted = table.column("_asked").to_numpy()
        n = np.cumsum(table.column("n").fill_null(0).to_numpy())
        pick = np.flatnonzero(wanted & (n > 0))
        real = np.flatnonzero(~wanted)
        place = np.cumsum(~wanted)[pick] - 1  # how many blocks lie before each moment
        sums = {}
        for c in ("xx", "xy"):
            flat = table.column(c).take(pa.array(real)).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            sums[c] = np.cumsum(flat.reshape(len(real), -1), axis=0)[place] if len(pick) else []
        yy = np.cumsum(table.column("yy").fill_null(0.0).to_numpy())
        kept = table.take(pa.array(pick))
        made = [pa.array(n[pick], pa.int64()), pa.array(yy[pick], pa.float64()), *(pa.array(list(sums[c]), pa.list_(pa.float64())) for c in ("xx", "xy"))]
        return pa.Table.from_arrays([*(kept.column(k) for k in [*keys, time]), *made], names=names)

    return both.groupBy(*keys).applyInArrow(run, schema)
