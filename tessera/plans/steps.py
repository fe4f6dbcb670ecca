"""A pipeline of named steps on a voxel frame, and parameters merged from defaults, file and command line."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import chunks, kernels, volume
from tessera.session import materialize
from tessera.sources import volumes

def _relabelled(v: DataFrame, lut: DataFrame, column: str) -> DataFrame:
    from tessera.operators.relabel import relabel

    return relabel(v, lut, column)


STEPS: dict[str, Callable[..., DataFrame]] = {
    "threshold": lambda v, least: volume.to_zero(v, least),
    "clamp": lambda v, low: volume.clamped(v, low),
    "erode": lambda v, axes="z", steps=1: volume.eroded_min(v, axes, steps),
    "affinities": lambda v, with_z=True: volume.probability_affinities(v, with_z),
    "grow_boundary": lambda v, steps=1, axes="zyx": volume.boundary_grown(v, steps, axes),
    "downsample": lambda v, factor: volume.downsampled_mean(v, tuple(factor)),
    "pool": lambda v, k, how: volume.pooled(v, k, how),
    "mask": lambda v, mask, how="multiply", constant=0: volume.masked(v, mask, how, constant),
    "rescale": lambda v, scale, shift, low=0, high=255: volume.rescaled(v, scale, shift, low, high),
    "clean": lambda v, labels, steps=1, keep_inside=False: volume.cleaned(v, labels, steps, keep_inside),
    "smooth": lambda v, block, sigma: kernels.gaussian(v, tuple(block), tuple(sigma)),
    "fragments": lambda v, block, least, context=0: kernels.watershed(v, tuple(block), least, context=context),
    "segment": lambda v, least, shape: volume.labelled(v.filter(F.col("value") >= least), tuple(shape)),
    "relabel": lambda v, lut, column="value": _relabelled(v, lut, column),
    "chunks": lambda v, size, dtype="uint8": volumes.chunks_of(v, tuple(size), dtype),
    "voxels": lambda v, keep_zero=False: volumes.voxels_of(v, keep_zero),
    "chunk_erode": lambda v, axes="z", steps=1: chunks.eroded_min(v, axes, steps),
    "chunk_grow": lambda v, steps=1, axes="zyx": chunks.boundary_grown(v, steps, axes),
    "save": lambda v, name: materialize(v, f"step-{name}"),
    "sections": lambda v, replace, delete=(): volume.sections_replaced(v, {int(a): b for a, b in replace.items()}, list(delete)),
}


def run(v: DataFrame, program: list[tuple[str, dict]], steps: dict[str, Callable] | None = None) -> DataFrame:
    """Apply (name, arguments) steps in order; an unknown name is an error."""
    known = STEPS | (steps or {})
    for name, arguments in program:
        v = v.transform(lambda df, f=known[name], a=arguments: f(df, **a))
    return v


def load_config(text: str) -> dict:
    """JSON with // and # line comments outside of strings."""
    out = []
    for line in text.splitlines():
        out.append(re.sub(r"""("(?:\\.|[^"\\])*")|(//|#).*$""", lambda m: m[1] or "", line))
    return json.loads("\n".join(out) or "{}")


def merged(*levels: dict) -> dict:
    """Later levels win, mapping by mapping."""
    result: dict = {}
    for level in levels:
        for key, value in level.items():
            result[key] = merged(result[key], value) if isinstance(value, dict) and isinstance(result.get(key), dict) else value
    return result


def overrides(arguments: list[str]) -> dict:
    """``Task.parameter=value`` arguments; a value is JSON if it reads as such, else text."""
    found: dict = {}
    for argument in arguments:
        path, _, raw = argument.partition("=")
        task, _, parameter = path.partition(".")
        try:
            value = json.loads(raw)
        except ValueError:
            value = raw
        found.setdefault(task, {})[parameter] = value
    return found


def formatted(config, values: dict):
    """Texts of a configuration with their {names} filled in; unknown names and other braces stay."""
    if isinstance(config, dict):
        return {k: formatted(v, values) for k, v in config.items()}
    if isinstance(config, list):
        return [formatted(v, values) for v in config]
    return re.sub(r"\{(\w+)\}", lambda m: str(values.get(m[1], m[0])), config) if isinstance(config, str) else config


def checkpoints(spark, folder: str, pattern: str, first: int, last: int, parameters: DataFrame | None = None) -> DataFrame:
    """(path, iteration) of the files whose name matches, iteration (the pattern's first group) from first to last, for each row of parameters."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    found = files.withColumn("iteration", F.regexp_extract("path", pattern, 1).cast("bigint")).filter(F.col("iteration").between(first, last))
    return found if parameters is None else found.crossJoin(F.broadcast(parameters))


def config_hash(config: dict) -> str:
    return hashlib.md5(json.dumps(config, sort_keys=True).encode()).hexdigest()
