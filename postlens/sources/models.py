"""One format for fitted models of every kind: MLlib's, and the library's own, which are
dataclasses, tuples, lists and dicts of tables, arrays, numbers and MLlib models.

``save_model(model, path)`` writes the parts into a folder of a new version and then
appends one row to ``path/manifest``; that row is the commit.  A save that dies before
it leaves the former version in force, and readers of that version are not disturbed.
Tables stay tables: a vocabulary-sized model passes through no single machine."""

from __future__ import annotations

import dataclasses
import importlib
import json
import uuid

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "seq long, version string, spec string"
ARRAYS = "key int, dtype string, shape array<int>, data array<double>"
PACKAGE = __name__.split(".")[0]


def _encode(x, parts: dict):
    """A JSON value; tables, arrays and MLlib models go to ``parts`` and are named."""
    if isinstance(x, DataFrame):
        parts["tables"].append(x)
        return {"table": len(parts["tables"]) - 1}
    if isinstance(x, np.ndarray):
        if x.dtype.kind not in "fiub":
            raise TypeError(f"cannot save an array of {x.dtype}")
        if x.dtype.kind in "iu" and x.size and int(np.abs(x).max()) > 1 << 53:
            raise TypeError("cannot save whole numbers over 2^53 in an array")
        parts["arrays"].append(x)
        return {"array": len(parts["arrays"]) - 1}
    if isinstance(x, np.generic):
        return _encode(x.item(), parts)
    if x is None or isinstance(x, (bool, int, float, str)):
        return x
    if isinstance(x, (list, tuple)):
        return {type(x).__name__: [_encode(v, parts) for v in x]}
    if isinstance(x, dict):
        return {"dict": [[_encode(k, parts), _encode(v, parts)] for k, v in x.items()]}
    if dataclasses.is_dataclass(x):
        fields = {f.name: _encode(getattr(x, f.name), parts) for f in dataclasses.fields(x)}
        return {"class": f"{type(x).__module__}:{type(x).__qualname__}", "fields": fields}
    if hasattr(x, "write"):
        parts["mllib"].append(x)
        return {"mllib": len(parts["mllib"]) - 1}
    raise TypeError(f"cannot save a {type(x).__name__}")


def _decode(x, part):
    if not isinstance(x, dict):
        return x
    if "list" in x or "tuple" in x:
        return [_decode(v, part) for v in x["list"]] if "list" in x else tuple(_decode(v, part) for v in x["tuple"])
    if "dict" in x:
        return {_decode(k, part): _decode(v, part) for k, v in x["dict"]}
    if "class" in x:
        module, name = x["class"].split(":")
        if module.split(".")[0] != PACKAGE:
            raise ValueError(f"{x['class']} is not a model of this library")
        return getattr(importlib.import_module(module), name)(**{k: _decode(v, part) for k, v in x["fields"].items()})
    (kind, n), = x.items()
    return part(kind, n)


def _versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _last(spark: SparkSession, path: str) -> int:
    try:
        return _versions(spark, path).agg(F.max("seq")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def save_model(spark: SparkSession, model, path: str) -> str:
    """Write ``model`` as the newest version under ``path``; returns the version."""
    version = uuid.uuid4().hex
    home = f"{path}/{version}"
    parts = {"tables": [], "arrays": [], "mllib": []}
    spec = json.dumps(_encode(model, parts))
    for i, t in enumerate(parts["tables"]):
        t.write.parquet(f"{home}/table-{i}")
    for i, m in enumerate(parts["mllib"]):
        m.write().save(f"{home}/mllib-{i}")
    if parts["arrays"]:
        rows = [(i, str(a.dtype), list(a.shape), a.astype(float).ravel().tolist()) for i, a in enumerate(parts["arrays"])]
        spark.createDataFrame(rows, ARRAYS).write.parquet(f"{home}/arrays")
    spark.createDataFrame([(_last(spark, path) + 1, version, spec)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def load_model(spark: SparkSession, path: str, version: str | None = None):
    """The newest version under ``path``, or the one named."""
    v = _versions(spark, path)
    row = (v.filter(F.col("version") == version) if version else v.orderBy(F.desc("seq"), F.desc("version"))).first()
    if row is None:
        raise ValueError(f"no version {version or ''} of a model under {path}")
    home = f"{path}/{row.version}"
    arrays = {}
    if '{"array":' in row.spec:
        arrays = {r.key: np.array(r["data"]).reshape(r["shape"]).astype(r["dtype"]) for r in spark.read.schema(ARRAYS).parquet(f"{home}/arrays").collect()}

    def part(kind: str, n: int):
        if kind == "table":
            return spark.read.parquet(f"{home}/table-{n}")
        return arrays[n] if kind == "array" else DefaultParamsReader.loadParamsInstance(f"{home}/mllib-{n}", spark)

    return _decode(json.loads(row.spec), part)
