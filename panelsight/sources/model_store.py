"""Fitted-model store (S6) and feature manifest (S7), with committed versions.

A bundle is a folder ``path`` with ``versions/<id>/`` (the model in Spark's
saved form, the encoder's table, and last of all the manifest: model kind,
classes seen in training, preparation statistics, ordered feature names) and
one-line files ``commits/<number>``, the last of which names the version to
read. A save writes a version and a commit aside, and then gives the commit
its number by one rename to a name that is not taken: readers see the version
before or the new one, whole, and a save that dies leaves the one before. All
files go through Spark's file systems, so a bundle lives where the data live.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

from panelsight.operators.models import BoostedTreesModel, FittedModel
from panelsight.operators.prep import PrepStats

KEEP = 2  # versions that stay: the current one and one that a reader may still hold


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _qualified(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def _commits(spark: SparkSession, path: str) -> list[str]:
    """Names of the commits of the bundle at ``path``, the last one last."""
    fs, p = _fs(spark, f"{path}/commits")
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.isdigit())


def point(spark: SparkSession, path: str, version: str) -> str:
    """Let the bundle (or alias) at ``path`` be the version folder ``version`` from now on."""
    path = path.rstrip("/")
    aside = f"{path}/aside/{uuid.uuid4().hex}"
    _write_text(spark, aside, _qualified(spark, version))
    fs, source = _fs(spark, aside)
    fs.mkdirs(_fs(spark, f"{path}/commits")[1])
    while True:
        before = _commits(spark, path)
        number = max(time.time_ns(), int(before[-1]) + 1 if before else 0)
        target = _fs(spark, f"{path}/commits/{number:020d}")[1]
        if not fs.exists(target) and fs.rename(source, target):
            break
    for old in before[:-1]:  # the one before stays: a reader may have listed it
        fs.delete(_fs(spark, f"{path}/commits/{old}")[1], False)
    return path


def current(spark: SparkSession, path: str) -> str:
    """The folder of the version that the bundle's readers get."""
    path = path.rstrip("/")
    commits = _commits(spark, path)
    if not commits:
        raise FileNotFoundError(f"{path} holds no committed model bundle")
    return _read_text(spark, f"{path}/commits/{commits[-1]}").strip()


def _save_version(spark: SparkSession, fm: FittedModel, stats: PrepStats, folder: str) -> None:
    if isinstance(fm.model, BoostedTreesModel):
        fm.model.save(f"{folder}/model")
    else:
        fm.model.write().overwrite().save(f"{folder}/model")
    stats.encoder.write.mode("overwrite").parquet(f"{folder}/encoder")
    meta = {"name": fm.name, "classes": fm.classes, "stats": json.loads(stats.to_json()), "features": stats.features, "kind": type(fm.model).__name__}
    _write_text(spark, f"{folder}/manifest.json", json.dumps(meta, sort_keys=True))


def save_bundle(spark: SparkSession, fm: FittedModel, stats: PrepStats, path: str, keep: int = KEEP) -> str:
    """A new version of the bundle at ``path``, committed when it is whole; versions but the last ``keep`` go."""
    path = path.rstrip("/")
    folder = f"{path}/versions/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    _save_version(spark, fm, stats, folder)
    point(spark, path, folder)
    fs, p = _fs(spark, f"{path}/versions")
    names = sorted(s.getPath().toString() for s in fs.listStatus(p))
    now = current(spark, path)
    whole = [n for n in names if _fs(spark, f"{n}/manifest.json")[0].exists(_fs(spark, f"{n}/manifest.json")[1])]
    # unfinished versions stay: they may be saves under way
    for old in [n for n in whole if n != now and n < now][: max(0, len(whole) - keep)]:
        fs.delete(_fs(spark, old)[1], True)
    return path


def _at_current(spark: SparkSession, path: str, read):
    """``read(version folder)``; once more if that version went in the meantime."""
    version = current(spark, path)
    try:
        return read(version)
    except Exception:
        following = current(spark, path)
        if following == version:
            raise
        return read(following)


def read_meta(spark: SparkSession, path: str) -> dict:
    return _at_current(spark, path, lambda v: json.loads(_read_text(spark, f"{v}/manifest.json")))


def load_bundle(spark: SparkSession, path: str) -> tuple[FittedModel, PrepStats]:
    from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
    kinds = {"LogisticRegressionModel": LogisticRegressionModel, "RandomForestClassificationModel": RandomForestClassificationModel}

    def read(version: str):
        meta = json.loads(_read_text(spark, f"{version}/manifest.json"))
        if meta["kind"] == "BoostedTreesModel":
            model = BoostedTreesModel.load(f"{version}/model", len(meta["classes"]))
        else:
            model = kinds[meta["kind"]].load(f"{version}/model")
        encoder = spark.read.parquet(f"{version}/encoder")
        return FittedModel(meta["name"], model, meta["classes"]), PrepStats(**meta["stats"], encoder=encoder)

    return _at_current(spark, path, read)


def feature_manifest(spark: SparkSession, path: str) -> list[str]:
    """The ordered feature names stored with the bundle."""
    return read_meta(spark, path)["features"]
