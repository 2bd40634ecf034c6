"""Model versions that running jobs follow.

Below one folder lie `version=n`, the saved models, `claimed/n`, which gives a number to one writer only, and
`published/n`, an empty file that appears once the model is whole. Readers take the highest published number. Each step
is the creation of one file, so a reader sees the old model or the new one and never a part of it, and two refits at a
time get different numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError

from heliograph import session
from heliograph.operators import training, trees

Model = PipelineModel | trees.Ensemble


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    located, files = session.file_system(spark, folder)
    if not files.exists(located):
        return []
    return sorted(int(e.getPath().getName()) for e in files.listStatus(located) if e.getPath().getName().isdigit())


def _create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    located, files = session.file_system(spark, path)
    try:
        files.create(located, False).close()
    except (Py4JJavaError, CapturedException):
        if files.exists(located):
            return False
        raise
    return True


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    return _numbers(spark, f"{root}/published")


def publish(spark: SparkSession, model: PipelineModel, root: str, keep: int = 5) -> int:
    """Save a model as the next version and let readers have it; the newest `keep` stay."""
    number = max([0, *_numbers(spark, f"{root}/claimed")]) + 1
    while not _create(spark, f"{root}/claimed/{number}"):
        number += 1
    training.save(model, root, number)
    _create(spark, f"{root}/published/{number}")
    for old in versions(spark, root)[: -max(keep, 1)]:
        session.remove(spark, f"{root}/published/{old}")
        session.remove(spark, f"{root}/version={old}")
    return number


def current(spark: SparkSession, root: str) -> tuple[int, PipelineModel] | None:
    """Number and model of the newest version, or None before the first."""
    found = versions(spark, root)
    return (found[-1], training.load(f"{root}/version={found[-1]}")) if found else None


def follow(spark: SparkSession, root: str, otherwise: Model | None = None) -> Callable[[], Model]:
    """What `jobs.start_tilt_control` asks for its model: the newest version at each micro-batch.

    A model is read again only when there is a newer one. Before the first it is `otherwise`, by default the starting
    model of `training`.
    """
    start = training.starting_model() if otherwise is None else otherwise
    held: dict[int, Model] = {0: start}

    def newest() -> Model:
        number = max([0, *versions(spark, root)])
        if number not in held:
            model = training.load(f"{root}/version={number}")
            held.clear()
            held[number] = model
        return held[number]

    return newest
