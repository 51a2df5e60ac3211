"""Fitted models kept in a folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
