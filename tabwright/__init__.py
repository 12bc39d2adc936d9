"""Tabular classification on Spark: every step is a small fit plus a lazy projection."""

from tabwright.spec import PipelineSpec

__all__ = ["PipelineSpec"]
