"""Inputs shared by every query: labelled events, baseline / stream cut."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.inject import inject, scenario_plan, scenario_table
from ..schema import RunParams
from ..sources.events import load_events

RUN = RunParams()


def cut_literal(params: RunParams = RUN) -> str:
    o = datetime.strptime(params.origin, "%Y-%m-%d %H:%M:%S")
    return (o + timedelta(days=params.baseline_days)).strftime("%Y-%m-%d %H:%M:%S")


def scenarios(spark: SparkSession, params: RunParams = RUN) -> DataFrame:
    return scenario_table(spark, scenario_plan(params.origin))


def labelled_events(spark: SparkSession, sf_dir: str, params: RunParams = RUN) -> DataFrame:
    """Adapter view of the driver table with the default fault overlay."""
    return inject(load_events(spark, sf_dir), scenarios(spark, params))


def cut_col(params: RunParams = RUN):
    return F.lit(cut_literal(params)).cast("timestamp")


def baseline(events: DataFrame, params: RunParams = RUN) -> DataFrame:
    """P1 + P2: clean rows before the cut."""
    return events.where((F.col("ts") < cut_col(params)) & ~F.col("is_anomaly"))


def stream(events: DataFrame, params: RunParams = RUN) -> DataFrame:
    """Every row from the cut on."""
    return events.where(F.col("ts") >= cut_col(params))
