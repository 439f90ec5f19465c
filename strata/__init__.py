"""strata — layered (Bronze / Silver / Gold) order analytics on Spark DataFrames.

Every layer is a pure ``DataFrame -> DataFrame`` function built from built-in
Spark expressions, so Catalyst sees one declarative plan per layer: filters and
projections reach the scan, aggregates run partial-then-final, and nothing is
routed through the driver or a Python worker.
"""

from strata.operators.bronze import bronze
from strata.operators.gold import gold, summarise
from strata.operators.quality import rejects, reject_reason, with_reject_reason
from strata.operators.silver import silver
from strata.plans.pipeline import PipelineResult, run_pipeline
from strata.streaming.medallion import run_incremental

__all__ = [
    "bronze",
    "gold",
    "rejects",
    "reject_reason",
    "run_incremental",
    "run_pipeline",
    "PipelineResult",
    "silver",
    "summarise",
    "with_reject_reason",
]
