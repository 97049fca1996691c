"""The four stages, composed from the operators."""

from grantweave.plans.config import DEFAULT_CONFIG, StageConfig
from grantweave.plans.stages import keywords, metrics, mlexport, preprocess

__all__ = ["DEFAULT_CONFIG", "StageConfig", "keywords", "metrics", "mlexport", "preprocess"]
