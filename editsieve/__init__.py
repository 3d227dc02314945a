"""Spark-native edit-quality analytics.

Every public function takes and returns DataFrames. The names below are the entry points of the
jobs: collect samples, build shards, compute features, train, evaluate, score.
"""

from .functions.tokens import top_tokens
from .operators.enrich import enrich_features
from .operators.enrich import enrich_features as enrich_dataframe
from .operators.shards import build_shard
from .operators.shards import build_shard as collect_shard
from .plans.scoring import Predictor, load_predictor
from .plans.training import evaluate_saved_model, threshold_report, train_and_export
from .sources.readers import collect_training_samples, to_dataframe

__all__ = [
    "Predictor", "build_shard", "collect_shard", "collect_training_samples", "enrich_dataframe", "enrich_features",
    "evaluate_saved_model", "load_predictor", "threshold_report", "to_dataframe", "top_tokens", "train_and_export",
]
