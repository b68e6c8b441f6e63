"""bandwise: binary-event risk modelling and exploratory statistics on Spark.

Everything is expressed as DataFrame / SQL operations. Python code only
touches aggregated tables whose size is bounded by a parameter (number of
bins, number of columns, number of levels kept after rare-level folding) or
Arrow batches inside Spark tasks.

Main entry points::

    from bandwise import score_performance, ks_gini_summary, univariate, Scorecard, ModelSelection
"""

from bandwise.session import checkpoint_dir, get_spark
from bandwise.operators.evaluate import ks_gini_summary, ks_gini_table, score_performance, variable_trend
from bandwise.operators.profile import univariate
from bandwise.operators.quantiles import exact_quantiles, value_ranks
from bandwise.operators.split import sample_n, train_test_split
from bandwise.plans.model_selection import ModelSelection, model_apply
from bandwise.plans.scorecard_flow import Scorecard

__all__ = ["get_spark", "checkpoint_dir", "score_performance", "ks_gini_table", "ks_gini_summary",
           "variable_trend", "univariate", "exact_quantiles", "value_ranks", "sample_n", "train_test_split",
           "ModelSelection", "model_apply", "Scorecard"]
__version__ = "0.1.0"
