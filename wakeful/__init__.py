"""wakeful: alertness-risk analytics over wearable telemetry, built on Spark.

Every operator is a function ``DataFrame(s) + parameters -> DataFrame``; nothing
is collected to the driver except small fitted parameters (a handful of doubles
per feature) and model structures whose size is fixed by their hyper-parameters.
"""

from wakeful.settings import FeatureSettings, DEFAULTS, EVENTS_SCALE  # noqa: F401

__all__ = ["FeatureSettings", "DEFAULTS", "EVENTS_SCALE"]
