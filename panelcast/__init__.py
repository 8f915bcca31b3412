"""panelcast: Spark-native surveillance-panel analytics.

Keyed panels (entity x region x period) built from raw periodic reports and
event threads, with lag / neighbourhood / "ever occurred" / covariate and
import-pressure features, deterministic splits, distributed model fits,
scoring and attribution queries.  Every operator takes plain DataFrames and
column names and stays lazy; nothing is collected except small, size-checked
statistics (model coefficients, scaling values).
"""

__version__ = "0.1.0"
