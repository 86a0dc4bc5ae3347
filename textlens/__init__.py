"""textlens: text retrieval on Spark.

Raw pages -> clean documents -> TF-IDF weights and a positional index ->
ranked top-k search for whole query tables, spelling correction by edit
distance, and word-vector / nearest-neighbour search.  Every operator takes
and returns DataFrames; nothing is collected to the driver.
"""

from textlens.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
