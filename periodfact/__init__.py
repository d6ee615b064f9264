"""periodfact: period-fact building and modelling on Spark DataFrames.

Messy delimited sources are reduced to one row per period, wide result
files with repeated column blocks are turned into long form, tallied
through first-match lookups into a fixed list of categories with shares
and a winner, joined on the period into one fact table, and modelled with
``pyspark.ml``.  Every operator takes and returns a lazy DataFrame.
"""

from periodfact.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
