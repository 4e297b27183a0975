"""trackloom: batch annotation of media catalogues as Spark DataFrame jobs.

Every public function takes DataFrames (or Columns) and returns a DataFrame
(or a Column). Nothing collects row data on the driver; the few eager steps
(a bounded hot-key list, a checkpoint) say so in their docstring.
"""
