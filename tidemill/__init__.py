"""Unified stream and batch analytics, written as plain PySpark DataFrame code.

Every public function takes and returns DataFrames (or Columns), so the same
transform runs in a batch job, inside ``foreachBatch`` and in a test.
"""
