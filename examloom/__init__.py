"""examloom: Spark jobs for exam-question datasets and model comparison.

Every public function takes and returns DataFrames or Columns.
"""
