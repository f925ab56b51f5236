"""Operators for preparing training data: DataFrame in, DataFrame out.

Common rules, which each module's docstring may narrow:

* Operators read the columns they name and ignore others, unless they carry them on;
  a carried column that has the name of a result column gives way to the result.
* Null texts count as empty. Empty tables give empty results with the full schema.
* Repeated rows are rows: each gets its result, unless an operator removes duplicates.
* Intermediate tables lie below ``spark.checkpoint.dir``, which all executors share.
"""
