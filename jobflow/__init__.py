"""jobflow: labour-movement analytics as Spark DataFrame operators.

Every operator is a plain function: DataFrame in, DataFrame out, column
names as keyword arguments, no action inside unless the operator's job is
to write or to read back files.  Sub-packages:

* ``sources``   - readers, writers, file catalogue, the driver-table fixture
* ``functions`` - column expressions (cleaning, names, code sets, dates)
* ``operators`` - filters, joins, aggregates, windows, quality checks
* ``plans``     - composed jobs and the query registry used by the driver
* ``streaming`` - incremental pick-up and retroactive balance updates

Typical use::

    from jobflow.session import get_spark
    from jobflow.operators import balance, filters, quality
    from jobflow.sources.files import read_period
    spark = get_spark()
    mov = read_period(spark, root, [(2024, 1), (2024, 2)])           # partition-pruned scan, all types
    mov = filters.FilterChain().movement(types=[10, 31]).apply(mov)  # predicates pushed into the scan
    series = balance.balance_series(mov)                             # balance + running stock
    report = quality.QualityReport(mov, [quality.period_format("competencia_mov")]).run()

``docs/OPERATORS.md`` maps every operator of the blueprint to its function.
"""

__version__ = "0.1.0"
