"""fipsight: county-level exposure/outcome analytics as plain Spark DataFrame functions.

Every public function takes DataFrames (and column names / parameters) and returns a
DataFrame; nothing creates or stops a SparkSession. Sub-packages:

* ``functions`` – column expressions (keys, safe casts, clocks, dates, statistical tails)
* ``sources``   – readers and writers (CSV with per-file headers, tuple text, JSON flattening,
                  yearly file merge, partitioned sinks)
* ``operators`` – relational / statistical operators (rollups, joins, windows, moments,
                  regression, PCA, KNN, feature selection)
* ``plans``     – the end-to-end chains and the bindings of every query to the test tables
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value when Spark sends them to Python workers, so
    executors need not have the package installed or on their path (pandas UDFs defined here
    then work from any driver working directory)."""
    try:
        import sys

        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle: executors need the package
        pass


_ship_by_value()
