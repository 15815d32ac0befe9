"""quarry — record preparation and hybrid (BM25 + vector + RRF) search as Spark plans.

Layout
------
functions/   Column -> Column building blocks (text cleaning, number cleaning,
             tokenizers, vector distances, hashed-TF embedder)
operators/   DataFrame -> DataFrame operators (prepare, filters, kNN, IVF,
             full text, hybrid fusion, result comparison, roll-ups)
sources/     readers for the raw inputs and the collection tables
plans/       the reference scenarios composed from operators (what
             ``__spark_entry__.queries()`` registers)
streaming/   incremental ingest with Structured Streaming
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value inside Spark task closures.

    The ``mapInPandas`` / ``mapInArrow`` kernels and pandas UDFs live in this
    package; shipping them by value means executors' Python workers need no
    installed copy of the package (and no ``PYTHONPATH``) to run them.
    """
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark always ships it
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
