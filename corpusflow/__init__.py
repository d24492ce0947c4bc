"""corpusflow: speech/text corpus curation as Spark DataFrame operators."""

import sys as _sys

try:  # ship the package's Python helpers to executors inside the pickled UDFs
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
