"""Audit-data ingest and export on Spark."""

import copyreg
import functools
import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so that executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _sent(cached):
    """Cached functions of this package travel as functions, with a cache of their own; others by name."""
    if (cached.__module__ or "").split(".")[0] != __name__:
        return cached.__qualname__
    return _cached, (cached.__wrapped__, cached.cache_parameters()["maxsize"])


def _cached(function, maxsize):
    return functools.lru_cache(maxsize)(function)


copyreg.pickle(functools._lru_cache_wrapper, _sent)

from .operators.infer import infer_types  # noqa: E402
from .operators.report import ImportResult  # noqa: E402
from .sinks.export import export_table  # noqa: E402
from .sources.archive import import_archives  # noqa: E402
from .sources.audit import (  # noqa: E402
    import_datev_export,
    import_export,
    import_export_layout,
    import_index,
)
from .sources.booking import read_booking_batches  # noqa: E402
from .sources.folder import import_folder  # noqa: E402
from .sources.index_catalog import IndexLayout, index_catalog  # noqa: E402

__all__ = [
    "ImportResult",
    "IndexLayout",
    "export_table",
    "import_archives",
    "import_datev_export",
    "import_export",
    "import_export_layout",
    "import_folder",
    "import_index",
    "index_catalog",
    "infer_types",
    "read_booking_batches",
]
