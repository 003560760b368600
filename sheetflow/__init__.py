"""Table enrichment and reconciliation as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

from sheetflow.session import build_session, settle, work_dir

# Python tasks carry their small helpers with them, so executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "settle", "work_dir"]
