"""catchframe: Spark table operators for catch statistics and stock-assessment tables.

Every operator is a pure, lazy ``DataFrame -> DataFrame`` function.  Leading
``keys`` columns (``stock``, ``year``, ...) let one job cover many stocks.
"""

from catchframe.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
__version__ = "0.1.0"
