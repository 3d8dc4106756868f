"""linepulse: factory OEE analytics as Spark DataFrame operators.

Every public operator is a pure ``DataFrame -> DataFrame`` function; nothing
collects data to the driver.  See README.md for the operator map.

Common entry points::

    from linepulse import from_folder, run_report, today_report, register_views
"""

__version__ = "0.1.0"

from linepulse.plans.plant import Plant, from_folder, from_testdata  # noqa: E402
from linepulse.plans.report import run_report, store_report_tables, today_report  # noqa: E402
from linepulse.plans.views import register_views  # noqa: E402

__all__ = ["Plant", "from_folder", "from_testdata", "register_views", "run_report",
           "store_report_tables", "today_report"]
