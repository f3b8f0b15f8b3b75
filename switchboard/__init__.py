"""switchboard: contact-centre warehouse analytics on Spark.

Entry points:

* ``Warehouse`` - resolves table names to DataFrames (fixtures bridge, a
  folder of tables, or a catalog) and calls query functions by their
  table-named parameters;
* ``views`` / ``layered`` / ``corrected`` - the warehouse queries;
* ``transforms`` / ``tables`` / ``streaming`` - layer transforms, table jobs
  and Structured Streaming jobs;
* ``build_session`` - a session with the library's defaults (tests, bench).
"""

from .operators import tables, transforms
from .plans import corrected, layered, views
from .session import build_session
from .sources.warehouse import Warehouse
from .streaming import jobs as streaming

__all__ = ["Warehouse", "build_session", "corrected", "layered", "streaming", "tables", "transforms", "views"]
