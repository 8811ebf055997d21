"""brisa: review-text and wind-power analytics as Spark DataFrame jobs.

Every public function takes and returns DataFrames; nothing is pulled to
the driver. Sub-packages:

* ``sources``   - readers, writers, time-window scans, run log, model store
* ``functions`` - column expressions (text predicates, compass, stamps)
* ``operators`` - relational helpers, time series, nearest neighbours, scoring
* ``plans``     - named end-to-end analyses and the query catalog
* ``streaming`` - incremental scoring of newly landed forecast files
"""

from brisa.session import checkpoint_dir, get_session, scratch_path

__all__ = ["checkpoint_dir", "get_session", "scratch_path"]
