"""vaultmart: a Spark-native data vault and mart engine for property sales.

Layers, all plain DataFrame functions:

* ``sources``   - derived property feed, CSV and JDBC connectors, layer storage
* ``functions`` - column expressions: hash keys, hashdiffs, exact rounding
* ``operators`` - data vault loaders, exact distributed median, quality tests
* ``plans``     - staging, marts, dashboard queries and the batch pipeline
* ``streaming`` - micro-batch adapter that feeds the same loaders
"""

from vaultmart.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
