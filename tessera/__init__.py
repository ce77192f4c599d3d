"""tessera: Spark-native analytics jobs.

Every public operator is a function ``DataFrame(s) -> DataFrame`` that works on
many groups at once (many menus, catalogs, graphs, pages or query sets) and leaves
physical planning to Catalyst and adaptive query execution.
"""

__version__ = "0.1.0"
