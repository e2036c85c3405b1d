"""panelmart: entity x period panel warehouse on Spark DataFrames.

Layers (all lazy DataFrames; no Python UDFs):

* ``sources``   - CSV / Parquet / JDBC / GeoJSON readers and sinks, plus the
                  raw sources derived from the TPC-H-style test tables;
* ``functions`` - shared Column builders (IEEE division, code normalising,
                  NaN -> NULL, label maps, rounding);
* ``operators`` - staging, checks, panel assembly + donor imputation,
                  exact quantile bins, features, centroids, star schema,
                  reports;
* ``plans``     - the batch job (``pipeline.run``), the named query catalog
                  and its SQL oracle;
* ``streaming`` - empty on purpose (batch-only workload).
"""

from panelmart.config import PanelConfig  # noqa: F401
