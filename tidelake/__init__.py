"""tidelake: bronze / silver / gold sales lake jobs written for Spark.

Every table operator is a ``DataFrame -> DataFrame`` function made of built-in
Spark expressions.  ``plans`` composes them into the jobs a user runs.
"""

from tidelake.specs import KPIS, SALES, KpiSpec, TableSpec

__all__ = ["KPIS", "SALES", "KpiSpec", "TableSpec"]
