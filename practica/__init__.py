"""practica: a Spark-native star-schema engine for professional-services analytics.

Layers (each a plain function from DataFrames to a DataFrame):

* ``sources``   typed source tables and the adapter from the driver test tables
* ``operators`` staging, calendar, SCD2 history, dimensions, measures,
                incremental merge, data-quality checks
* ``functions`` Column-level helpers (surrogate keys, month arithmetic)
* ``plans``     the four fact builders and the end-to-end build order
* ``oracle``    DuckDB SQL twins used by the correctness gate
"""

from practica.semantics import Semantics

__all__ = ["Semantics"]
