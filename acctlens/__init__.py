"""acctlens: customer and revenue analytics as lazy Spark plans.

Layers: ``sources`` (raw readers, driver-table adapters, sinks), ``functions``
(Column-level business rules), ``operators`` (ranking, data quality),
``plans`` (staging, core, marts, pipeline) and ``streaming``.
"""

__version__ = "0.1.0"
