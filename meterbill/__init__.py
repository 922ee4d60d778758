"""meterbill: utility-billing reports as Spark DataFrame plans.

Subpackages: ``functions`` (predicates, text building, rule sets), ``operators``
(periods, readings, attributes, intervals, snapshots), ``sources`` (JDBC,
shards, sinks, charset, shared-folder intermediates, test stand-ins),
``plans`` (monthly statistics, meter extract, shard consolidation) and
``streaming`` (the once-per-period run ledger).
"""

__version__ = "0.1.0"
