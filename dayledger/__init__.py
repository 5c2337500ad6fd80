"""Trustworthy daily creative metrics from unreliable file deliveries, on Spark.

Layers, each DataFrame in / DataFrame out:

* ``sources``    drop files, header layouts, the stored tables
* ``operators``  deduplication, metrics and ranking, defects, checks
* ``functions``  column expressions shared by the operators
* ``plans``      refreshes that read and write the stored tables
* ``streaming``  the same refresh, driven by file arrival
"""

from dayledger.config import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
