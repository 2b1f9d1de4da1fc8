"""riskloom: tabular risk prediction as Spark jobs.

Operators are plain ``DataFrame -> DataFrame`` functions (usable with
``df.transform``); steps that learn something from data are small objects with
``fit`` and ``transform``, where ``fit`` keeps a bounded number of statistics.
"""

__version__ = "0.1.0"
