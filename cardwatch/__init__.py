"""cardwatch: a Spark-native card-warehouse loader and fraud reporter.

Daily snapshots and dated file feeds are staged, folded into type-2 history
(cards, accounts, clients, terminals), appended to facts, and turned into
three fraud reports.  Every step is a lazy DataFrame; the pipeline publishes
a run only after all of its outputs are written.
"""

__version__ = "0.1.0"
