"""sondar: keyed relational data on PySpark -- integrity, profiling, comparison, synthesis and similarity.

Everything is a DataFrame plan; the driver holds catalogues, plans and bounded statistics only.
"""

__version__ = "0.1.0"
