"""mercadia — marketplace analytics on Spark.

Staging, intermediate and mart models, four analytical reports, dashboard
datasets with their chart queries, reusable window/grouping operators and
data-quality checks, all expressed with the DataFrame API so Catalyst and
adaptive execution choose the physical plan.
"""

__version__ = "0.1.0"
