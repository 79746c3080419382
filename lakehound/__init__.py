"""lakehound: operational-ML analytics as Spark DataFrame jobs.

Change events become warehouse tables, tables become features, features become
MLlib models and scores, and the monitoring panels are DataFrame queries on top.
Everything runs on executors; the driver only plans.
"""

__version__ = "0.1.0"
