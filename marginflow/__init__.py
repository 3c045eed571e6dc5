"""marginflow: commerce analytics (profitability marts, cohort economics, experiment
inference, metric layer, data-quality checks) written as Spark DataFrame plans.

Every public function takes DataFrames (or a session and a data directory) and returns a
lazy DataFrame; no function runs an action on the data it is given.
"""

__all__ = ["session", "schemas", "sources", "functions", "operators", "plans"]
