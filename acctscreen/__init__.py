"""acctscreen: Spark-native screening of savings-account transactions.

Public entry points:

* ``acctscreen.plans.pipeline.run_pipeline`` — the daily three-stage run;
* ``acctscreen.plans.pipeline.screen`` — the same as one lazy plan;
* ``acctscreen.operators.*`` — the individual DataFrame -> DataFrame steps;
* ``acctscreen.config.ScreenConfig`` — rule lists and column choices.
"""

__version__ = "0.1.0"
