"""Label large tables with ordered rules and report on the result, on Spark.

Every operator is a function from DataFrame to DataFrame (usable with
``df.transform``); the caller owns the SparkSession.
"""

from tallyrule.functions import *  # noqa: F401,F403
from tallyrule.operators import *  # noqa: F401,F403
from tallyrule.sources import *  # noqa: F401,F403

__version__ = "0.1.0"
