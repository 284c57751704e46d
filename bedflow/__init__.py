"""bedflow: hospital bed-demand analytics as lazy Spark DataFrame plans.

Public entry points live in ``bedflow.plans`` (models) and
``bedflow.operators`` (the building blocks they compose).
"""

from bedflow.config import Params

__all__ = ["Params"]
__version__ = "0.1.0"
