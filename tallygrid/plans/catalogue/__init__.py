"""The metric catalogue: every business metric by name.

``operational(period)`` and its siblings return ``name -> Metric``. A metric
name that exists with several formulas carries ``(variant n)``.
"""

from tallygrid.plans.catalogue.contracts import contracts
from tallygrid.plans.catalogue.older import operational_old
from tallygrid.plans.catalogue.operations import operational
from tallygrid.plans.catalogue.sprint import sprint

__all__ = ["contracts", "operational", "operational_old", "sprint"]
