"""opticart: retail analytics for customisable glasses, written as Spark jobs.

Every data product is a function from conformed DataFrames to a DataFrame.
Plans are declared with the DataFrame API and left to Catalyst and AQE;
see README.md for the scale notes of each operator.
"""

from opticart.params import Params
from opticart.sources.conform import Tables

__all__ = ["Params", "Tables"]
