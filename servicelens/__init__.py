"""servicelens: service-history analytics as Spark DataFrame jobs.

Every operator takes canonical DataFrames (``lines``, ``assets``) plus a
frozen :class:`~servicelens.params.Params` object and returns a lazy
DataFrame.  Nothing is collected to the driver except scalar model metrics.
"""

from servicelens.params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
