"""threadlens: customer-support conversation analytics on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame.  Message-level
operators expect the message columns described in ``threadlens.sources.schemas``.
"""

from threadlens.params import Params

__all__ = ["Params"]
