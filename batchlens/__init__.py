"""batchlens: ETL-metadata analytics as Spark DataFrame jobs.

Every job is a function from catalog DataFrames to a DataFrame. Nothing is
collected to the driver except small policy rows that choose target tables.
"""

from batchlens.session import as_of_literal, get_session, AS_OF_DEFAULT

__all__ = ["get_session", "as_of_literal", "AS_OF_DEFAULT"]
