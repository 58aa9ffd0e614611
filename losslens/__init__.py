"""losslens: returns-economics analytics expressed as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame`` (lazy) built from
DataFrame / SQL expressions and Spark ML.  Actions happen only at sinks,
at scalar statistics needed to build a plan (quantile splits, feature
lists) and at model fits.
"""

__version__ = "0.1.0"
