"""twinline: parallel-text preparation and evaluation as Spark DataFrame jobs.

Subpackages: ``sources`` (tables, line files, stores), ``functions`` (Column
functions: normalise, pre-tokenise, encode, decode, arrays), ``operators``
(numbering, alignment, split, counts, vocabulary training, collation,
metrics, batch UDFs), ``plans`` (composite jobs and the oracle SQL),
``streaming`` (the stateless encode columns on a file stream).
"""

__version__ = "0.1.0"
