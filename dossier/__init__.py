"""dossier: document screening on Spark DataFrames.

Sectioning, exact and edit-distance keyword matching, ranking, entry and
skill extraction, column obfuscation and application manifests, all as
DataFrame operations.
"""

__version__ = "0.1.0"
