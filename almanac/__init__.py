"""almanac: a Spark-native engine for long-form observation data.

Landed source files are normalised into one observation contract, resolved
against reference dimensions, validated, corrected, stored in a fact table
with upsert / soft delete / undelete, and served as a joined view.
"""

__version__ = "0.1.0"
