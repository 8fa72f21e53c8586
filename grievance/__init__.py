"""Consumer-complaint ELT and data-quality engine on Spark DataFrames."""

__version__ = "0.1.0"
