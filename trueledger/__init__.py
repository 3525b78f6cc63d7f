"""Finance-warehouse load, copy, fidelity checking and analytics as Spark jobs."""

__version__ = "0.1.0"
