"""Monthly incident analytics as Spark jobs: load, clean, aggregate, check and report."""

__version__ = "0.1.0"
