"""Monthly price series per area from sale, listing and provider feeds, on Spark."""

__version__ = "0.1.0"
