"""claimtide: snapshot-history analytics for operational claims on Spark."""

__version__ = "0.1.0"
