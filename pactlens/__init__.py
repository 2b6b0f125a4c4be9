"""Contract-anomaly analytics expressed as Spark DataFrame plans."""

from pactlens.config import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
__version__ = "0.1.0"
