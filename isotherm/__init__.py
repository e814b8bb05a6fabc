"""isotherm: station-climate analytics as Spark DataFrame operators."""

from isotherm.config import ClimateConfig

__all__ = ["ClimateConfig"]
