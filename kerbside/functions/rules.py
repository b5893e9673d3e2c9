"""Alert rules."""

from pyspark.sql import functions as F

# Limits in µg/m³ and vehicles, and the level names.
PM25_CRITICAL = 80
PM25_WARNING = 50
DENSITY_CRITICAL = 40
CRITICAL, WARNING, NORMAL = "CRITIQUE", "WARNING", "NORMAL"


def alert_level(pm25):
    """Level of an observed mean. Limits are exclusive; no measurement reads as NORMAL."""
    return (
        F.when(pm25 > PM25_CRITICAL, CRITICAL).when(pm25 > PM25_WARNING, WARNING).otherwise(NORMAL)
    )


def alert_predicted(pm25, density):
    """Level of a forecast: critical only where traffic is dense as well."""
    return (
        F.when((pm25 > PM25_CRITICAL) & (density > DENSITY_CRITICAL), CRITICAL)
        .when(pm25 > PM25_WARNING, WARNING)
        .otherwise(NORMAL)
    )
