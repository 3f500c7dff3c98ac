"""tripflow: a Spark-native quality and analytics engine for trip records."""

from .config import Settings, Thresholds, load_settings
from .session import adopt, get_spark, new_process_id

__all__ = ["Settings", "Thresholds", "adopt", "get_spark", "load_settings", "new_process_id"]
